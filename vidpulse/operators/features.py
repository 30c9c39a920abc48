"""Per-video time-window features."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vidpulse.schemas import FEATURE_COLUMNS, SPLIT_FEATURE_COLUMNS, WINDOW

def windowed(logs: DataFrame, window: str) -> DataFrame:
    """Adds the start of the tumbling window; rows without a time are dropped."""
    return logs.withColumn("window_start", F.window("event_time", window)["start"])


def video_features(
    logs: DataFrame,
    window: str = WINDOW,
    *,
    split_engagement: bool = False,
    approx_users: bool = False,
) -> DataFrame:
    """Views, distinct users, mean ratio and watch time, engagement and growth.

    Two levels: rows are added up per (video, window, user) and those sums per (video,
    window). Both add up within each task first, so neither a popular video nor a busy
    user sends raw rows anywhere, and users are counted exactly, as one row each. With
    ``approx_users`` a sketch counts them and the first level falls away.
    """
    cells = windowed(logs, window)
    sums = {
        "views": F.count(F.lit(1)),
        "ratio_sum": F.sum("watch_ratio"),
        "ratio_n": F.count("watch_ratio"),
        "watch_sum": F.sum("watch_time"),
        "watch_n": F.count("watch_time"),
        # One sum skips a row in which either flag is null, two sums do not.
        **(
            {"likes": F.sum("is_like"), "shares": F.sum("is_share")}
            if split_engagement
            else {"engaged": F.sum(F.col("is_like") + F.col("is_share"))}
        ),
    }
    if approx_users:
        users = F.approx_count_distinct("user_id").alias("users")
        pieces = cells.groupBy("video_id", "window_start").agg(users, *(c.alias(n) for n, c in sums.items()))
    else:
        each = cells.groupBy("video_id", "window_start", "user_id").agg(*(c.alias(n) for n, c in sums.items()))
        pieces = each.withColumn("users", F.col("user_id").isNotNull().cast("bigint"))
    engagement = (
        {
            "like_count": F.coalesce(F.sum("likes"), F.lit(0)),
            "share_count": F.coalesce(F.sum("shares"), F.lit(0)),
        }
        if split_engagement
        else {"engagement_count": F.sum("engaged")}
    )
    features = (
        pieces.groupBy("video_id", "window_start")
        .agg(
            F.sum("views").alias("views_count"),
            F.sum("users").alias("unique_users"),
            F.try_divide(F.sum("ratio_sum"), F.sum("ratio_n")).alias("avg_watch_ratio"),
            F.try_divide(F.sum("watch_sum"), F.sum("watch_n")).alias("avg_watch_time"),
            *(column.alias(name) for name, column in engagement.items()),
        )
        .withColumn("window_end", F.col("window_start") + F.expr(f"INTERVAL {window}"))
    )
    if split_engagement:
        features = features.withColumn("engagement_count", F.col("like_count") + F.col("share_count"))
    grown = with_growth(features, keep_previous=split_engagement)
    return grown.select(*(SPLIT_FEATURE_COLUMNS if split_engagement else FEATURE_COLUMNS))


def with_growth(features: DataFrame, keep_previous: bool = False) -> DataFrame:
    """Change of views against the previous non-empty window of the same video.

    A video has one row per window here, so a popular video is no larger than
    its number of windows.
    """
    by_time = Window.partitionBy("video_id").orderBy("window_start")
    previous = F.coalesce(F.lag("views_count").over(by_time), F.lit(0))
    grown = features.withColumn("previous_views", previous).withColumn(
        "growth_rate",
        F.when(F.col("previous_views") == 0, F.col("views_count").cast("double")).otherwise(
            (F.col("views_count") - F.col("previous_views")) / F.col("previous_views")
        ),
    )
    return grown if keep_previous else grown.drop("previous_views")


def unique_users(logs: DataFrame, window: str = WINDOW, **options) -> DataFrame:
    return video_features(logs, window, **options).select(
        "video_id", "window_start", "views_count", "unique_users"
    )
