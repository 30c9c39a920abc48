"""Stored panes: partial sums and user sketches per video and short window.

A pane holds what features of any longer window need: sums, counts and a theta sketch
of the users, all of which merge. Day and month windows are composed from panes
without the log, and new rows of the log only add panes. A sketch counts exactly
up to ``2 ** lg_users`` users of a composed window and estimates beyond, with a relative error
of about ``1 / sqrt(2 ** lg_users)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vidpulse.operators.features import windowed, with_growth
from vidpulse.schemas import CELL_COLUMNS, FEATURE_COLUMNS, WINDOW

#: Binary logarithm of the users that a sketch keeps, and so counts exactly.
LG_USERS = 12
SUMS = ("views", "ratio_sum", "ratio_n", "watch_sum", "watch_n", "engaged")
PANE_COLUMNS = ("video_id", "pane_start", *SUMS, "users")


def make_panes(logs: DataFrame, width: str = WINDOW, lg_users: int = LG_USERS) -> DataFrame:
    """One row for each (video, pane) of the log; each task combines its rows first."""
    sums = {
        "views": F.count(F.lit(1)),
        "ratio_sum": F.sum("watch_ratio"),
        "ratio_n": F.count("watch_ratio"),
        "watch_sum": F.sum("watch_time"),
        "watch_n": F.count("watch_time"),
        "engaged": F.sum(F.col("is_like") + F.col("is_share")),
        "users": F.theta_sketch_agg("user_id", lg_users),
    }
    cells = windowed(logs, width).groupBy("video_id", F.col("window_start").alias("pane_start"))
    return cells.agg(*(c.alias(n) for n, c in sums.items())).select(*PANE_COLUMNS)


def merge_panes(panes: DataFrame, lg_users: int = LG_USERS) -> DataFrame:
    """One row for each (video, pane) where several writes left more, such as late rows."""
    merged = [F.sum(c).alias(c) for c in SUMS]
    users = F.theta_union_agg("users", lg_users).alias("users")
    return panes.groupBy("video_id", "pane_start").agg(*merged, users).select(*PANE_COLUMNS)


def compose_cells(panes: DataFrame, window: str, lg_users: int = LG_USERS) -> DataFrame:
    """Cells of a longer window, without growth; its width has to be a multiple of the panes'."""
    return (
        panes.groupBy("video_id", F.window("pane_start", window)["start"].alias("window_start"))
        .agg(
            F.sum("views").alias("views_count"),
            F.theta_sketch_estimate(F.theta_union_agg("users", lg_users)).alias("unique_users"),
            F.try_divide(F.sum("ratio_sum"), F.sum("ratio_n")).alias("avg_watch_ratio"),
            F.try_divide(F.sum("watch_sum"), F.sum("watch_n")).alias("avg_watch_time"),
            F.sum("engaged").alias("engagement_count"),
        )
        .withColumn("window_end", F.col("window_start") + F.expr(f"INTERVAL {window}"))
        .select(*CELL_COLUMNS)
    )


def compose_features(panes: DataFrame, window: str, lg_users: int = LG_USERS) -> DataFrame:
    """The features of ``video_features`` for a longer window."""
    return with_growth(compose_cells(panes, window, lg_users)).select(*FEATURE_COLUMNS)
