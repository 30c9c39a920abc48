"""Repeatable samples, trend injection and a synthetic log.

Every draw is a function of (seed, key), so results do not depend on the number
of partitions and survive a retried task.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vidpulse.functions import draw60, int_between, md5_key, uniform
from vidpulse.operators.order import ranked_rows, take_smallest
from vidpulse.session import stage


#: A first cut lets through so many standard deviations more rows than wanted.
SLACK = 8


def sample_n(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows without replacement: the n smallest md5(seed, key).

    All rows when there are fewer. ``key`` should identify a row. Draws are even by
    construction, so a cut a little above n / rows lets through about n rows in one pass, and
    only these are ranked. Should it let through fewer, the whole table is ranked.
    """
    drawn = df.withColumn("_draw", draw60(seed, F.col(key)))
    order = ["_draw", "_md5", key]

    def smallest(rows: DataFrame) -> DataFrame:
        return take_smallest(rows.withColumn("_md5", md5_key(seed, F.col(key))), n, order).select(*df.columns)

    rows = df.count()
    slack = n + SLACK * math.sqrt(n) + SLACK * SLACK
    if n <= 0 or slack >= rows:
        return smallest(drawn)
    near = stage(drawn.filter(F.col("_draw") < int((1 << 60) * slack / rows)), "draws")
    return smallest(near if near.count() >= n else drawn)


def sample_keys(df: DataFrame, column: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` distinct values of a column; the distinct values are worked out once."""
    return sample_n(stage(df.select(column).distinct(), "keys"), n, column, seed)


def draw_rows(df: DataFrame, n: int, order: list[str], seed: int | str = 42, most: bool = False) -> DataFrame:
    """Exactly ``n`` draws with replacement (with ``most`` no more than rows); ``draw_id`` numbers them.

    Draw i takes the row whose number in ``order`` is md5(seed, i) mod rows. Draws and
    rows meet in a join by that number, so there may be any number of either.
    """
    numbered, rows = ranked_rows(df, order, "_row")
    if not rows:
        return df.withColumn("draw_id", F.lit(0).cast("bigint"))
    draws = df.sparkSession.range(min(n, rows) if most else n).select(
        F.col("id").alias("draw_id"), (draw60(seed, F.col("id")) % F.lit(rows) + 1).alias("_row")
    )
    return numbered.join(draws, "_row").select(*df.columns, "draw_id")


def sample_with_replacement(df: DataFrame, n: int, order: list[str], seed: int = 42) -> DataFrame:
    """min(n, rows) draws with replacement."""
    return draw_rows(df, n, order, seed, most=True)


def select_trending(logs: DataFrame, videos: DataFrame, since) -> DataFrame:
    """Rows of the given videos at or after a time."""
    late = logs.filter(F.col("event_time") >= since)
    return late.join(videos, "video_id", "left_semi")


def trend_start(logs: DataFrame, after: str = "3 hours"):
    """First event time plus ``after``, as a one-value subquery."""
    return logs.agg(F.min("event_time") + F.expr(f"INTERVAL {after}")).scalar()


def shifted_trend_rows(
    logs: DataFrame,
    *,
    n_videos: int = 30,
    after: str = "3 hours",
    n: int = 20_000,
    max_shift_s: int = 3599,
    seed: int = 42,
    order: tuple[str, ...] = ("event_time", "event_id"),
) -> DataFrame:
    """Resampled rows of ``n_videos`` videos, each moved forward by up to an hour."""
    videos = stage(sample_keys(logs, "video_id", n_videos, seed), "trend-videos")
    trend = stage(select_trending(logs, videos, trend_start(logs, after)), "trend-rows")
    drawn = sample_with_replacement(trend, n, list(order), seed)
    shift = F.make_dt_interval(secs=int_between(f"{seed}-shift", F.col("draw_id"), 0, max_shift_s))
    return drawn.withColumn("event_time", F.col("event_time") + shift).select(*logs.columns)


def inject_trend(logs: DataFrame, *, ordered: bool = True, **options) -> DataFrame:
    """The log with resampled rows of some videos added, in time order."""
    joined = logs.unionByName(shifted_trend_rows(logs, **options))
    return joined.orderBy("event_time") if ordered else joined


def generate_logs(
    ids: DataFrame,
    *,
    n_users: int = 5000,
    n_videos: int = 1000,
    start: str = "2026-05-01 08:00:00",
    span_s: int = 6 * 60 * 60,
    mean_watch_s: float = 40.0,
    seed: int = 42,
) -> DataFrame:
    """One synthetic interaction per id (the first column of ``ids``).

    ``spark.range(100_000)`` gives the usual sample log. Duration 10..179 s, watch
    time the smaller of it and an exponential draw, likes and shares more likely
    the more was watched.
    """
    key = F.col(ids.columns[0])

    def part(name: str):
        return f"{seed}-{name}"

    started = F.lit(start).cast("timestamp_ntz")
    drawn = ids.select(
        key.alias("event_id"),
        (started + F.make_dt_interval(secs=int_between(part("time"), key, 0, span_s - 1))).alias("event_time"),
        int_between(part("user"), key, 1, n_users).alias("user_id"),
        int_between(part("video"), key, 1, n_videos).alias("video_id"),
        int_between(part("duration"), key, 10, 179).alias("duration"),
        (F.lit(-mean_watch_s) * F.log(F.lit(1.0) - uniform(part("watch"), key))).alias("_wanted"),
    )
    watched = drawn.withColumn("watch_time", F.round(F.least(F.col("duration").cast("double"), "_wanted"), 2))
    rated = watched.withColumn("watch_ratio", F.round(F.col("watch_time") / F.col("duration"), 4))
    liked = uniform(part("like"), F.col("event_id")) < 0.05 + 0.25 * F.col("watch_ratio")
    shared = uniform(part("share"), F.col("event_id")) < 0.01 + 0.08 * F.col("watch_ratio")
    return rated.select(
        "event_id",
        "event_time",
        "user_id",
        "video_id",
        "duration",
        "watch_time",
        "watch_ratio",
        F.lit(1).alias("is_click"),
        liked.cast("int").alias("is_like"),
        shared.cast("int").alias("is_share"),
    )
