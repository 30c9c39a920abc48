"""Requests against a cache policy: lookups, request sets and their statistics."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vidpulse.functions import time_text
from vidpulse.operators.order import ranked_rows, with_global_rank, with_running_sums
from vidpulse.operators.sampling import draw_rows
from vidpulse.operators.scoring import best_scores
from vidpulse.schemas import (
    CACHE,
    CACHE_HIT,
    CACHE_MISS,
    EDGE_CACHE,
    HOT,
    NO_CACHE,
    NOT_HOT,
    ORIGIN_SERVER,
    TOP_CACHED_COLUMNS,
)
from vidpulse.session import stage
from vidpulse.sources.tables import require_columns

ARRIVAL = ("event_time", "event_id")


def cache_policy(all_hot: DataFrame) -> DataFrame:
    """The best HOT window of each video.

    ``row_number() = 1`` is cut per task before the shuffle (WindowGroupLimit), so
    a video with many windows sends one row per task.
    """
    require_columns(all_hot, TOP_CACHED_COLUMNS)
    best = Window.partitionBy("video_id").orderBy(F.col("hot_score").desc_nulls_last(), "window_start")
    typed = all_hot.withColumns(
        {
            "video_id": F.col("video_id").cast("string"),
            "hot_score": F.coalesce(F.col("hot_score").try_cast("double"), F.lit(0.0)),
            "views_count": F.coalesce(F.col("views_count").try_cast("bigint"), F.lit(1)),
        }
    )
    return (
        typed.withColumn("_place", F.row_number().over(best))
        .filter(F.col("_place") == 1)
        .select(*TOP_CACHED_COLUMNS)
    )


def top_videos(policy: DataFrame, k: int = 5) -> DataFrame:
    """The k best videos of a policy."""
    if k < 1:
        raise ValueError("k must be at least 1")
    return best_scores(policy, k)


def serve_requests(requests: DataFrame, policy: DataFrame) -> DataFrame:
    """Left lookup of each request in the policy; a measured latency is carried along.

    No broadcast hint: with a written policy the planner knows its size and
    broadcasts it below the session's threshold; above, AQE splits the requests
    of a popular video. The policy has one row per video. Requests may stream.
    """
    hits = policy.select(
        "video_id",
        F.col("hot_score").alias("_score"),
        F.coalesce("hot_label", F.lit(HOT)).alias("_label"),
        time_text(F.col("window_start")).alias("_start"),
        time_text(F.col("window_end")).alias("_end"),
        F.lit(True).alias("_hit"),
    )
    hit = F.col("_hit").isNotNull()
    joined = requests.withColumn("video_id", F.col("video_id").cast("string")).join(hits, "video_id", "left")
    return joined.select(
        *requests.columns,
        F.coalesce("_score", F.lit(0.0)).alias("hot_score"),
        F.coalesce("_label", F.lit(NOT_HOT)).alias("hot_label"),
        F.coalesce("_start", F.lit("")).alias("window_start"),
        F.coalesce("_end", F.lit("")).alias("window_end"),
        F.when(hit, CACHE).otherwise(NO_CACHE).alias("cache_decision"),
        F.when(hit, CACHE_HIT).otherwise(CACHE_MISS).alias("status"),
        F.when(hit, EDGE_CACHE).otherwise(ORIGIN_SERVER).alias("served_from"),
    )


def miss_pool(logs: DataFrame, policy: DataFrame) -> DataFrame:
    """Videos of the log that are not cached."""
    videos = logs.select(F.col("video_id").cast("string")).filter(F.col("video_id").isNotNull()).distinct()
    return videos.join(policy.select("video_id"), "video_id", "left_anti")


def with_request_id(requests: DataFrame, order: Sequence[str] = ARRIVAL) -> DataFrame:
    """Sequence number by arrival."""
    return with_global_rank(requests, list(order), "request_id")


class Served(NamedTuple):
    """What a request log came to so far: requests, hits and milliseconds."""

    requests: int = 0
    hits: int = 0
    latency_ms: int = 0


def _counted_columns() -> dict[str, Column]:
    return {
        "requests": F.lit(1).cast("bigint"),
        "hits": F.when(F.col("status") == CACHE_HIT, 1).otherwise(0).cast("bigint"),
        "latency_ms": F.col("latency_ms").cast("bigint"),
    }


def totals_after(log: DataFrame, base: Served = Served()) -> Served:
    """``base`` and the requests of ``log`` together."""
    row = log.agg(*(F.sum(c).alias(n) for n, c in _counted_columns().items())).first()
    return Served(*((b + (x or 0)) for b, x in zip(base, row)))


def with_running_stats(log: DataFrame, base: Served = Served(), **options: int) -> DataFrame:
    """Hit ratio and mean latency after each request, by ``request_id``.

    ``base`` is what requests before the log's first one came to; ``request_id`` begins at 1.
    """
    sums = {f"_{n}": c for n, c in _counted_columns().items()}
    running = with_running_sums(log, "request_id", sums, **options)
    requests, hits, latency = (F.col(f"_{n}") + F.lit(b) for n, b in zip(Served._fields, base))
    return running.select(
        *log.columns,
        F.round(hits / requests, 6).alias("current_cache_hit_ratio"),
        F.round(latency / requests, 4).alias("current_avg_latency_ms"),
    )


def replay_policy(requests: DataFrame, policy: DataFrame, *, order: Sequence[str] = ARRIVAL) -> DataFrame:
    """Numbered, served and with running statistics: the request log."""
    numbered, last = ranked_rows(requests, list(order), "request_id")
    return with_running_stats(serve_requests(numbered, policy), last=last)


# --- statistics ---------------------------------------------------------------


def _outcome() -> list[Column]:
    hits = F.count_if(F.col("status") == CACHE_HIT)
    total = F.count(F.lit(1))
    return [
        total.alias("total_requests"),
        hits.alias("cache_hits"),
        (total - hits).alias("cache_misses"),
        F.round(F.coalesce(F.try_divide(hits, total), F.lit(0.0)), 6).alias("cache_hit_ratio"),
        F.round(F.coalesce(F.avg("latency_ms"), F.lit(0.0)), 4).alias("average_latency_ms"),
    ]


def request_stats(log: DataFrame, all_hot: DataFrame, policy: DataFrame) -> DataFrame:
    """Totals of a request log with the sizes of the policy; zeros when it is empty."""

    def span(status: str) -> Column:
        own = F.when(F.col("status") == status, F.col("latency_ms"))
        return F.concat_ws("-", F.min(own).cast("string"), F.max(own).cast("string"))

    return log.agg(
        *_outcome(),
        span(CACHE_HIT).alias("cache_latency_range_ms"),
        span(CACHE_MISS).alias("origin_latency_range_ms"),
    ).select(
        "*",
        all_hot.agg(F.count(F.lit(1))).scalar().alias("hot_video_window_records"),
        policy.agg(F.count(F.lit(1))).scalar().alias("cached_unique_videos"),
    )


# --- request sets -------------------------------------------------------------


def _split(n: int, share: float) -> tuple[int, int]:
    if not 0.0 <= share <= 1.0:
        raise ValueError("the share must lie between 0 and 1")
    first = int(n * share)
    return first, n - first


def stratified_requests(
    logs: DataFrame,
    policy: DataFrame,
    n: int = 20,
    cache_share: float = 0.4,
    *,
    order: Sequence[str] = ARRIVAL,
    seed: int = 42,
) -> DataFrame:
    """``int(n * cache_share)`` logged requests of cached videos, the rest of others, with replacement."""
    cached, other = _split(n, cache_share)
    ids = policy.select("video_id")
    hits = draw_rows(logs.join(ids, "video_id", "left_semi"), cached, list(order), f"{seed}-hit")
    return hits.unionByName(draw_rows(logs.join(ids, "video_id", "left_anti"), other, list(order), f"{seed}-miss"))


def viral_requests(
    logs: DataFrame,
    policy: DataFrame,
    n: int = 50,
    k: int = 5,
    viral_share: float = 0.9,
    *,
    order: Sequence[str] = ARRIVAL,
    seed: int = 42,
) -> DataFrame:
    """``int(n * viral_share)`` requests of the k best videos, the rest of uncached ones, with replacement."""
    viral, other = _split(n, viral_share)
    best = stage(top_videos(policy, k).select("video_id"), "best-videos")
    ids = policy.select("video_id")
    hits = draw_rows(logs.join(best, "video_id", "left_semi"), viral, list(order), f"{seed}-hit")
    return hits.unionByName(draw_rows(logs.join(ids, "video_id", "left_anti"), other, list(order), f"{seed}-miss"))
