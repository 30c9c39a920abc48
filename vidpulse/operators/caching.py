"""Cache recommendation from predictions, and what it would save."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vidpulse.functions import finite_or_null, lenient
from vidpulse.operators.order import exact_quantiles, with_global_rank
from vidpulse.operators.scoring import best_scores, by_score, hot_only
from vidpulse.schemas import (
    CACHE,
    DECISION_REASONS,
    HIGH,
    HOT,
    HOT_COLUMNS,
    HOT_QUANTILE,
    LOW,
    MEDIUM,
    NO_CACHE,
    NOT_HOT,
    PRIORITY_ORDER,
    RECOMMENDATION_COLUMNS,
    TOP_CACHED_COLUMNS,
    UNKNOWN_PRIORITY,
    VERY_HIGH,
    WATCHLIST,
    WATCHLIST_QUANTILE,
    CostModel,
)
from vidpulse.sources.tables import require_columns

PREDICTION_INPUTS = RECOMMENDATION_COLUMNS[:11]


def coerce_predictions(predictions: DataFrame) -> DataFrame:
    """Finite numbers or 0, counts truncated to whole numbers or 0, labels in upper case."""
    require_columns(predictions, PREDICTION_INPUTS)

    def number(name: str) -> Column:
        value = lenient(F.col(name), "double")
        return F.coalesce(finite_or_null(value), F.lit(0.0))

    def whole(name: str, kind: str) -> Column:
        return F.coalesce(lenient(number(name), kind), F.lit(0).cast(kind))

    return predictions.withColumns(
        {
            "video_id": F.col("video_id").cast("string"),
            **{n: whole(n, "bigint") for n in ("views_count", "unique_users", "engagement_count")},
            **{n: number(n) for n in ("avg_watch_ratio", "growth_rate", "hot_score")},
            "predicted_hot": whole("predicted_hot", "int"),
            "hot_label": F.upper(F.col("hot_label").cast("string")),
        }
    )


def reconcile_labels(predictions: DataFrame) -> DataFrame:
    """predicted_hot 1 forces HOT; 0 turns every label but HOT into NOT_HOT."""
    label, predicted = F.col("hot_label"), F.col("predicted_hot")
    return predictions.withColumn(
        "hot_label",
        F.when(predicted == 1, HOT)
        .when((predicted == 0) & ~label.eqNullSafe(HOT), NOT_HOT)
        .otherwise(label),
    )


def cache_thresholds(
    predictions: DataFrame, watchlist_q: float = WATCHLIST_QUANTILE
) -> dict[str, float | None]:
    """Watchlist cut (non-HOT rows, or all rows when every row is HOT) and the p99."""
    score = F.col("hot_score")
    cuts = exact_quantiles(
        predictions,
        {
            "non_hot": (F.when(~F.col("hot_label").eqNullSafe(HOT), score), watchlist_q),
            "all": (score, watchlist_q),
            "p99": (score, HOT_QUANTILE),
        },
    )
    watchlist = cuts["all"] if cuts["non_hot"] is None else cuts["non_hot"]
    return {"watchlist": watchlist, "p99": cuts["p99"]}


def cache_decision(watchlist_threshold: float | None) -> Column:
    return (
        F.when(F.col("hot_label") == HOT, CACHE)
        .when(F.col("hot_score") >= F.lit(watchlist_threshold).cast("double"), WATCHLIST)
        .otherwise(NO_CACHE)
    )


def cache_priority(p99: float | None) -> Column:
    decision = F.col("cache_decision")
    top = F.col("hot_score") >= F.lit(p99).cast("double")
    return (
        F.when((decision == CACHE) & top, VERY_HIGH)
        .when(decision == CACHE, HIGH)
        .when(decision == WATCHLIST, MEDIUM)
        .otherwise(LOW)
    )


def cache_reason() -> Column:
    reason = F.lit(DECISION_REASONS[NO_CACHE])
    for decision in (WATCHLIST, CACHE):
        reason = F.when(F.col("cache_decision") == decision, DECISION_REASONS[decision]).otherwise(reason)
    return reason


def decide(
    predictions: DataFrame, watchlist_q: float = WATCHLIST_QUANTILE
) -> DataFrame:
    """Decision, priority and reason for coerced and reconciled predictions."""
    cuts = cache_thresholds(predictions, watchlist_q)
    return (
        predictions.withColumn("cache_decision", cache_decision(cuts["watchlist"]))
        .withColumn("cache_priority", cache_priority(cuts["p99"]))
        .withColumn("reason", cache_reason())
    )


def with_cache_rank(predictions: DataFrame) -> DataFrame:
    return with_global_rank(predictions, by_score(), "cache_rank")


def order_recommendations(recommendations: DataFrame) -> DataFrame:
    """Priority, then score and views, both falling."""
    place = F.lit(UNKNOWN_PRIORITY)
    for priority, number in PRIORITY_ORDER.items():
        place = F.when(F.col("cache_priority") == priority, number).otherwise(place)
    return recommendations.orderBy(
        place, F.col("hot_score").desc(), F.col("views_count").desc(), "video_id", "window_start"
    )


def recommend_cache(
    predictions: DataFrame, watchlist_q: float = WATCHLIST_QUANTILE, ordered: bool = True
) -> DataFrame:
    """Ranked cache recommendation; ``predictions`` is read several times."""
    ready = reconcile_labels(coerce_predictions(predictions))
    ranked = with_cache_rank(decide(ready, watchlist_q)).select(*RECOMMENDATION_COLUMNS)
    return order_recommendations(ranked) if ordered else ranked


def top_cached(all_hot: DataFrame, n: int = 20) -> DataFrame:
    """The n best HOT records."""
    if n < 1:
        raise ValueError("n must be at least 1")
    return best_scores(all_hot, n).select(*TOP_CACHED_COLUMNS)


def top_decided(recommendations: DataFrame, n: int = 20) -> DataFrame:
    """Chart table: the best CACHE rows."""
    cached = recommendations.filter(F.col("cache_decision") == CACHE)
    return best_scores(cached.select("video_id", "window_start", "hot_score"), n)


def all_hot(predictions: DataFrame) -> DataFrame:
    """All HOT rows, best first."""
    return hot_only(predictions).select(*HOT_COLUMNS).orderBy(*by_score())


# --- what the recommendation saves --------------------------------------------

# Metric, unit and description of the report, in report order.
KPI_ROWS = [
    ("total_requests", "requests", "Total simulated requests based on views_count."),
    ("cache_hits", "requests", "Requests served from cache because cache_decision is CACHE."),
    ("cache_misses", "requests", "Requests still served by the origin server."),
    ("watchlist_requests", "requests", "Requests belonging to WATCHLIST records."),
    ("cache_hit_ratio", "ratio", "Share of requests served by cache."),
    ("origin_request_reduction", "ratio", "Estimated reduction of requests to origin server."),
    ("average_latency_without_cache", "ms", "Assumed average latency if all requests go to origin."),
    ("average_latency_with_cache", "ms", "Estimated average latency after applying cache recommendation."),
    ("latency_reduction_ms", "ms", "Estimated latency reduction in milliseconds."),
    ("latency_reduction_percent", "ratio", "Estimated latency reduction ratio."),
    ("estimated_bandwidth_saved", "GB", "Estimated bandwidth saved from cached requests."),
    ("estimated_cost_saved", "USD", "Estimated bandwidth cost saved."),
    ("num_cache_records", "records", "Number of video-window records recommended for CACHE."),
    ("num_watchlist_records", "records", "Number of video-window records recommended for WATCHLIST."),
    ("num_no_cache_records", "records", "Number of video-window records recommended for NO_CACHE."),
    ("num_unique_cached_videos", "videos", "Number of unique videos recommended for CACHE."),
    ("num_unique_total_videos", "videos", "Number of unique videos in prediction output."),
    ("origin_latency_ms_assumption", "ms", "Latency assumption for origin server."),
    ("cache_latency_ms_assumption", "ms", "Latency assumption for cache server."),
    ("average_request_size_mb_assumption", "MB", "Assumed average video request size."),
    ("cost_per_gb_assumption", "USD/GB", "Assumed bandwidth cost per GB."),
]

# Decimal places of the derived metrics.
KPI_PLACES = {
    "cache_hit_ratio": 6,
    "origin_request_reduction": 6,
    "average_latency_without_cache": 4,
    "average_latency_with_cache": 4,
    "latency_reduction_ms": 4,
    "latency_reduction_percent": 6,
    "estimated_bandwidth_saved": 4,
    "estimated_cost_saved": 4,
}


def cache_totals(recommendations: DataFrame) -> DataFrame:
    """One row of request and record totals.

    Grouping by video first gives both distinct-video counts from one exchange
    with partial sums, where two distinct counts would double the rows.
    """
    views, decision = F.col("views_count"), F.col("cache_decision")
    per_video = recommendations.groupBy("video_id").agg(
        F.sum(views).alias("requests"),
        *(F.sum(F.when(decision == d, views)).alias(f"requests_{d}") for d in (CACHE, WATCHLIST)),
        *(F.count_if(decision == d).alias(f"records_{d}") for d in (CACHE, WATCHLIST, NO_CACHE)),
    )

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0))

    return per_video.agg(
        total("requests").alias("total_requests"),
        total(f"requests_{CACHE}").alias("cache_hits"),
        total(f"requests_{WATCHLIST}").alias("watchlist_requests"),
        total(f"records_{CACHE}").alias("num_cache_records"),
        total(f"records_{WATCHLIST}").alias("num_watchlist_records"),
        total(f"records_{NO_CACHE}").alias("num_no_cache_records"),
        F.count(F.when(F.col(f"records_{CACHE}") > 0, F.col("video_id"))).alias("num_unique_cached_videos"),
        F.count("video_id").alias("num_unique_total_videos"),
    )


def derive_kpis(totals: DataFrame, costs: CostModel = CostModel()) -> DataFrame:
    """Adds the unrounded savings to the one row of totals."""
    requests, hits = F.col("total_requests"), F.col("cache_hits")
    origin = F.lit(float(costs.origin_latency_ms))
    shares = totals.withColumn("cache_misses", requests - hits).withColumns(
        {
            "cache_hit_ratio": F.coalesce(F.try_divide(hits, requests), F.lit(0.0)),
            "average_latency_without_cache": origin,
            "average_latency_with_cache": F.coalesce(
                F.try_divide(
                    hits * F.lit(float(costs.cache_latency_ms)) + F.col("cache_misses") * origin, requests
                ),
                F.lit(0.0),
            ),
            "estimated_bandwidth_saved": hits * F.lit(float(costs.request_size_mb)) / F.lit(1024.0),
        }
    )
    saved = shares.withColumn(
        "latency_reduction_ms", F.col("average_latency_without_cache") - F.col("average_latency_with_cache")
    )
    return saved.withColumns(
        {
            "origin_request_reduction": F.col("cache_hit_ratio"),
            "latency_reduction_percent": F.when(
                origin > 0, F.try_divide(F.col("latency_reduction_ms"), origin)
            ).otherwise(F.lit(0.0)),
            "estimated_cost_saved": F.col("estimated_bandwidth_saved") * F.lit(float(costs.cost_per_gb)),
            "origin_latency_ms_assumption": origin,
            "cache_latency_ms_assumption": F.lit(float(costs.cache_latency_ms)),
            "average_request_size_mb_assumption": F.lit(float(costs.request_size_mb)),
            "cost_per_gb_assumption": F.lit(float(costs.cost_per_gb)),
        }
    )


def kpi_report(derived: DataFrame) -> DataFrame:
    """The 21 rows (metric, value, unit, description)."""
    rows = []
    for metric, unit, text in KPI_ROWS:
        value = F.col(metric).cast("double")
        if metric in KPI_PLACES:
            value = F.round(value, KPI_PLACES[metric])
        rows.append(
            F.struct(
                F.lit(metric).alias("metric"),
                value.alias("value"),
                F.lit(unit).alias("unit"),
                F.lit(text).alias("description"),
            )
        )
    return derived.select(F.inline(F.array(*rows)))


def evaluate_cache(recommendations: DataFrame, costs: CostModel = CostModel()) -> DataFrame:
    return kpi_report(derive_kpis(cache_totals(recommendations), costs))


def kpi_percent(recommendations: DataFrame, costs: CostModel = CostModel()) -> DataFrame:
    """Chart table: the three ratios as percentages."""
    labels = {
        "Cache Hit Ratio": "cache_hit_ratio",
        "Origin Request Reduction": "origin_request_reduction",
        "Latency Reduction": "latency_reduction_percent",
    }
    rows = [
        F.struct(F.lit(label).alias("metric"), (F.col(c) * 100).alias("percent"))
        for label, c in labels.items()
    ]
    return derive_kpis(cache_totals(recommendations), costs).select(F.inline(F.array(*rows)))


def hits_and_misses(recommendations: DataFrame) -> DataFrame:
    """Chart table: requests by outcome."""
    rows = [
        F.struct(F.lit(label).alias("type"), F.col(c).alias("requests"))
        for label, c in {"Cache Hits": "cache_hits", "Cache Misses": "cache_misses"}.items()
    ]
    return derive_kpis(cache_totals(recommendations)).select(F.inline(F.array(*rows)))


def latency_comparison(recommendations: DataFrame, costs: CostModel = CostModel()) -> DataFrame:
    """Chart table: mean latency without and with the cache."""
    rows = [
        F.struct(F.lit(label).alias("scenario"), F.col(c).alias("latency_ms"))
        for label, c in {
            "Without Cache": "average_latency_without_cache",
            "With Cache": "average_latency_with_cache",
        }.items()
    ]
    return derive_kpis(cache_totals(recommendations), costs).select(F.inline(F.array(*rows)))
