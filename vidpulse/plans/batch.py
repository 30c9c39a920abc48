"""The batch chain as one application: log -> features -> predictions -> exports ->
recommendation -> savings. Each stage publishes a table; the next one reads it."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from vidpulse.operators import caching, profiling, scoring
from vidpulse.operators.features import video_features
from vidpulse.schemas import HOT_QUANTILE, WATCHLIST_QUANTILE, WINDOW, CostModel, ScoreWeights
from vidpulse.session import staging
from vidpulse.sources.sinks import RunReport, publish
from vidpulse.sources.tables import read_table

FEATURES = "video_features"
PREDICTIONS = "hot_video_predictions"
ALL_HOT = "all_hot_videos"
TOP_HOT = "top_hot_videos"
RECOMMENDATION = "cache_recommendation"
METRICS = "evaluation_metrics"


@dataclass(frozen=True)
class BatchSettings:
    window: str = WINDOW
    scaling: str = "max"
    threshold: str | float = "exact"
    hot_quantile: float = HOT_QUANTILE
    watchlist_quantile: float = WATCHLIST_QUANTILE
    weights: ScoreWeights = field(default_factory=ScoreWeights)
    costs: CostModel = field(default_factory=CostModel)
    top_n: int = 20


def run_batch(
    logs: DataFrame, out_dir: str, settings: BatchSettings = BatchSettings()
) -> tuple[dict[str, RunReport], DataFrame]:
    """Publish the six tables under ``out_dir``; returns the reports and the summary.

    An empty feature table stops the run before anything is replaced. A run
    without HOT rows publishes empty HOT tables.
    """
    spark = logs.sparkSession
    reports: dict[str, RunReport] = {}

    def put(df: DataFrame, name: str, allow_empty: bool = False) -> DataFrame:
        path = f"{out_dir}/{name}"
        reports[name] = publish(df, path, allow_empty=allow_empty)
        return read_table(spark, path, schema=df.schema)

    with staging(spark):
        return _publish_all(logs, put, settings, reports)


def _publish_all(logs, put, settings, reports):
    features = put(video_features(logs, settings.window), FEATURES)
    predictions = put(
        scoring.score_hot(
            features,
            settings.scaling,
            settings.threshold,
            quantile=settings.hot_quantile,
            weights=settings.weights,
        ),
        PREDICTIONS,
    )
    put(caching.all_hot(predictions), ALL_HOT, allow_empty=True)
    put(scoring.top_hot(predictions, settings.top_n), TOP_HOT, allow_empty=True)
    recommendation = put(
        caching.recommend_cache(predictions, settings.watchlist_quantile), RECOMMENDATION
    )
    put(caching.evaluate_cache(recommendation, settings.costs), METRICS)
    return reports, profiling.run_summary(features, predictions, recommendation)


def run_from_table(
    spark: SparkSession, silver: str, out_dir: str, settings: BatchSettings = BatchSettings(), fmt: str = "parquet"
) -> tuple[dict[str, RunReport], DataFrame]:
    return run_batch(read_table(spark, silver, fmt), out_dir, settings)
