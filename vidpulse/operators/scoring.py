"""Hot score, threshold and label of feature rows.

Scoring needs table-wide figures (maxima, then a quantile of the score). They are
one-row aggregations put into the next plan as literals; hand in a written feature
table so that each of them is a narrow scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vidpulse.functions import finite_or_null
from vidpulse.operators.order import approx_quantile, exact_quantiles, take_best
from vidpulse.schemas import HOT, HOT_COLUMNS, HOT_QUANTILE, NOT_HOT, PREDICTION_COLUMNS, ScoreWeights
from vidpulse.sources.tables import require_columns

FEATURE_INPUTS = PREDICTION_COLUMNS[:8]
COMPONENTS = ["views_score", "growth_score", "watch_ratio_score", "engagement_score"]


def _divisor(column: Column) -> Column:
    """A maximum as a divisor: null and 0 become 1."""
    return F.coalesce(F.nullif(column.cast("double"), F.lit(0.0)), F.lit(1.0))


def score_maxima(features: DataFrame) -> DataFrame:
    return features.agg(
        _divisor(F.max("views_count")).alias("max_views"),
        _divisor(F.max("growth_rate")).alias("max_growth"),
        _divisor(F.max("engagement_count")).alias("max_engagement"),
        F.count(F.lit(1)).alias("rows"),
    )


def max_scaled(features: DataFrame) -> tuple[DataFrame, int]:
    top = score_maxima(features).first()
    return (
        features.withColumns(
            {
                "views_score": F.col("views_count") / F.lit(top["max_views"]),
                "growth_score": F.col("growth_rate") / F.lit(top["max_growth"]),
                "watch_ratio_score": F.col("avg_watch_ratio"),
                "engagement_score": F.col("engagement_count") / F.lit(top["max_engagement"]),
            }
        ),
        top["rows"],
    )


def scaled_between(column: Column, low: float | None, high: float | None) -> Column:
    """0..1 over the given range; a constant column gives 0."""
    if low is None or low == high:
        return column * F.lit(0.0)
    return (column - F.lit(low)) / F.lit(high - low)


def min_max_scaled(
    features: DataFrame, ranges: dict[str, tuple[float, float]] | None = None
) -> tuple[DataFrame, int]:
    """Growth is cut at 0 first. ``ranges`` overrides the measured (min, max)."""
    inputs = {
        "views_score": F.col("views_count").cast("double"),
        "growth_score": F.greatest(F.col("growth_rate").cast("double"), F.lit(0.0)),
        "watch_ratio_score": F.col("avg_watch_ratio").cast("double"),
        "engagement_score": F.col("engagement_count").cast("double"),
    }
    measured = features.agg(
        F.count(F.lit(1)).alias("rows"),
        *(F.min(c).alias(f"{n}_low") for n, c in inputs.items()),
        *(F.max(c).alias(f"{n}_high") for n, c in inputs.items()),
    ).first()
    ends = {n: (measured[f"{n}_low"], measured[f"{n}_high"]) for n in inputs} | (ranges or {})
    return (
        features.withColumns({n: scaled_between(c, *ends[n]) for n, c in inputs.items()}),
        measured["rows"],
    )


def label_hot(scored: DataFrame, threshold: float | None) -> DataFrame:
    """``predicted_hot`` 1/0 and HOT/NOT_HOT; no threshold (no rows) labels nothing."""
    hot = F.col("hot_score") >= F.lit(threshold).cast("double")
    return scored.withColumn("predicted_hot", F.when(hot, 1).otherwise(0)).withColumn(
        "hot_label", F.when(F.col("predicted_hot") == 1, HOT).otherwise(NOT_HOT)
    )


def hot_scores(
    features: DataFrame,
    scaling: str = "max",
    weights: ScoreWeights = ScoreWeights(),
    ranges: dict[str, tuple[float, float]] | None = None,
) -> tuple[DataFrame, int]:
    """Features with component scores and ``hot_score``, and the row count."""
    require_columns(features, FEATURE_INPUTS)
    if scaling == "max":
        scaled, rows = max_scaled(features)
    elif scaling == "minmax":
        scaled, rows = min_max_scaled(features, ranges)
    else:
        raise ValueError(f"unknown scaling {scaling!r}")
    score = (
        F.lit(weights.views) * F.col("views_score")
        + F.lit(weights.growth) * F.col("growth_score")
        + F.lit(weights.watch_ratio) * F.col("watch_ratio_score")
        + F.lit(weights.engagement) * F.col("engagement_score")
    )
    return scaled.withColumn("hot_score", finite_or_null(score)), rows


def score_hot(
    features: DataFrame,
    scaling: str = "max",
    threshold: str | float = "exact",
    *,
    quantile: float = HOT_QUANTILE,
    weights: ScoreWeights = ScoreWeights(),
    ranges: dict[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """Predictions. ``threshold`` is ``"exact"`` or ``"approx"`` (the quantile of the
    score, the latter from a sketch with rank error 0.001) or a fixed number."""
    scored, _ = hot_scores(features, scaling, weights, ranges)
    if threshold == "exact":
        cut = exact_quantiles(scored, {"cut": (F.col("hot_score"), quantile)})["cut"]
    elif threshold == "approx":
        cut = approx_quantile(scored, "hot_score", quantile, 0.001)
    else:
        cut = float(threshold)
    return label_hot(scored, cut).select(*PREDICTION_COLUMNS)


def hot_only(predictions: DataFrame) -> DataFrame:
    require_columns(predictions, HOT_COLUMNS)
    return predictions.filter(F.col("hot_label") == HOT).select(*HOT_COLUMNS)


#: Order of rows of the same score.
SCORE_TIES = ("video_id", "window_start")


def by_score() -> list[Column]:
    """Best score first; ties by video and window."""
    return [F.col("hot_score").desc_nulls_last(), *map(F.col, SCORE_TIES)]


def best_scores(rows: DataFrame, n: int) -> DataFrame:
    """The n rows of the best score."""
    return take_best(rows, n, "hot_score", SCORE_TIES)


def top_hot(predictions: DataFrame, n: int = 20, only_hot: bool = True) -> DataFrame:
    rows = hot_only(predictions) if only_hot else predictions.select(*HOT_COLUMNS)
    return best_scores(rows, n)


def top_features(features: DataFrame, n: int = 20) -> DataFrame:
    """Preview by views, then growth."""
    return take_best(features, n, "views_count", [F.col("growth_rate").desc(), *SCORE_TIES])
