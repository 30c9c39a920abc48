"""Layer schemas, label values and default parameters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values: column order and types of each layer -----------------------

MESSAGE = T.StructType(
    [
        T.StructField("event_time", T.StringType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("video_id", T.LongType()),
        T.StructField("watch_time", T.DoubleType()),
        T.StructField("duration", T.DoubleType()),
        T.StructField("watch_ratio", T.DoubleType()),
        T.StructField("is_click", T.IntegerType()),
        T.StructField("is_like", T.IntegerType()),
        T.StructField("is_share", T.IntegerType()),
    ]
)

TOPIC = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# Bronze keeps the payload and the broker columns beside the parsed fields, so
# that a malformed payload can be replayed.
BRONZE = T.StructType(
    [
        T.StructField("raw_data", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        *MESSAGE.fields,
    ]
)

SILVER = T.StructType(
    [
        T.StructField("event_time", T.TimestampType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("video_id", T.StringType()),
        *MESSAGE.fields[3:],
    ]
)

LOG_COLUMNS = MESSAGE.fieldNames()

FEATURE_COLUMNS = [
    "video_id",
    "window_start",
    "window_end",
    "views_count",
    "unique_users",
    "avg_watch_ratio",
    "avg_watch_time",
    "growth_rate",
    "engagement_count",
]

CELL_COLUMNS = [c for c in FEATURE_COLUMNS if c != "growth_rate"]

SPLIT_FEATURE_COLUMNS = [
    *FEATURE_COLUMNS,
    "like_count",
    "share_count",
    "previous_views",
]

PREDICTION_COLUMNS = [
    "video_id",
    "window_start",
    "window_end",
    "views_count",
    "unique_users",
    "avg_watch_ratio",
    "growth_rate",
    "engagement_count",
    "views_score",
    "growth_score",
    "watch_ratio_score",
    "engagement_score",
    "hot_score",
    "predicted_hot",
    "hot_label",
]

HOT_COLUMNS = [
    "video_id",
    "window_start",
    "window_end",
    "views_count",
    "unique_users",
    "avg_watch_ratio",
    "growth_rate",
    "engagement_count",
    "hot_score",
    "hot_label",
]

RECOMMENDATION_COLUMNS = [
    "video_id",
    "window_start",
    "window_end",
    "views_count",
    "unique_users",
    "avg_watch_ratio",
    "growth_rate",
    "engagement_count",
    "hot_score",
    "predicted_hot",
    "hot_label",
    "cache_rank",
    "cache_priority",
    "cache_decision",
    "reason",
]

TOP_CACHED_COLUMNS = [
    "video_id",
    "window_start",
    "window_end",
    "views_count",
    "unique_users",
    "hot_score",
    "hot_label",
]

# --- fixed values: labels -----------------------------------------------------

HOT, NOT_HOT = "HOT", "NOT_HOT"
CACHE, WATCHLIST, NO_CACHE = "CACHE", "WATCHLIST", "NO_CACHE"
VERY_HIGH, HIGH, MEDIUM, LOW = "VERY_HIGH", "HIGH", "MEDIUM", "LOW"
CACHE_HIT, CACHE_MISS = "CACHE_HIT", "CACHE_MISS"
EDGE_CACHE, ORIGIN_SERVER = "EDGE_CACHE", "ORIGIN_SERVER"

PRIORITY_ORDER = {VERY_HIGH: 0, HIGH: 1, MEDIUM: 2, LOW: 3}
UNKNOWN_PRIORITY = 9

DECISION_REASONS = {
    CACHE: "Predicted as HOT; preload this video-window into cache.",
    WATCHLIST: "High hot_score among non-HOT records; monitor for possible caching.",
    NO_CACHE: "Low trending signal; do not cache to avoid wasting resources.",
}

COLUMN_ALIASES = {
    "item_id": "video_id",
    "videoid": "video_id",
    "userid": "user_id",
    "time": "event_time",
    "play_time": "watch_time",
    "view_time": "watch_time",
}

DEFAULT_FLAGS = {"is_click": 1, "is_like": 0, "is_share": 0}


# --- default parameters -------------------------------------------------------


@dataclass(frozen=True)
class ScoreWeights:
    views: float = 0.4
    growth: float = 0.25
    watch_ratio: float = 0.2
    engagement: float = 0.15


@dataclass(frozen=True)
class CostModel:
    origin_latency_ms: float = 300
    cache_latency_ms: float = 50
    request_size_mb: float = 20
    cost_per_gb: float = 0.02


HOT_QUANTILE = 0.99
STATIC_THRESHOLD = 0.7
WATCHLIST_QUANTILE = 0.95
WINDOW = "30 minutes"
REQUEST_SCAN_ROWS = 100_000
MAX_OFFSETS_PER_TRIGGER = 10_000
