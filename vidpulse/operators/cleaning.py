"""Column normalisation, typing and the three cleaners.

Each works on batch and streaming DataFrames alike; only ``dedup_logs`` (and with
it the clamp mode) keeps state on a stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vidpulse.functions import clamp, flag, lenient, millis_text, parse_time, ratio
from vidpulse.schemas import COLUMN_ALIASES, DEFAULT_FLAGS, LOG_COLUMNS
from vidpulse.sources.tables import require_columns


def normalize_columns(df: DataFrame, aliases: dict[str, str] = COLUMN_ALIASES) -> DataFrame:
    """Trimmed lower-case names, then the first alias present for each absent target.

    A ``time_ms`` column stands in for an absent event time, as text read from milliseconds.
    """
    names = [c.strip().lower() for c in df.columns]
    for old, new in aliases.items():
        if old in names and new not in names:
            names = [new if n == old else n for n in names]
    named = df.toDF(*names)
    if "time_ms" in names and "event_time" not in names:
        named = named.withColumn("time_ms", millis_text(F.col("time_ms"))).withColumnRenamed("time_ms", "event_time")
    return named


def with_defaults(df: DataFrame, defaults: dict[str, int] = DEFAULT_FLAGS) -> DataFrame:
    missing = {n: F.lit(v) for n, v in defaults.items() if n not in df.columns}
    return df.withColumns(missing) if missing else df


def standardize(df: DataFrame, time_type: str = "timestamp") -> DataFrame:
    """Source log in milliseconds to the standard log in seconds."""
    require_columns(df, ["time_ms", "play_time_ms", "duration_ms", "is_forward"])
    event_time = F.timestamp_millis(F.col("time_ms").cast("bigint"))
    if time_type == "timestamp_ntz":
        event_time = F.expr(
            "TIMESTAMP_NTZ '1970-01-01 00:00:00'"
            " + make_dt_interval(0, 0, 0, CAST(time_ms AS DECIMAL(18, 3)) / 1000)"
        )
    done = {"time_ms", "play_time_ms", "duration_ms", "is_forward"}
    return df.select(
        *(c for c in df.columns if c not in done),
        event_time.alias("event_time"),
        (F.col("play_time_ms") / F.lit(1000.0)).alias("watch_time"),
        (F.col("duration_ms") / F.lit(1000.0)).alias("duration"),
        ratio(F.col("play_time_ms").cast("double"), F.col("duration_ms").cast("double")).alias("watch_ratio"),
        F.col("is_forward").alias("is_share"),
    )


def coerce_types(df: DataFrame, time_type: str = "timestamp") -> DataFrame:
    """Unreadable values become null; null flags get their defaults."""
    typed = {
        "event_time": parse_time(df, "event_time", time_type),
        "user_id": F.col("user_id").cast("string"),
        "video_id": F.col("video_id").cast("string"),
        "watch_time": lenient(F.col("watch_time"), "double"),
        "duration": lenient(F.col("duration"), "double"),
        **{n: flag(F.col(n), v) for n, v in DEFAULT_FLAGS.items()},
    }
    if "watch_ratio" in df.columns:
        typed["watch_ratio"] = lenient(F.col("watch_ratio"), "double")
    return df.withColumns(typed)


def cast_silver(df: DataFrame, time_type: str = "timestamp") -> DataFrame:
    """The nine log columns in their silver types; nulls are kept."""
    return df.select(
        parse_time(df, "event_time", time_type).alias("event_time"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("video_id").cast("string").alias("video_id"),
        *(lenient(F.col(n), "double").alias(n) for n in ("watch_time", "duration", "watch_ratio")),
        *(lenient(F.col(n), "int").alias(n) for n in DEFAULT_FLAGS),
    )


def clean_logs(df: DataFrame, mode: str = "strict", time_type: str = "timestamp") -> DataFrame:
    """``strict`` drops over-watched rows, ``clamp`` cuts and de-duplicates them,
    ``feature`` limits the supplied ratio. Only ``strict`` keeps null times."""
    require_columns(df, LOG_COLUMNS if mode == "feature" else [c for c in LOG_COLUMNS if c != "watch_ratio"])
    if mode == "strict":
        return _strict(df, time_type)
    if mode == "clamp":
        return _clamp(df, time_type)
    if mode == "feature":
        return _feature(df, time_type)
    raise ValueError(f"unknown cleaning mode {mode!r}")


def _strict(df: DataFrame, time_type: str) -> DataFrame:
    # Plain column filters stand first so that they reach the file scan; text is typed before.
    text = {n for n, kind in df.dtypes if kind == "string"} & {"watch_time", "duration"}
    if text:
        df = df.withColumns({n: lenient(F.col(n), "double") for n in text})
    watched = ratio(F.col("watch_time"), F.col("duration"))
    kept = df.filter(
        F.col("user_id").isNotNull()
        & F.col("video_id").isNotNull()
        & (F.col("duration") > 0)
        & (F.col("watch_time") >= 0)
        & (watched <= 1)
    )
    return cast_silver(kept.withColumn("watch_ratio", watched), time_type)


def clamped(df: DataFrame, time_type: str) -> DataFrame:
    """Typed rows with the watch time cut at the duration; rows without ids, time or length are left out."""
    typed = coerce_types(df, time_type)
    kept = typed.dropna(subset=["event_time", "user_id", "video_id", "watch_time", "duration"]).filter(
        (F.col("duration") > 0) & (F.col("watch_time") >= 0)
    )
    watched = kept.withColumn("watch_time", F.least("watch_time", "duration"))
    with_ratio = watched.withColumn(
        "watch_ratio", clamp(ratio(F.col("watch_time"), F.col("duration")), 0.0, 1.0)
    )
    return with_ratio.select(*LOG_COLUMNS)


def _clamp(df: DataFrame, time_type: str) -> DataFrame:
    return dedup_logs(clamped(df, time_type))


def _feature(df: DataFrame, time_type: str) -> DataFrame:
    kept = (
        cast_silver(df, time_type)
        .dropna(subset=["event_time", "user_id", "video_id"])
        .filter((F.col("duration") > 0) & (F.col("watch_time") >= 0))
    )
    return kept.withColumn("watch_ratio", clamp(F.col("watch_ratio"), 0.0, 1.0))


def dedup_logs(df: DataFrame) -> DataFrame:
    """Rows that differ in at least one of the nine log columns.

    A distinct aggregation: each task collapses its copies before the shuffle,
    so a large group of copies costs one row per task.
    """
    return df.dropDuplicates(LOG_COLUMNS)
