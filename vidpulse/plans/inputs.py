"""Interaction logs derived from the given tables.

``events`` becomes the video log, its dirty, loose, source and message forms; the
join of ``lineitem`` and ``part`` gives a larger log with many videos.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vidpulse.operators.caching import recommend_cache
from vidpulse.operators.cleaning import clean_logs
from vidpulse.operators.features import video_features
from vidpulse.operators.replay import cache_policy
from vidpulse.operators.scoring import hot_only, score_hot
from vidpulse.session import stage
from vidpulse.sources.topic import to_messages

NTZ = "timestamp_ntz"
DAY = "1 day"

# Columns of the given tables. A known schema saves the footer job.
TABLES = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE,"
    " l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING,"
    " l_shipdate TIMESTAMP_NTZ",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,"
    " o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def video_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_type")
    # A one-element generator: filters on the video or the duration stay above it,
    # so the JSON is read once per row instead of once per use.
    video = F.explode(F.array(F.get_json_object("props", "$.k").cast("int")))
    keyed = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value", "event_type", video.alias("k"))
    timed = keyed.withColumn("duration", (30 + 10 * (F.col("k") % 20)).cast("double"))
    return timed.select(
        "event_id",
        F.col("ts").alias("event_time"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("k").cast("string").alias("video_id"),
        F.col("value").alias("watch_time"),
        "duration",
        (F.col("value") / F.col("duration")).alias("watch_ratio"),
        F.when(event == "click", 1).otherwise(0).alias("is_click"),
        F.when(event == "purchase", 1).otherwise(0).alias("is_like"),
        F.when(event == "signup", 1).otherwise(0).alias("is_share"),
    )


def dirty_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The video log with copies, unreadable times, nulls and impossible values."""
    clean = video_log(spark, sf_dir)
    every = lambda n: F.col("event_id") % n == 0
    doubled = clean.unionByName(clean.filter(every(50)))
    return doubled.select(
        "event_id",
        F.when(every(101), "not-a-time").otherwise(F.col("event_time").cast("string")).alias("event_time"),
        F.when(~every(97), F.col("user_id")).alias("user_id"),
        F.when(~every(89), F.col("video_id")).alias("video_id"),
        F.when(every(83), -1.0).when(~every(79), F.col("watch_time")).alias("watch_time"),
        F.when(every(73), 0.0).otherwise(F.col("duration")).alias("duration"),
        "watch_ratio",
        F.when(~every(71), F.col("is_click")).alias("is_click"),
        "is_like",
        "is_share",
    )


def text_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty log as text fields, some of them unreadable."""
    dirty = dirty_log(spark, sf_dir)
    return dirty.select(
        *(
            (F.coalesce(F.col(c).cast("string"), F.lit("n/a")) if c in ("watch_time", "is_click") else F.col(c))
            .cast("string")
            .alias(c)
            for c in dirty.columns
        )
    )


def loose_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty log under alias names and without flags."""
    return dirty_log(spark, sf_dir).select(
        "event_id",
        F.col("event_time").alias("time"),
        F.col("user_id").alias("UserId"),
        F.col("video_id").alias(" ITEM_ID "),
        F.col("watch_time").alias("play_time"),
        "duration",
    )


def source_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The video log in the units of the source: milliseconds everywhere."""
    return video_log(spark, sf_dir).select(
        "event_id",
        "user_id",
        "video_id",
        F.expr("timestampdiff(MILLISECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', event_time)").alias("time_ms"),
        F.round(F.col("watch_time") * 1000).cast("bigint").alias("play_time_ms"),
        F.when(F.col("event_id") % 73 == 0, F.lit(0).cast("bigint"))
        .otherwise((F.col("duration") * 1000).cast("bigint"))
        .alias("duration_ms"),
        "is_click",
        "is_like",
        F.col("is_share").alias("is_forward"),
    )


def export_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw export as text: times in milliseconds, other names, some values unreadable."""
    return source_log(spark, sf_dir).select(
        F.when(F.col("event_id") % 101 == 0, F.lit("soon")).otherwise(F.col("time_ms").cast("string")).alias("time_ms"),
        F.col("user_id").alias("UserId"),
        F.col("video_id").alias("Item_id"),
        (F.col("play_time_ms") / 1000.0).cast("string").alias("play_time"),
        (F.col("duration_ms") / 1000.0).cast("string").alias("duration"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The video log as requests; the event's value stands for the measured latency."""
    return video_log(spark, sf_dir).withColumn("latency_ms", F.col("watch_time").cast("int"))


def topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The video log as the messages of a topic with three partitions."""
    logs = video_log(spark, sf_dir).select(
        "*",
        F.pmod(F.col("video_id").cast("int"), F.lit(3)).alias("partition"),
        F.col("event_id").alias("offset"),
    )
    return to_messages(logs, keep=("event_id", "partition", "offset"))


def broken_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The topic with some payloads that are no JSON and some with a wrong field."""
    text = F.col("value").cast("string")
    return topic(spark, sf_dir).withColumn(
        "value",
        F.when(F.col("event_id") % 101 == 0, F.lit("{not json"))
        .when(F.col("event_id") % 97 == 0, F.regexp_replace(text, '"user_id":[0-9]+', '"user_id":"x"'))
        .otherwise(text)
        .cast("binary"),
    )


def strict_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_logs(video_log(spark, sf_dir), "strict", NTZ)


def day_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-day features, written once: scoring reads them several times."""
    return stage(video_features(strict_log(spark, sf_dir), DAY), "features")


def predictions(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return score_hot(day_features(spark, sf_dir), **options)


def recommendations(spark: SparkSession, sf_dir: str, ordered: bool = False) -> DataFrame:
    return recommend_cache(predictions(spark, sf_dir), ordered=ordered)


def hot_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hot_only(predictions(spark, sf_dir))


def policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written, so that the planner knows how large it is."""
    return stage(cache_policy(hot_rows(spark, sf_dir)), "policy")


def messy_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions as text with unreadable numbers and labels out of step."""
    return predictions(spark, sf_dir).selectExpr(*messy_columns("STRING"))


def messy_columns(text: str) -> list[str]:
    """Select list valid in both SQL dialects; ``text`` is the name of the text type."""
    digit = "CAST(video_id AS INT) % 10"
    return [
        "video_id",
        "window_start",
        "window_end",
        f"CASE WHEN {digit} = 3 THEN 'n/a' WHEN {digit} = 2 THEN 'inf' WHEN {digit} = 1 THEN '1e30' ELSE concat(CAST(views_count AS {text}), '.7') END AS views_count",
        f"CAST(unique_users AS {text}) AS unique_users",
        f"CASE WHEN {digit} = 9 THEN NULL ELSE CAST(avg_watch_ratio AS {text}) END AS avg_watch_ratio",
        f"CAST(growth_rate AS {text}) AS growth_rate",
        f"CAST(engagement_count AS {text}) AS engagement_count",
        f"CASE WHEN {digit} = 4 THEN NULL ELSE CAST(hot_score AS {text}) END AS hot_score",
        f"CASE WHEN {digit} = 5 THEN '' ELSE CAST(predicted_hot AS {text}) END AS predicted_hot",
        f"CASE WHEN {digit} = 6 THEN 'hot' WHEN {digit} = 7 THEN 'maybe' WHEN {digit} = 8 THEN NULL"
        " ELSE lower(hot_label) END AS hot_label",
    ]


def big_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as views: one video per part, one user per supplier."""
    items = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    flag = F.col("l_returnflag")
    duration = F.col("p_size").cast("double")
    return items.join(parts, items["l_partkey"] == parts["p_partkey"]).select(
        F.col("l_shipdate").alias("event_time"),
        F.col("l_suppkey").cast("string").alias("user_id"),
        F.col("l_partkey").cast("string").alias("video_id"),
        F.col("l_quantity").alias("watch_time"),
        duration.alias("duration"),
        F.try_divide(F.col("l_quantity"), duration).alias("watch_ratio"),
        F.lit(1).alias("is_click"),
        (flag == "R").cast("int").alias("is_like"),
        (flag == "A").cast("int").alias("is_share"),
    )
