import datetime

import pytest
from pyspark.sql import functions as F

from vidpulse.operators import features

COLUMNS = (
    "event_time timestamp_ntz, user_id string, video_id string, watch_time double, duration double,"
    " watch_ratio double, is_click int, is_like int, is_share int"
)


def at(hour, minute=0, day=1):
    return datetime.datetime(2024, 1, day, hour, minute)


def view(time, user="u1", video="v1", ratio=0.5, like=0, share=0):
    return (time, user, video, 5.0, 10.0, ratio, 1, like, share)


def by_window(df):
    return {(r["video_id"], r["window_start"]): r for r in df.collect()}


def test_windows_users_means_and_growth(spark):
    df = spark.createDataFrame(
        [
            view(at(10, 0), "a", ratio=0.2, like=1),
            view(at(10, 29), "a", ratio=0.4, share=1),
            view(at(10, 30), "b"),  # on the edge: belongs to the next window
            view(at(12, 0), "a"),
            view(at(12, 1), "b"),
            view(at(12, 2), "c", ratio=None),
            view(at(10, 5), "a", video="v2"),
            view(None, "a"),
        ],
        COLUMNS,
    )
    rows = by_window(features.video_features(df))
    assert len(rows) == 4
    first = rows["v1", at(10)]
    assert (first["views_count"], first["unique_users"], first["engagement_count"]) == (2, 1, 2)
    assert first["avg_watch_ratio"] == pytest.approx(0.3) and first["window_end"] == at(10, 30)
    assert first["growth_rate"] == 2.0
    assert rows["v1", at(10, 30)]["growth_rate"] == -0.5
    # The previous window is the previous one with views, two empty ones back.
    assert rows["v1", at(12)]["growth_rate"] == 2.0
    assert rows["v1", at(12)]["avg_watch_ratio"] == 0.5
    assert rows["v2", at(10)]["growth_rate"] == 1.0


def test_null_flag_counts_differ_between_the_two_engagements(spark):
    df = spark.createDataFrame([view(at(1), like=1, share=None), view(at(1), like=1, share=1)], COLUMNS)
    assert features.video_features(df).first()["engagement_count"] == 2
    split = features.video_features(df, split_engagement=True).first()
    assert (split["like_count"], split["share_count"], split["engagement_count"]) == (2, 1, 3)
    assert split["previous_views"] == 0


def skewed(spark):
    """A third of the views on one video and window, many users, several days."""
    hot = F.col("id") % 3 == 0
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    seconds = F.when(hot, 60).otherwise(F.pmod(F.xxhash64("id"), F.lit(3 * 86400)))
    return spark.range(6000).select(
        (start + F.make_dt_interval(secs=seconds)).alias("event_time"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(900)).cast("string").alias("user_id"),
        F.when(hot, "hot").otherwise(F.pmod(F.col("id"), F.lit(50)).cast("string")).alias("video_id"),
        F.lit(5.0).alias("watch_time"),
        F.lit(10.0).alias("duration"),
        F.lit(0.5).alias("watch_ratio"),
        F.lit(1).alias("is_click"),
        (F.col("id") % 2).cast("int").alias("is_like"),
        F.lit(0).alias("is_share"),
    )


@pytest.mark.parametrize("window", ["30 minutes", "1 day", "7 days"])
def test_users_are_counted_exactly(spark, window):
    logs = skewed(spark)
    rows = features.video_features(logs, window)
    plain = features.windowed(logs, window).groupBy("video_id", "window_start")
    expected = plain.agg(F.count("*").alias("views_count"), F.count_distinct("user_id").alias("unique_users"))
    columns = ["video_id", "window_start", "views_count", "unique_users"]
    assert rows.select(columns).exceptAll(expected.select(columns)).count() == 0
    assert rows.agg(F.sum("views_count")).first()[0] == 6000


def test_log_rows_are_added_up_before_every_exchange(spark, sf_dir):
    logs = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(
        "ts AS event_time", "user_id", "event_type AS video_id", "value AS watch_time",
        "value AS watch_ratio", "0 AS is_like", "0 AS is_share",
    )
    plan = features.video_features(logs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and plan.count("Exchange hashpartitioning") == 3
    assert plan.count("partial_sum(watch_time") == 1 and "Join" not in plan


def test_a_dominant_user_sends_no_raw_rows(spark):
    logs = skewed(spark).withColumn("user_id", F.when(F.col("video_id") == "hot", "one").otherwise(F.col("user_id")))
    df = features.video_features(logs.repartition(4))
    hot = df.filter("video_id = 'hot'").first()
    assert (hot["views_count"], hot["unique_users"]) == (2000, 1)


def test_approximate_users(spark):
    rows = features.video_features(skewed(spark), "1 day", approx_users=True)
    hot = rows.filter("video_id = 'hot'").first()
    exact = skewed(spark).filter("video_id = 'hot'").select("user_id").distinct().count()
    assert hot["unique_users"] == pytest.approx(exact, rel=0.15)


def test_empty_log(spark):
    assert features.video_features(spark.createDataFrame([], COLUMNS)).count() == 0
