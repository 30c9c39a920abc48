import datetime

import pytest
from pyspark.sql import functions as F

from vidpulse.operators import replay
from vidpulse.session import stage

DAY = datetime.datetime(2024, 1, 1)
HOT_ROWS = (
    "video_id string, window_start timestamp_ntz, window_end timestamp_ntz, views_count bigint, unique_users bigint,"
    " hot_score double, hot_label string"
)


def hot(spark, *rows):
    return spark.createDataFrame(
        [(v, DAY + datetime.timedelta(days=d), DAY + datetime.timedelta(days=d + 1), 1, 1, s, "HOT") for v, d, s in rows],
        HOT_ROWS,
    )


def requests(spark, n=400, videos=10):
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return spark.range(n).select(
        F.col("id").alias("event_id"),
        (start + F.make_dt_interval(secs=F.pmod(F.col("id") * 7, F.lit(50)))).alias("event_time"),
        F.pmod(F.col("id"), F.lit(videos)).cast("string").alias("video_id"),
        (F.col("id") % 90 + 10).cast("int").alias("latency_ms"),
    )


def test_policy_keeps_the_best_window(spark):
    rows = replay.cache_policy(hot(spark, ("a", 0, 0.5), ("a", 1, 0.9), ("a", 2, 0.9), ("b", 0, None)))
    got = {r["video_id"]: (r["window_start"].day, r["hot_score"]) for r in rows.collect()}
    assert got == {"a": (2, 0.9), "b": (1, 0.0)}
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan  # cut before the shuffle


def test_hit_and_miss_columns(spark):
    log = replay.serve_requests(requests(spark), replay.cache_policy(hot(spark, ("3", 0, 0.8))))
    hits = log.filter("video_id = '3'").collect()
    misses = log.filter("video_id <> '3'").collect()
    assert len(hits) == 40 and len(misses) == 360
    assert {(r["status"], r["served_from"], r["cache_decision"], r["hot_label"], r["hot_score"]) for r in hits} == {
        ("CACHE_HIT", "EDGE_CACHE", "CACHE", "HOT", 0.8)
    }
    assert {r["window_start"] for r in hits} == {"2024-01-01 00:00:00"}
    assert {(r["status"], r["window_start"], r["window_end"], r["hot_label"], r["hot_score"]) for r in misses} == {
        ("CACHE_MISS", "", "", "NOT_HOT", 0.0)
    }
    assert all(r["latency_ms"] == r["event_id"] % 90 + 10 for r in hits + misses)


def test_written_policy_is_broadcast_by_its_size(spark):
    policy = stage(replay.cache_policy(hot(spark, ("3", 0, 0.8))), "policy")
    plan = replay.serve_requests(requests(spark), policy)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        log = replay.serve_requests(requests(spark), policy)
        assert "SortMergeJoin" in log._jdf.queryExecution().executedPlan().toString()
        assert log.filter("status = 'CACHE_HIT'").count() == 40
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_miss_pool(spark):
    logs = requests(spark).unionByName(
        requests(spark, 1).withColumn("video_id", F.lit(None).cast("string"))
    )
    none = hot(spark)
    assert replay.miss_pool(logs, none).count() == 10
    policy = replay.cache_policy(hot(spark, ("3", 0, 0.8), ("zz", 0, 0.8)))
    assert sorted(r[0] for r in replay.miss_pool(logs, policy).collect()) == list("012456789")
    everything = replay.cache_policy(hot(spark, *((str(i), 0, 0.5) for i in range(10))))
    assert replay.miss_pool(logs, everything).count() == 0


def test_replay_numbers_requests_and_runs_statistics(spark):
    policy = replay.cache_policy(hot(spark, ("3", 0, 0.8), ("4", 0, 0.7)))
    log = replay.replay_policy(requests(spark), policy).orderBy("request_id").collect()
    assert [r["request_id"] for r in log] == list(range(1, 401))
    assert [(r["event_time"], r["event_id"]) for r in log] == sorted((r["event_time"], r["event_id"]) for r in log)
    hits = total = 0
    for i, row in enumerate(log, 1):
        hits += row["status"] == "CACHE_HIT"
        total += row["latency_ms"]
        assert row["current_cache_hit_ratio"] == pytest.approx(hits / i, abs=6e-7)
        assert row["current_avg_latency_ms"] == pytest.approx(total / i, abs=6e-5)


def test_request_stats(spark):
    all_hot = hot(spark, ("3", 0, 0.8), ("3", 1, 0.9))
    policy = replay.cache_policy(all_hot)
    log = replay.serve_requests(requests(spark), policy)
    stats = replay.request_stats(log, all_hot, policy).first()
    assert (stats["total_requests"], stats["cache_hits"], stats["cache_misses"]) == (400, 40, 360)
    assert stats["cache_hit_ratio"] == 0.1
    assert (stats["hot_video_window_records"], stats["cached_unique_videos"]) == (2, 1)
    assert (stats["cache_latency_range_ms"], stats["origin_latency_range_ms"]) == ("13-93", "10-99")
    empty = replay.request_stats(log.filter("false"), all_hot, policy).first()
    assert (empty["total_requests"], empty["cache_hit_ratio"], empty["average_latency_ms"]) == (0, 0.0, 0.0)


def test_request_sets(spark):
    policy = replay.cache_policy(hot(spark, *((str(i), 0, i / 10) for i in range(6))))
    mixed = replay.stratified_requests(requests(spark), policy, 33, 0.4)
    assert mixed.filter("int(video_id) < 6").count() == 13 and mixed.count() == 33
    viral = replay.viral_requests(requests(spark), policy, 50, 2, 0.9)
    assert viral.filter("video_id IN ('4', '5')").count() == 45 and viral.count() == 50
    many = replay.stratified_requests(requests(spark), policy, 3000, 0.4)
    assert many.count() == 3000 and many.filter("int(video_id) < 6").count() == 1200


def test_bounds(spark):
    policy = hot(spark, ("3", 0, 0.8))
    with pytest.raises(ValueError):
        replay.top_videos(policy, 0)
    with pytest.raises(ValueError):
        replay.stratified_requests(requests(spark), policy, 10, 1.5)
