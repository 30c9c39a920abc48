import datetime

import pytest
from pyspark.sql import functions as F

from vidpulse.operators import caching
from vidpulse.schemas import RECOMMENDATION_COLUMNS, CostModel

DAY = datetime.datetime(2024, 1, 1)
COLUMNS = (
    "video_id string, window_start timestamp_ntz, window_end timestamp_ntz, views_count string, unique_users string,"
    " avg_watch_ratio string, growth_rate string, engagement_count string, hot_score string, predicted_hot string,"
    " hot_label string"
)

# The report for 153,342 requests of which 1,774 hit.
KNOWN_KPIS = {
    "total_requests": 153342.0,
    "cache_hits": 1774.0,
    "cache_misses": 151568.0,
    "watchlist_requests": 7600.0,
    "cache_hit_ratio": 0.011569,
    "origin_request_reduction": 0.011569,
    "average_latency_without_cache": 300.0,
    "average_latency_with_cache": 297.1078,
    "latency_reduction_ms": 2.8922,
    "latency_reduction_percent": 0.009641,
    "estimated_bandwidth_saved": 34.6484,
    "estimated_cost_saved": 0.693,
    "num_cache_records": 766.0,
    "num_watchlist_records": 3789.0,
    "num_no_cache_records": 71978.0,
    "num_unique_cached_videos": 766.0,
    "num_unique_total_videos": 71619.0,
    "origin_latency_ms_assumption": 300.0,
    "cache_latency_ms_assumption": 50.0,
    "average_request_size_mb_assumption": 20.0,
    "cost_per_gb_assumption": 0.02,
}


def prediction(video, score, predicted="0", label="NOT_HOT", views="1"):
    return (video, DAY, DAY, views, "1", "0.5", "1", "0", score, predicted, label)


def table(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


def test_report_of_known_totals(spark):
    names = [
        "total_requests", "cache_hits", "watchlist_requests", "num_cache_records", "num_watchlist_records",
        "num_no_cache_records", "num_unique_cached_videos", "num_unique_total_videos",
    ]
    totals = spark.range(1).select(*(F.lit(int(KNOWN_KPIS[n])).alias(n) for n in names))
    rows = caching.kpi_report(caching.derive_kpis(totals)).collect()
    assert {r["metric"]: r["value"] for r in rows} == KNOWN_KPIS
    assert [r["metric"] for r in rows] == list(KNOWN_KPIS)
    assert {r["unit"] for r in rows} == {"requests", "ratio", "ms", "GB", "USD", "records", "videos", "MB", "USD/GB"}


def test_coercion_truncates_and_fills(spark):
    row = caching.coerce_predictions(
        table(spark, [("v", DAY, DAY, "3.9", "x", None, "NaN", "-2.7", "", "1.0", "hot")])
    ).first()
    assert (row["views_count"], row["unique_users"], row["engagement_count"]) == (3, 0, -2)
    assert (row["avg_watch_ratio"], row["growth_rate"], row["hot_score"]) == (0.0, 0.0, 0.0)
    assert (row["predicted_hot"], row["hot_label"]) == (1, "HOT")


def test_label_repair(spark):
    rows = [
        prediction("forced", "1", "1", "NOT_HOT"),
        prediction("kept", "1", "0", "HOT"),
        prediction("other", "1", "0", "maybe"),
        prediction("empty", "1", "0", None),
        prediction("two", "1", "2", "odd"),
    ]
    ready = caching.reconcile_labels(caching.coerce_predictions(table(spark, rows)))
    assert {r["video_id"]: r["hot_label"] for r in ready.collect()} == {
        "forced": "HOT", "kept": "HOT", "other": "NOT_HOT", "empty": "NOT_HOT", "two": "ODD",
    }


def test_decisions_priorities_ranks_and_order(spark):
    rows = [prediction(f"v{i:03d}", str(i), views=str(i)) for i in range(100)]
    rows[99] = prediction("v099", "99", "1", "HOT")
    rows[10] = prediction("v010", "10", "1", "HOT")
    result = caching.recommend_cache(table(spark, rows)).collect()
    assert list(result[0].asDict()) == RECOMMENDATION_COLUMNS
    by_video = {r["video_id"]: r for r in result}
    assert by_video["v099"]["cache_priority"] == "VERY_HIGH" and by_video["v099"]["cache_rank"] == 1
    assert by_video["v010"]["cache_decision"] == "CACHE" and by_video["v010"]["cache_priority"] == "HIGH"
    watch = sorted(v for v, r in by_video.items() if r["cache_decision"] == "WATCHLIST")
    assert watch == ["v094", "v095", "v096", "v097", "v098"]
    assert by_video["v000"]["cache_priority"] == "LOW" and by_video["v094"]["cache_priority"] == "MEDIUM"
    assert [r["video_id"] for r in result[:3]] == ["v099", "v010", "v098"]
    assert sorted(r["cache_rank"] for r in result) == list(range(1, 101))
    assert by_video["v094"]["reason"].startswith("High hot_score")


def test_all_hot_uses_every_row_for_the_watchlist(spark):
    rows = [prediction(str(i), str(i), "1", "HOT") for i in range(21)]
    ready = caching.coerce_predictions(table(spark, rows))
    assert caching.cache_thresholds(ready)["watchlist"] == 19.0


def test_equal_scores_rank_by_video_and_window(spark):
    rows = [prediction(v, "0.5") for v in ("c", "a", "b")]
    ranked = caching.with_cache_rank(caching.coerce_predictions(table(spark, rows))).orderBy("cache_rank")
    assert [r["video_id"] for r in ranked.collect()] == ["a", "b", "c"]


def test_report_of_nothing(spark):
    decided = caching.decide(caching.coerce_predictions(table(spark, [])))
    values = {r["metric"]: r["value"] for r in caching.evaluate_cache(decided).collect()}
    assert len(values) == 21 and values["total_requests"] == 0
    assert values["cache_hit_ratio"] == 0 and values["average_latency_with_cache"] == 0
    assert caching.recommend_cache(table(spark, [])).count() == 0


def test_cost_model_and_chart_tables(spark):
    rows = [prediction("a", "9", "1", "HOT", "30"), prediction("b", "1", views="70")]
    decided = caching.decide(caching.reconcile_labels(caching.coerce_predictions(table(spark, rows))))
    costs = CostModel(200, 100, 1024, 0.5)
    values = {r["metric"]: r["value"] for r in caching.evaluate_cache(decided, costs).collect()}
    assert values["average_latency_with_cache"] == 170 and values["estimated_cost_saved"] == 15
    percent = {r["metric"]: r["percent"] for r in caching.kpi_percent(decided, costs).collect()}
    assert percent["Cache Hit Ratio"] == pytest.approx(30) and percent["Latency Reduction"] == pytest.approx(15)
    assert {r["type"]: r["requests"] for r in caching.hits_and_misses(decided).collect()} == {
        "Cache Hits": 30, "Cache Misses": 70,
    }
    assert [r["latency_ms"] for r in caching.latency_comparison(decided, costs).collect()] == [200, 170]
    assert caching.top_decided(decided).first()["video_id"] == "a"


@pytest.mark.parametrize("n", [0, -1])
def test_top_cached_bounds(spark, n):
    with pytest.raises(ValueError):
        caching.top_cached(spark.range(1), n)
