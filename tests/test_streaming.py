"""Topic -> bronze -> silver -> features as streams over files."""

import json

import pytest
from pyspark.sql import functions as F

from vidpulse.operators.cleaning import clean_logs
from vidpulse.operators.features import video_features
from vidpulse.operators.replay import cache_policy, serve_requests
from vidpulse.operators.scoring import score_hot
from vidpulse.plans import inputs
from vidpulse.schemas import SILVER
from vidpulse.session import stage
from vidpulse.sources.sinks import EmptyResult, publish, write_table, write_topic
from vidpulse.sources.tables import read_table
from vidpulse.sources.topic import parse_messages, peek_topic, read_topic_batch, to_messages
from vidpulse.streaming.features import grown_cells, rescore_each_batch, stream_cells
from vidpulse.streaming.medallion import append_available, drain, run_bronze, run_silver, write_stream


def messages(spark, sf_dir):
    """Topic rows in event-time order with the broker's columns."""
    logs = inputs.video_log(spark, sf_dir).select(
        "*",
        F.pmod(F.col("video_id").cast("int"), F.lit(3)).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("event_time").cast("timestamp").alias("timestamp"),
    )
    return to_messages(logs, keep=("partition", "offset", "timestamp"))


def fill(spark, sf_dir, topic, low, high):
    part = messages(spark, sf_dir).filter((F.col("offset") >= low) & (F.col("offset") < high))
    return write_topic(part.orderBy("offset").coalesce(1), topic, fmt="parquet")


@pytest.fixture(scope="module")
def medallion(spark, sf_dir, tmp_path_factory):
    """Bronze and silver after two rounds of new messages, and the reports."""
    root = tmp_path_factory.mktemp("medallion")
    paths = {n: str(root / n) for n in ("topic", "bronze", "silver", "bronze_cp", "silver_cp")}
    reports = []
    for low, high in ((0, 400), (400, 10**9), (10**9, 10**9 + 1)):
        if low < 10**9:
            fill(spark, sf_dir, paths["topic"], low, high)
        bronze = run_bronze(spark, paths["topic"], paths["bronze"], paths["bronze_cp"], topic_fmt="parquet")
        silver = run_silver(spark, paths["bronze"], paths["silver"], paths["silver_cp"])
        reports.append((bronze, silver))
    return paths, reports


def test_rerun_adds_only_new_rows(medallion):
    _, reports = medallion
    assert [b.rows for b, _ in reports] == [400, 600, 0]
    gained = [s.rows for _, s in reports]
    assert gained[0] > 0 and gained[1] > 0 and gained[2] == 0
    assert [s.errors for _, s in reports][1:] == [1000 - sum(gained)] * 2


def test_silver_stream_equals_batch_cleaning(spark, sf_dir, medallion):
    paths, _ = medallion
    silver = read_table(spark, paths["silver"])
    assert [(f.name, f.dataType) for f in silver.schema] == [(f.name, f.dataType) for f in SILVER]
    expected = clean_logs(parse_messages(messages(spark, sf_dir)), "strict")
    assert silver.exceptAll(expected).count() == 0 and expected.exceptAll(silver).count() == 0


def test_bronze_keeps_malformed_payloads(spark, tmp_path):
    topic = str(tmp_path / "topic")
    good = json.dumps({"event_time": "2024-01-01 00:00:00", "user_id": 1, "video_id": 2, "watch_time": 1.0,
                       "duration": 2.0, "watch_ratio": None, "is_click": 1, "is_like": 0, "is_share": 0})
    bad_field = good.replace('"user_id": 1', '"user_id": "x"')
    rows = [(b"2", v.encode(), 0, i) for i, v in enumerate([good, "{oops", bad_field])]
    df = spark.createDataFrame(rows, "key binary, value binary, partition int, offset bigint")
    write_topic(df.withColumn("timestamp", F.current_timestamp()), topic, fmt="parquet")
    run_bronze(spark, topic, str(tmp_path / "b"), str(tmp_path / "cp"), topic_fmt="parquet")
    got = read_table(spark, str(tmp_path / "b")).orderBy("offset").collect()
    assert [r["raw_data"] for r in got] == [good, "{oops", bad_field]
    assert [r["video_id"] for r in got] == [2, None, 2] and [r["user_id"] for r in got] == [1, None, None]
    silver = run_silver(spark, str(tmp_path / "b"), str(tmp_path / "s"), str(tmp_path / "cp2"))
    assert (silver.rows, silver.errors) == (1, 2)


def test_peek(spark, sf_dir, medallion):
    paths, _ = medallion
    first = peek_topic(read_topic_batch(spark, paths["topic"], fmt="parquet"), 4).collect()
    assert [r["partition"] for r in first] == [0] * 4
    assert [r["offset"] for r in first] == sorted(r["offset"] for r in first)


@pytest.fixture(scope="module")
def ordered(spark, medallion, tmp_path_factory):
    """Silver as one file per half month, so that the watermark never runs ahead."""
    source = str(tmp_path_factory.mktemp("ordered") / "silver")
    silver = read_table(spark, medallion[0]["silver"])
    for half in (F.col("event_time") < "2024-01-15", F.col("event_time") >= "2024-01-15"):
        silver.filter(half).orderBy("event_time").coalesce(1).write.mode("append").parquet(source)
    return source


def stream_of(spark, source):
    return spark.readStream.schema(SILVER).option("maxFilesPerTrigger", 1).parquet(source)


def test_streamed_cells_equal_batch_on_closed_windows(spark, ordered, tmp_path):
    silver = read_table(spark, ordered)
    target = str(tmp_path / "cells")
    report = append_available(stream_cells(stream_of(spark, ordered), "1 day"), target, str(tmp_path / "cp"))
    streamed = grown_cells(read_table(spark, target))
    last = streamed.agg(F.max("window_start")).first()[0]
    batch = video_features(silver, "1 day").filter(F.col("window_start") <= last)
    assert report.rows == streamed.count() == batch.count() > 0
    exact = ["video_id", "window_start", "window_end", "views_count", "unique_users", "growth_rate", "engagement_count"]
    assert streamed.select(*exact).exceptAll(batch.select(*exact)).count() == 0


def test_rescoring_after_each_batch(spark, ordered, tmp_path):
    cells, predictions = str(tmp_path / "cells"), str(tmp_path / "predictions")
    rescore_each_batch(
        stream_cells(stream_of(spark, ordered), "1 day"), cells, predictions, str(tmp_path / "cp")
    ).awaitTermination()
    features = stage(grown_cells(read_table(spark, cells).drop("batch_id")), "expected")
    got = read_table(spark, predictions)
    assert got.count() == features.count() > 0
    assert got.exceptAll(score_hot(features)).count() == 0


def test_requests_on_a_stream(spark, medallion, tmp_path):
    paths, _ = medallion
    silver = read_table(spark, paths["silver"])
    features = video_features(silver.withColumn("event_time", F.col("event_time").cast("timestamp_ntz")), "1 day")
    hot = score_hot(stage(features, "features")).filter("hot_label = 'HOT'")
    policy = stage(cache_policy(hot), "policy")
    stream = spark.readStream.schema(SILVER).parquet(paths["silver"])
    served = serve_requests(stream, policy)
    log, checkpoint = str(tmp_path / "log"), str(tmp_path / "cp")
    drain(write_stream(served, log, checkpoint))
    drain(write_stream(served, log, checkpoint))
    expected = serve_requests(silver, policy)
    got = read_table(spark, log)
    assert got.count() == expected.count()
    assert got.exceptAll(expected).count() == 0


def test_publish_replaces_only_whole_results(spark, tmp_path):
    path = str(tmp_path / "table")
    assert publish(spark.range(5), path).rows == 5
    assert publish(spark.range(7), path).rows == 7
    with pytest.raises(EmptyResult):
        publish(spark.range(3).filter("id > 10"), path)
    broken = spark.range(3).select(F.raise_error(F.lit("boom")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="boom"):
        publish(broken, path)
    assert read_table(spark, path).count() == 7
    assert [p.name for p in tmp_path.iterdir()] == ["table"]
    assert publish(spark.range(0), path, allow_empty=True).rows == 0


def test_write_table_formats(spark, tmp_path):
    report = write_table(spark.range(3).withColumn("day", F.lit("d1")), str(tmp_path / "t"), partition_by="day")
    assert report.rows == 3 and report.rows_per_second > 0
    assert (tmp_path / "t" / "day=d1").is_dir()
    write_table(spark.range(2), str(tmp_path / "c"), fmt="csv")
    assert read_table(spark, str(tmp_path / "c"), "csv", spark.range(0).schema).count() >= 2


def test_null_ratio_stays_an_explicit_null(spark):
    df = spark.createDataFrame(
        [("2024-01-01 00:00:00", "5", "6", 1.23456, 2.0, None, 1, 0, 0)],
        "event_time string, user_id string, video_id string, watch_time double, duration double,"
        " watch_ratio double, is_click int, is_like int, is_share int",
    )
    row = to_messages(df).first()
    assert bytes(row["key"]) == b"6"
    value = json.loads(bytes(row["value"]))
    assert value["watch_ratio"] is None and value["watch_time"] == 1.235 and value["user_id"] == 5


def test_peek_is_a_top_n(spark, sf_dir):
    plan = peek_topic(messages(spark, sf_dir), 4)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_silver_by_day_prunes_partitions(spark, medallion, tmp_path):
    paths, reports = medallion
    path = str(tmp_path / "by_day")
    report = run_silver(spark, paths["bronze"], path, str(tmp_path / "cp"), by_day=True)
    assert report.rows == sum(s.rows for _, s in reports)
    day = read_table(spark, path).filter("event_date = DATE '2024-01-05'")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    expected = read_table(spark, paths["silver"]).filter("to_date(event_time) = DATE '2024-01-05'")
    assert day.drop("event_date").exceptAll(expected).count() == 0 and day.count() == expected.count() > 0
