"""State that follows a stream: growth, running figures, labels, copies, progress, offsets."""

import threading

import pytest
from pyspark.sql import functions as F

from vidpulse.operators import replay
from vidpulse.operators.cleaning import clean_logs
from vidpulse.operators.features import video_features
from vidpulse.operators.incremental import HotStore
from vidpulse.operators.scoring import score_hot
from vidpulse.plans import inputs
from vidpulse.session import stage, staging
from vidpulse.sources import manifest
from vidpulse.sources.sinks import write_topic
from vidpulse.sources.tables import read_table
from vidpulse.sources.topic import peek_topic, read_topic_batch
from vidpulse.streaming import medallion, progress
from vidpulse.streaming.features import stream_cells
from vidpulse.streaming.medallion import append_available, drain, run_bronze, run_silver, write_stream
from vidpulse.streaming.stateful import (
    label_each_batch,
    late_rows,
    read_running_stats,
    running_stats_each_batch,
    state_rows,
    stream_clamped,
    stream_growth,
)

CELL = (
    "video_id string, window_start timestamp, window_end timestamp, views_count bigint, unique_users bigint,"
    " avg_watch_ratio double, avg_watch_time double, engagement_count bigint"
)


def cell_rows(spark, rows):
    """Cells from (video, day, views)."""
    cells = spark.createDataFrame(rows, "video_id string, day int, views_count bigint")
    start = F.timestamp_add("DAY", F.col("day"), F.lit("2024-01-01").cast("timestamp"))
    return cells.select(
        "video_id", start.alias("window_start"), (start + F.expr("INTERVAL 1 DAY")).alias("window_end"), "views_count",
        F.lit(1).cast("bigint").alias("unique_users"), F.lit(0.5).alias("avg_watch_ratio"), F.lit(1.0).alias("avg_watch_time"),
        F.lit(0).cast("bigint").alias("engagement_count"),
    )


def grown(spark, tmp_path, batches, **options):
    folder = str(tmp_path / "cells")
    for rows in batches:
        cell_rows(spark, rows).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(CELL).parquet(folder)
        append_available(stream_growth(stream, **options), str(tmp_path / "out"), str(tmp_path / "state"))
    rows = read_table(spark, str(tmp_path / "out")).selectExpr("video_id", "day(window_start) - 1 AS day", "growth_rate")
    return {(r[0], r[1]): r[2] for r in rows.collect()}


def test_growth_goes_on_over_batches(spark, tmp_path):
    batches = [[("a", 0, 4), ("b", 0, 1), ("a", 1, 6)], [("a", 5, 3), ("c", 5, 2)], [("a", 1, 99), ("b", 6, 0), ("b", 7, 5)]]
    found = grown(spark, tmp_path, batches)
    assert found == {
        ("a", 0): 4.0, ("a", 1): 0.5, ("b", 0): 1.0, ("a", 5): -0.5, ("c", 5): 2.0, ("b", 6): -1.0, ("b", 7): 5.0,
    }


def test_growth_forgets_after_a_while(spark, tmp_path):
    batches = [[("a", 0, 4), ("b", 0, 1)], [("b", 20, 2)], [("b", 21, 2)], [("a", 22, 8), ("b", 22, 1)]]
    found = grown(spark, tmp_path, batches, forget_after="10 days")
    assert found["a", 22] == 8.0 and found["b", 22] == -0.5 and found["b", 21] == 0.0


@pytest.fixture(scope="module")
def served(spark, sf_dir):
    requests = inputs.requests(spark, sf_dir).withColumn("event_time", F.col("event_time").cast("timestamp"))
    status = F.when(F.col("event_id") % 3 == 0, "CACHE_HIT").otherwise("CACHE_MISS")
    return stage(requests.select("event_id", "event_time", "latency_ms", status.alias("status")), "served")


def test_running_stats_after_a_repeated_batch(spark, served, tmp_path):
    source, log, state = (str(tmp_path / n) for n in ("in", "log", "state"))
    ordered = served.withColumn("event_time", F.timestamp_add("SECOND", F.col("event_id").cast("int"), F.lit("2024-01-01").cast("timestamp")))
    parts = (F.col("event_id") < 300, F.col("event_id").between(300, 699), F.col("event_id") >= 700)
    for part in parts:
        ordered.filter(part).write.mode("append").parquet(source)
        drain(running_stats_each_batch(spark.readStream.schema(ordered.schema).parquet(source), log, state))
    expected = replay.with_running_stats(ordered.withColumn("request_id", F.col("event_id") + 1))
    got = read_running_stats(spark, log).select(*expected.columns)
    assert got.exceptAll(expected).isEmpty() and got.count() == expected.count()
    # The last batch was written, but its commit was lost: it runs again.
    (tmp_path / "state" / "commits" / "2").unlink()
    (tmp_path / "state" / "commits" / ".2.crc").unlink(missing_ok=True)
    drain(running_stats_each_batch(spark.readStream.schema(ordered.schema).parquet(source), log, state))
    got = read_running_stats(spark, log).select(*expected.columns)
    assert got.exceptAll(expected).isEmpty() and got.count() == expected.count()


def test_running_stats_without_the_totals_before(spark, served, tmp_path):
    source, log, state = (str(tmp_path / n) for n in ("in", "log", "state"))
    for k in range(2):
        served.filter(F.col("event_id") % 2 == k).write.mode("append").parquet(source)
        query = running_stats_each_batch(spark.readStream.schema(served.schema).parquet(source), log, state)
        if k == 0:
            drain(query)
            for path in (tmp_path / "log" / "totals").rglob("*"):
                path.is_file() and path.unlink()
            (tmp_path / "log" / "totals" / "batch_id=0").rmdir()
        else:
            with pytest.raises(Exception, match="no totals of batch 0"):
                drain(query)


def test_clamped_stream_drops_copies_with_bounded_state(spark, sf_dir, tmp_path):
    dirty = stage(inputs.dirty_log(spark, sf_dir), "dirty")
    expected = clean_logs(dirty, "clamp", "timestamp")
    source = str(tmp_path / "in")
    days = [f"2024-01-{k:02d}" for k in (1, 6, 11, 16, 21, 26)] + ["2025-01-01"]
    for low, high in zip(days, days[1:]):
        part = dirty.filter((F.try_to_timestamp("event_time") >= F.lit(low)) & (F.try_to_timestamp("event_time") < F.lit(high)))
        part.coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(dirty.schema).option("maxFilesPerTrigger", 1).parquet(source)
    query = write_stream(stream_clamped(stream, "1 hour"), str(tmp_path / "out"), str(tmp_path / "state"))
    drain(query)
    got = read_table(spark, str(tmp_path / "out"))
    assert got.exceptAll(expected).isEmpty() and got.count() == expected.count()
    assert late_rows(query) == 0
    # Each batch leaves about its own rows, of six parts.
    assert max(state_rows(query)) < expected.count() / 3
    dirty.filter(F.try_to_timestamp("event_time") < F.lit("2024-01-06")).coalesce(1).write.mode("append").parquet(source)
    query = write_stream(stream_clamped(stream, "1 hour"), str(tmp_path / "out"), str(tmp_path / "state"))
    drain(query)
    assert late_rows(query) > 0 and read_table(spark, str(tmp_path / "out")).count() == got.count()


def test_labels_on_a_stream(spark, sf_dir, tmp_path):
    logs = inputs.strict_log(spark, sf_dir).withColumn("event_time", F.col("event_time").cast("timestamp"))
    source = str(tmp_path / "log")
    for low, high in (("2024-01-01", "2024-01-14"), ("2024-01-14", "2030-01-01")):
        part = logs.filter((F.col("event_time") >= low) & (F.col("event_time") < high))
        part.orderBy("event_time").coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(logs.schema).option("maxFilesPerTrigger", 1).parquet(source)
    store = HotStore(spark, str(tmp_path / "store"))
    drain(label_each_batch(stream_cells(stream, "1 day"), store, str(tmp_path / "state")))
    end = logs.agg(F.max("event_time") - F.expr("INTERVAL 10 MINUTES")).first()[0]
    batch = stage(video_features(logs, "1 day").filter(F.col("window_end") <= F.lit(end)), "features")
    assert store.model().rows == batch.count() > 0
    digits = lambda df: df.withColumns({n: F.round(n, 11) for n, t in df.dtypes if t == "double"})
    assert digits(store.predictions()).exceptAll(digits(score_hot(batch))).isEmpty()


# --- progress -----------------------------------------------------------------


def test_progress_by_batch(spark, sf_dir, tmp_path, monkeypatch):
    paths = {n: str(tmp_path / n) for n in ("topic", "bronze", "silver", "bronze-state", "silver-state")}
    messages = inputs.broken_topic(spark, sf_dir).withColumn("timestamp", F.lit("2024-01-01").cast("timestamp")).drop("event_id")
    for k in range(3):
        write_topic(messages.filter(F.col("offset") % 3 == k).coalesce(1), paths["topic"], fmt="parquet")
    run_bronze(spark, paths["topic"], paths["bronze"], paths["bronze-state"], topic_fmt="parquet")
    counted = []
    monkeypatch.setattr("vidpulse.streaming.medallion.table_rows", lambda *a: counted.append(a) or 0)
    silver = run_silver(spark, paths["bronze"], paths["silver"], paths["silver-state"], max_files=1)
    assert not counted and progress.missing(spark, paths["silver-state"]) == 0
    records = progress.batch_records(spark, paths["silver-state"]).orderBy("batch_id").collect()
    assert [r.batch_id for r in records] == [0, 1, 2] and sum(r.read for r in records) == messages.count()
    assert sum(r.written for r in records) == silver.rows == read_table(spark, paths["silver"]).count()
    assert sum(r.rejected for r in records) == silver.errors > 0 and all(r.rows_per_second > 0 for r in records)
    bronze = progress.batch_records(spark, paths["bronze-state"]).collect()
    assert sorted(r.written for r in bronze) == sorted(messages.filter(F.col("offset") % 3 == k).count() for k in range(3))
    # A record that was lost is noticed, and the tables are counted instead.
    for path in (tmp_path / "silver-state-progress").iterdir():
        path.unlink()
    run_silver(spark, paths["bronze"], paths["silver"], paths["silver-state"])
    assert len(counted) == 2


def test_a_repeated_batch_counts_once(spark, tmp_path):
    state = str(tmp_path / "state")
    record = progress.BatchRecord
    progress.keep(spark, state, [record(0, 5, 4, 1.0, 10.0), record(1, 3, 3, 1.0, 11.0)])
    progress.keep(spark, state, [record(1, 4, 2, 2.0, 12.0)])
    assert progress.totals(spark, state) == (9, 6)
    assert progress.totals(spark, str(tmp_path / "none")) == (0, 0)


# --- offsets ------------------------------------------------------------------


@pytest.fixture
def topic(spark, sf_dir, tmp_path):
    path = str(tmp_path / "topic")
    messages = inputs.topic(spark, sf_dir).withColumn("timestamp", F.lit("2024-01-01").cast("timestamp")).drop("event_id")
    for low in range(0, 1000, 250):
        part = messages.filter(F.col("offset").between(low, low + 249))
        part.repartition(3, "partition").sortWithinPartitions("offset").write.mode("append").parquet(path)
    return path


def test_peek_opens_only_the_first_files(spark, topic):
    ranges = manifest.refresh_manifest(spark, topic)
    whole = read_topic_batch(spark, topic, fmt="parquet")
    files = ranges.select("file").distinct().count()
    for n in (0, 1, 10, 130, 400, 990, 5000):
        expected = peek_topic(whole, n).collect()
        assert manifest.peek_files(spark, topic, n).collect() == expected
    one = manifest.first_files(ranges, 10)
    assert len(one) == 1 < files
    used = manifest.peek_files(spark, topic, 10).inputFiles()
    assert used == one


def test_manifest_takes_in_new_files_only(spark, topic, monkeypatch):
    before = manifest.refresh_manifest(spark, topic).collect()
    row = spark.createDataFrame([(b"1", b"{}", -1, 7)], "key binary, value binary, partition int, offset bigint")
    write_topic(row.withColumn("timestamp", F.current_timestamp()), topic, fmt="parquet")
    after = manifest.refresh_manifest(spark, topic).collect()
    assert len(set(after) - set(before)) == 1 and set(before) <= set(after)
    assert manifest.refresh_manifest(spark, topic).count() == len(after)
    assert manifest.peek_files(spark, topic, 1).first()["partition"] == -1


def test_a_batch_takes_at_most_the_offsets_of_a_file(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr("vidpulse.sources.sinks.MAX_OFFSETS_PER_TRIGGER", 100)
    messages = inputs.topic(spark, sf_dir).withColumn("timestamp", F.lit("2024-01-01").cast("timestamp")).drop("event_id")
    paths = {n: str(tmp_path / n) for n in ("topic", "bronze", "state")}
    write_topic(messages.filter(F.col("offset") < 950).coalesce(1), paths["topic"], fmt="parquet")
    run_bronze(spark, paths["topic"], paths["bronze"], paths["state"], topic_fmt="parquet")
    sizes = [r.written for r in progress.batch_records(spark, paths["state"]).collect()]
    assert len(sizes) == 10 and max(sizes) == 100 and sum(sizes) == 950


def test_logs_of_a_long_drain_stay_brief(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr("vidpulse.sources.sinks.MAX_OFFSETS_PER_TRIGGER", 2)
    monkeypatch.setattr("vidpulse.streaming.medallion.LOG_CLEANUP", "0s")
    spark.conf.set("spark.sql.streaming.minBatchesToRetain", 2)
    messages = inputs.topic(spark, sf_dir).withColumn("timestamp", F.lit("2024-01-01").cast("timestamp")).drop("event_id")
    paths = {n: str(tmp_path / n) for n in ("topic", "bronze", "state")}
    try:
        for low, high in ((0, 30), (30, 50)):
            part = messages.filter(F.col("offset").between(low, high - 1)).coalesce(1)
            write_topic(part, paths["topic"], fmt="parquet")
            assert run_bronze(spark, paths["topic"], paths["bronze"], paths["state"], topic_fmt="parquet").rows == high - low
    finally:
        spark.conf.unset("spark.sql.streaming.minBatchesToRetain")
    sizes = [r.written for r in progress.batch_records(spark, paths["state"]).collect()]
    assert len(sizes) == 25 and max(sizes) == 2
    assert sorted(r["offset"] for r in read_table(spark, paths["bronze"]).collect()) == list(range(50))
    # 25 batches, of whose log files those up to the last compact one but one are gone.
    for log in ("bronze/_spark_metadata", "state/sources/0"):
        names = {p.name for p in (tmp_path / log).iterdir() if p.name[0] != "."}
        assert {"19.compact", "24"} <= names and not names & {"0", "5", "9.compact"} and len(names) < 17


def test_settings_of_a_drain_end_with_it(spark, sf_dir, tmp_path, monkeypatch):
    keys = (*medallion.CLEANUP_DELAYS, medallion.LOG_MANAGER)
    now = lambda: [spark.conf.get(k, None) for k in keys]
    seen = []
    monkeypatch.setattr(medallion, "drain", lambda query: (seen.append(now()), drain(query)))
    messages = inputs.topic(spark, sf_dir).withColumn("timestamp", F.lit("2024-01-01").cast("timestamp")).drop("event_id")
    write_topic(messages.coalesce(1), str(tmp_path / "topic"), fmt="parquet")
    before = now()
    run = lambda n: run_bronze(spark, str(tmp_path / "topic"), str(tmp_path / n), str(tmp_path / f"{n}-state"), topic_fmt="parquet")
    assert run("a").rows == messages.count()
    assert seen[0][:2] == [medallion.LOG_CLEANUP] * 2 and seen[0][2] in medallion.RENAMING_MANAGERS
    assert before == now() == [None] * 3
    spark.conf.set(keys[0], "5m")
    try:
        run("b")
        assert seen[1] == ["5m", *seen[0][1:]] and now() == ["5m", None, None]
    finally:
        spark.conf.unset(keys[0])
    with pytest.raises(RuntimeError), medallion.brief_logs(spark, str(tmp_path)):
        raise RuntimeError
    assert now() == [None] * 3
    # Logs that don't lie on a local file system are written as before.
    conf = spark._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.logs.link./x", f"file://{tmp_path}")
    try:
        with medallion.brief_logs(spark, str(tmp_path), "viewfs://logs/x"):
            assert now() == [medallion.LOG_CLEANUP] * 2 + [None]
    finally:
        conf.unset("fs.viewfs.mounttable.logs.link./x")


# --- scopes -------------------------------------------------------------------


def test_scopes_of_threads_do_not_mix(spark):
    kept = {}

    def other():
        kept["other"] = stage(spark.range(3), "other")

    with staging(spark):
        stage(spark.range(2), "own")
        thread = threading.Thread(target=other)
        thread.start()
        thread.join()
    assert kept["other"].count() == 3
