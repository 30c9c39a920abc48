"""Panes, versioned tables and labels that follow new cells, against the batch results."""

import os

import pytest
from pyspark.sql import functions as F

from vidpulse.operators import incremental, panes
from vidpulse.operators.features import video_features
from vidpulse.operators.incremental import HotStore
from vidpulse.operators.scoring import score_hot
from vidpulse.plans import inputs
from vidpulse.schemas import CELL_COLUMNS, FEATURE_COLUMNS, PREDICTION_COLUMNS
from vidpulse.session import stage
from vidpulse.sources import versions
from vidpulse.sources.sinks import EmptyResult
from vidpulse.sources.tables import read_table

DAY = "1 day"


@pytest.fixture(scope="module")
def logs(spark, sf_dir):
    return stage(inputs.strict_log(spark, sf_dir), "strict")


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def rounded(df):
    doubles = [n for n, t in df.dtypes if t == "double"]
    return df.withColumns({n: F.round(n, 11) for n in doubles})


# --- panes ---


def test_panes_compose_to_any_longer_window(spark, logs):
    half_hours = stage(panes.make_panes(logs), "panes")
    for window in ("1 hour", DAY, "30 days"):
        assert same(rounded(panes.compose_features(half_hours, window)), rounded(video_features(logs, window)))
    plan = panes.compose_features(half_hours, DAY)._jdf.queryExecution().executedPlan().toString()
    assert "strict-" not in plan and "panes-" in plan


def test_late_rows_add_panes(spark, logs):
    parts = [panes.make_panes(logs.filter(F.pmod(F.hash("user_id", "event_time"), F.lit(3)) == k)) for k in range(3)]
    both = parts[0].unionByName(parts[1]).unionByName(parts[2])
    assert same(rounded(panes.compose_features(both, DAY)), rounded(video_features(logs, DAY)))
    merged = panes.merge_panes(both)
    assert merged.count() == panes.make_panes(logs).count()
    assert same(rounded(panes.compose_features(merged, DAY)), rounded(video_features(logs, DAY)))


def test_users_beyond_the_sketch_are_estimated(spark):
    n = 20_000
    rows = spark.range(n).select(
        F.lit("v").alias("video_id"), F.col("id").cast("string").alias("user_id"), F.lit(0.5).alias("watch_ratio"),
        F.lit(1.0).alias("watch_time"), F.lit(0).alias("is_like"), F.lit(0).alias("is_share"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("event_time"),
    )
    users = panes.compose_cells(panes.make_panes(rows), DAY).first()["unique_users"]
    assert users != n and abs(users - n) < 0.06 * n
    exact = panes.compose_cells(panes.make_panes(rows, lg_users=16), DAY, lg_users=16).first()["unique_users"]
    assert exact == n


# --- versions ---


def test_a_crash_at_any_step_leaves_a_whole_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    versions.publish_version(spark.range(5), path)
    with pytest.raises(EmptyResult):
        versions.publish_version(spark.range(0), path)
    broken = spark.range(3).select(F.raise_error(F.lit("boom")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="boom"):
        versions.publish_version(broken, path)
    assert read_table(spark, path).count() == 5
    with monkeypatch.context() as m:  # the pointer's new file is there, the replacement is not
        m.setattr(os, "replace", lambda *a: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError):
            versions.publish_version(spark.range(7), path)
    assert read_table(spark, path).count() == 5
    with monkeypatch.context() as m:  # the folder is whole, the pointer was not touched
        m.setattr(versions, "_point_to", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            versions.publish_version(spark.range(8), path)
    assert read_table(spark, path).count() == 5
    assert versions.publish_version(spark.range(9), path).rows == 9
    assert read_table(spark, path).count() == 9


def test_a_reader_keeps_its_version_and_old_ones_are_swept(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(2).write.parquet(path)
    assert read_table(spark, path).count() == 2  # a plain table as before
    versions.publish_version(spark.range(3), path)
    reader = read_table(spark, path)
    versions.publish_version(spark.range(4), path)
    versions.publish_version(spark.range(5), path)
    assert (reader.count(), read_table(spark, path).count()) == (3, 5)
    assert versions.sweep(spark, path) == []  # too young
    assert len(versions.sweep(spark, path, keep=1, min_age_seconds=0)) == 2
    assert read_table(spark, path).count() == 5


# --- labels ---


def cells_of(logs, condition):
    return video_features(logs.filter(condition), DAY).select(*CELL_COLUMNS)


def expected(logs, **options):
    features = stage(video_features(logs, DAY), "features")
    return rounded(score_hot(features, **options))


@pytest.mark.parametrize("share", [1, 60])
def test_labels_follow_batches(spark, logs, tmp_path, share):
    store = HotStore(spark, str(tmp_path / "store"), tail_share=share)
    for k, (low, high) in enumerate((("2024-01-01", "2024-01-08"), ("2024-01-08", "2024-01-20"), ("2024-01-20", "2030-01-01"))):
        store.add(cells_of(logs, (F.col("event_time") >= low) & (F.col("event_time") < high)), k)
        want = expected(logs.filter(F.col("event_time") < high))
        assert same(rounded(store.predictions()), want)
        assert same(rounded(store.hot()), want.filter("predicted_hot = 1"))
    assert store.model().rows == store.cells().count()


def test_old_cells_are_not_read(spark, logs, tmp_path):
    """The second batch is added although the first one's cells are gone."""
    store = HotStore(spark, str(tmp_path / "store"))
    early = F.col("event_time") < "2024-01-20"
    first = store.add(cells_of(logs, early), 0)
    for path in (tmp_path / "store" / "cells").rglob("*.parquet"):
        path.unlink()
    quiet = cells_of(logs, ~early).withColumns({"views_count": F.lit(1).cast("bigint"), "engagement_count": F.lit(0).cast("bigint")})
    quiet = quiet.join(spark.read.parquet(str(tmp_path / "store" / "latest")).select("video_id").distinct(), "video_id", "left_semi")
    second = store.add(quiet.select(*CELL_COLUMNS), 1)
    assert not second.rebuilt and second.rows > first.rows and second.floor >= first.floor
    assert store.hot().count() > 0


def test_repeated_and_unfinished_batches(spark, logs, tmp_path, monkeypatch):
    store = HotStore(spark, str(tmp_path / "store"))
    early = F.col("event_time") < "2024-01-15"
    first = store.add(cells_of(logs, early), 0)
    assert store.add(cells_of(logs, ~early), 0) == first
    with monkeypatch.context() as m:
        m.setattr(versions, "_point_to", lambda *a: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError):
            store.add(cells_of(logs, ~early), 1)
    assert store.model() == first and store.cells().count() == first.rows
    store.add(cells_of(logs, ~early), 1)
    assert same(rounded(store.predictions()), expected(logs))
    with pytest.raises(Exception, match="not after"):
        store.add(cells_of(logs, early), 2)
    incremental.remove_unfinished(store)
    assert sorted(p.name for p in (tmp_path / "store" / "cells").iterdir() if p.is_dir()) == ["batch_id=0", "batch_id=1"]


def test_smaller_maxima_scale_and_empty_batches(spark, logs, tmp_path, monkeypatch):
    monkeypatch.setattr(incremental, "COMPACT", 2)
    store = HotStore(spark, str(tmp_path / "store"), quantile=0.9)
    none = cells_of(logs, F.lit(False))
    store.add(none, 0)
    assert store.model().cut is None and store.predictions().isEmpty()
    halves = (F.col("event_time") < "2024-01-10", F.col("event_time") >= "2024-01-10")
    store.add(cells_of(logs, halves[0]), 1)
    store.add(none, 2)
    store.add(cells_of(logs, halves[1]), 3)
    assert store.model().latest_from > 0
    assert same(rounded(store.predictions()), expected(logs, quantile=0.9))


def test_cells_of_a_store_have_the_batch_features(spark, logs, tmp_path):
    store = HotStore(spark, str(tmp_path / "store"))
    early = F.col("event_time") < "2024-01-15"
    store.add(cells_of(logs, early), 0)
    store.add(cells_of(logs, ~early), 1)
    assert store.cells().columns == FEATURE_COLUMNS and store.predictions().columns == PREDICTION_COLUMNS
    assert same(rounded(store.cells()), rounded(video_features(logs, DAY)))
