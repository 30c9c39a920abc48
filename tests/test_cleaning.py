import datetime

import pytest
from pyspark.sql import functions as F

from vidpulse.operators import cleaning
from vidpulse.schemas import BRONZE, LOG_COLUMNS, MESSAGE, SILVER
from vidpulse.sources.tables import read_csv, read_csv_text, require_columns, require_path, scan

GOOD = ("2024-01-01 10:00:00", 1, 2, 5.0, 10.0, 0.5, 1, 0, 0)


def logs(spark, *changes):
    rows = []
    for change in changes:
        row = dict(zip(LOG_COLUMNS, GOOD), **change)
        rows.append(tuple(row[c] for c in LOG_COLUMNS))
    return spark.createDataFrame(rows, MESSAGE)


def test_strict_mode(spark):
    df = logs(
        spark,
        {},
        {"event_time": "junk"},
        {"user_id": None},
        {"video_id": None},
        {"duration": 0.0},
        {"watch_time": None},
        {"watch_time": -1.0},
        {"watch_time": 11.0},
        {"watch_time": 10.0, "watch_ratio": None},
    )
    rows = cleaning.clean_logs(df, "strict").orderBy("watch_time").collect()
    assert [r["watch_ratio"] for r in rows] == [0.5, 0.5, 1.0]
    assert sorted(r["event_time"] is None for r in rows) == [False, False, True]
    assert rows[0]["user_id"] == "1"


def test_strict_output_has_the_silver_schema(spark):
    cleaned = cleaning.clean_logs(logs(spark, {}), "strict")
    assert [(f.name, f.dataType) for f in cleaned.schema] == [(f.name, f.dataType) for f in SILVER]


def test_clamp_mode(spark):
    df = logs(
        spark,
        {},
        {},
        {"watch_time": 25.0, "is_click": None},
        {"event_time": "junk"},
        {"user_id": None},
        {"duration": -3.0},
        {"watch_time": -1.0},
    )
    rows = cleaning.clean_logs(df, "clamp").orderBy("watch_time").collect()
    assert [(r["watch_time"], r["watch_ratio"], r["is_click"]) for r in rows] == [(5.0, 0.5, 1), (10.0, 1.0, 1)]


def test_feature_mode_limits_the_supplied_ratio(spark):
    df = logs(
        spark,
        {"watch_ratio": 1.7},
        {"watch_ratio": -0.2},
        {"watch_ratio": None, "watch_time": 20.0},
        {"event_time": None},
        {"watch_time": None},
    )
    rows = cleaning.clean_logs(df, "feature").collect()
    assert sorted((r["watch_ratio"] for r in rows), key=str) == [0.0, 1.0, None]


def test_unknown_mode_and_missing_columns(spark):
    with pytest.raises(ValueError, match="unknown cleaning mode"):
        cleaning.clean_logs(logs(spark, {}), "loud")
    with pytest.raises(ValueError, match=r"\['duration'\]"):
        cleaning.clean_logs(logs(spark, {}).drop("duration"), "strict")
    with pytest.raises(ValueError, match="a.*c"):
        require_columns(spark.range(1).toDF("b"), ["a", "b", "c"])


def test_first_alias_present_wins(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], [" Item_ID", "videoid", "PLAY_TIME", "view_time"])
    assert cleaning.normalize_columns(df).columns == ["video_id", "videoid", "watch_time", "view_time"]
    kept = spark.createDataFrame([(1, 2)], ["item_id", "video_id"])
    assert cleaning.normalize_columns(kept).columns == ["item_id", "video_id"]


def test_defaults_only_fill_absent_columns(spark):
    df = cleaning.with_defaults(spark.createDataFrame([(1, None)], "a int, is_like int"))
    assert df.first().asDict() == {"a": 1, "is_like": None, "is_click": 1, "is_share": 0}


def test_coercion_never_raises(spark):
    df = spark.createDataFrame(
        [("2024-13-01", "7", "x", "abc", "1e1", "maybe", "1.0", None)],
        "event_time string, user_id string, video_id string, watch_time string, duration string,"
        " is_click string, is_like string, is_share string",
    )
    row = cleaning.coerce_types(df).first()
    assert (row["event_time"], row["watch_time"], row["duration"]) == (None, None, 10.0)
    assert (row["is_click"], row["is_like"], row["is_share"]) == (1, 1, 0)


def test_standardize(spark):
    df = spark.createDataFrame(
        [(1650636915200, 3925, 7833, 0), (0, 5, 0, 1)],
        "time_ms bigint, play_time_ms bigint, duration_ms bigint, is_forward int",
    )
    for kind in ("timestamp", "timestamp_ntz"):
        rows = cleaning.standardize(df, kind).collect()
        assert rows[0]["event_time"] == datetime.datetime(2022, 4, 22, 14, 15, 15, 200000)
        assert rows[0]["watch_time"] == 3.925 and rows[0]["duration"] == 7.833
        assert rows[0]["watch_ratio"] == pytest.approx(3925 / 7833)
        assert rows[1]["watch_ratio"] is None and rows[1]["is_share"] == 1


def test_strict_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "bronze")
    bronze = logs(spark, {}).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in BRONZE.fields[:4]), "*")
    bronze.write.parquet(path)
    plan = cleaning.clean_logs(spark.read.parquet(path), "strict").select("video_id", "watch_time")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(duration,0.0)" in text and "GreaterThanOrEqual(watch_time,0.0)" in text
    assert "raw_data" not in text


def test_csv_sources(spark, tmp_path):
    path = tmp_path / "log.csv"
    path.write_text("video_id,watch_time\n7,1.5\n8,junk\n")
    typed = read_csv(spark, str(path), "video_id bigint, watch_time double").orderBy("video_id").collect()
    assert [tuple(r) for r in typed] == [(7, 1.5), (8, None)]
    assert read_csv_text(spark, str(path)).dtypes == [("video_id", "string"), ("watch_time", "string")]
    with pytest.raises(FileNotFoundError):
        read_csv(spark, str(tmp_path / "absent.csv"), "a int")
    with pytest.raises(FileNotFoundError):
        require_path(spark, str(tmp_path / "absent"))


def test_scan_limit(spark):
    df = spark.range(50).withColumn("x", -F.col("id"))
    assert [r["id"] for r in scan(df, ["id"], 3, ["x"]).collect()] == [49, 48, 47]
    assert scan(df, ["id"]).columns == ["id"]
