"""The whole batch chain and the command line."""

import datetime
import glob
from pathlib import Path

from vidpulse.__main__ import main
from vidpulse.plans import inputs
from vidpulse.plans.batch import BatchSettings, run_batch
from vidpulse.schemas import FEATURE_COLUMNS, HOT_COLUMNS, PREDICTION_COLUMNS, RECOMMENDATION_COLUMNS
from vidpulse.session import shared_folder, stage, staging
from vidpulse.sources.tables import read_table
from vidpulse.streaming.features import rescore_each_batch


def test_batch_chain(spark, sf_dir, tmp_path):
    logs = inputs.strict_log(spark, sf_dir)
    reports, summary = run_batch(logs, str(tmp_path), BatchSettings(window="1 day"))
    rows = {r["item"]: r["value"] for r in summary.collect()}
    assert rows["sum_views_count"] == logs.count()
    assert rows["feature_rows"] == rows["prediction_rows"] == rows["cache_rows"] == reports["video_features"].rows
    assert rows["hot_label=HOT"] == rows["cache_decision=CACHE"] == reports["all_hot_videos"].rows
    assert reports["top_hot_videos"].rows == min(20, rows["hot_label=HOT"])
    for name, columns in {
        "video_features": FEATURE_COLUMNS,
        "hot_video_predictions": PREDICTION_COLUMNS,
        "top_hot_videos": HOT_COLUMNS,
        "cache_recommendation": RECOMMENDATION_COLUMNS,
        "evaluation_metrics": ["metric", "value", "unit", "description"],
    }.items():
        assert read_table(spark, str(tmp_path / name)).columns == columns
    kpis = {r["metric"]: r["value"] for r in read_table(spark, str(tmp_path / "evaluation_metrics")).collect()}
    assert len(kpis) == 21
    assert kpis["cache_hits"] + kpis["cache_misses"] == kpis["total_requests"] == logs.count()


def test_command_line_from_csv_to_tables(spark, tmp_path, capsys):
    source = tmp_path / "raw.csv"
    lines = ["Item_ID,UserId,time,play_time,duration"]
    lines += [f"{i % 7},{i},2024-01-01 {i % 20:02d}:{i % 60:02d}:00,{i % 40},30" for i in range(300)]
    source.write_text("\n".join([*lines, lines[5], "x,1,junk,1,1"]))
    main(["clean-csv", str(source), str(tmp_path / "silver")])
    assert read_table(spark, str(tmp_path / "silver")).count() == 300
    topic = str(tmp_path / "topic")
    main(["produce", str(tmp_path / "silver"), topic, "--fmt", "parquet", "--limit", "50"])
    assert spark.read.parquet(topic).count() == 50
    main(["batch", str(tmp_path / "silver"), str(tmp_path / "out"), "--threshold", "0.5"])
    assert "hot_label=" in capsys.readouterr().out
    assert read_table(spark, str(tmp_path / "out" / "video_features")).count() > 0


def test_command_line_generates_a_log_with_trends(spark, tmp_path):
    main(["generate", str(tmp_path / "log"), "--rows", "5000"])
    assert read_table(spark, str(tmp_path / "log")).count() > 5000


def test_staged_tables_go_with_their_scope(spark, tmp_path):
    with staging(spark):
        outer = stage(spark.range(5), "outer")
        with staging(spark):
            inner = stage(outer.filter("id > 1"), "inner")
            assert inner.count() == 3
            gone = inner.inputFiles()
        assert outer.count() == 5
        gone += outer.inputFiles()
    assert gone and not [f for f in gone if Path(f.removeprefix("file:")).exists()]


def test_micro_batches_leave_no_staged_table(spark, tmp_path):
    cells = spark.createDataFrame(
        [("v", datetime.datetime(2024, 1, 1), datetime.datetime(2024, 1, 2), 3, 2, 0.5, 4.0, 1)],
        "video_id string, window_start timestamp, window_end timestamp, views_count long, unique_users long,"
        " avg_watch_ratio double, avg_watch_time double, engagement_count long",
    )
    cells.write.parquet(str(tmp_path / "in"))
    folder = shared_folder(spark).removeprefix("file:")
    before = set(glob.glob(f"{folder}/features-*"))
    stream = spark.readStream.schema(cells.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    rescore_each_batch(stream, str(tmp_path / "cells"), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
    assert set(glob.glob(f"{folder}/features-*")) == before
