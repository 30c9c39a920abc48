"""Rewritten bronze: messages told by partition and offset."""

import json

import pytest
from pyspark.sql import functions as F

from vidpulse.schemas import BRONZE
from vidpulse.session import staging
from vidpulse.streaming.medallion import read_silver, run_silver
from vidpulse.streaming.offsets import BLOCK_OFFSETS, OffsetLedger
from vidpulse.streaming.progress import batch_records
from vidpulse.sources.topic import to_bronze

SCHEMA = "partition int, offset bigint, name string"


def take(ledger, rows, batch_id):
    """What a batch finds unread, as names; its offsets are remembered."""
    batch = ledger.spark.createDataFrame(rows, SCHEMA)
    with staging(ledger.spark):
        found = sorted(r["name"] for r in ledger.unread(batch, batch_id).collect())
        ledger.add(batch, batch_id)
    return found


def test_batches_find_what_no_batch_before_had(spark, tmp_path):
    ledger = OffsetLedger(spark, str(tmp_path / "ledger"))
    edge = BLOCK_OFFSETS
    first = [(0, 0, "a"), (0, 1, "b"), (0, edge, "c"), (0, edge + 1, "d"), (1, 7, "e"), (0, 2**40, "f")]
    assert take(ledger, first, 0) == list("abcdef")
    second = first + [(0, 2, "g"), (1, 1, "h"), (0, edge + 9, "i"), (2, 0, "j"), (0, 2**40 - 1, "k")]
    assert take(ledger, second, 1) == list("ghijk")
    assert take(ledger, second, 1) == list("ghijk")  # the batch again
    assert take(ledger, second, 2) == []
    assert take(ledger, [], 3) == [] and take(ledger, [(5, 5, "z")], 4) == ["z"]


def test_repeats_nulls_and_order(spark, tmp_path):
    ledger = OffsetLedger(spark, str(tmp_path / "ledger"))
    rows = [(0, 5, "a"), (0, 5, "a"), (None, 5, "n"), (None, 5, "n"), (0, None, "m"), (None, None, None)]
    batch = spark.createDataFrame(rows[:5], SCHEMA)
    with staging(spark):
        assert sorted(r["name"] for r in ledger.unread(batch, 0).collect()) == ["a", "m", "n", "n"]
    ledger.add(batch, 0)
    assert take(ledger, [(0, 5, "a"), (None, 5, "n")], 1) == ["n"]
    assert take(ledger, [(None, None, "x"), (0, None, "y")], 2) == ["x", "y"]


def test_every_place_of_a_block(spark, tmp_path):
    ledger = OffsetLedger(spark, str(tmp_path / "ledger"))
    all_rows = spark.range(2 * BLOCK_OFFSETS + 3).select(F.lit(0).alias("partition"), F.col("id").alias("offset"))
    some = all_rows.filter("offset % 3 = 1 or offset % 8 = 0")
    ledger.add(some, 0)
    with staging(spark):
        left = ledger.unread(all_rows, 1)
        assert left.exceptAll(all_rows.exceptAll(some)).isEmpty() and left.count() == all_rows.count() - some.count()


def test_compacted_ledger_says_the_same(spark, tmp_path):
    ledger = OffsetLedger(spark, str(tmp_path / "ledger"))
    for i in range(4):
        take(ledger, [(0, 10 * i + j, "x") for j in range(1, 6)], i)
    ledger.compact(3)
    assert ledger.read(3).count() == 2 and ledger.read(4).count() == 3  # the merged row and each batch's own from 2 on
    rows = [(0, o, str(o)) for o in range(1, 41)]
    assert take(ledger, rows, 4) == sorted(str(o) for o in range(1, 41) if not 1 <= o % 10 <= 5)
    OffsetLedger(spark, str(tmp_path / "none")).compact(9)


@pytest.mark.parametrize("by_day", [False, True])
def test_silver_of_rewritten_bronze(spark, tmp_path, by_day):
    bronze, silver, state = (str(tmp_path / n) for n in ("bronze", "silver", "state"))

    def write(offsets):
        payload = {"event_time": "2024-01-01 00:00:00", "user_id": 1, "watch_time": 1.0, "duration": 2.0,
                   "watch_ratio": None, "is_click": 1, "is_like": 0, "is_share": 0}
        rows = [(b"k", (json.dumps(payload | {"video_id": o}) if o % 5 else "{oops").encode(), o % 2, o) for o in offsets]
        made = spark.createDataFrame(rows, "key binary, value binary, partition int, offset bigint")
        to_bronze(made.withColumn("timestamp", F.current_timestamp())).select(BRONZE.names).coalesce(1).write.mode("append").parquet(bronze)

    def run():
        report = run_silver(spark, bronze, silver, state, rewritten=True, by_day=by_day)
        return report.rows, report.errors

    write(range(20))
    assert run() == (16, 4)
    for file in (tmp_path / "bronze").glob("*.parquet"):
        file.unlink()
    write(range(19, -1, -1))  # all rows again, in another file
    write(range(10, 30))
    assert run() == (8, 6)
    assert run() == (0, 6)
    rows = read_silver(spark, silver)
    assert sorted(int(r["video_id"]) for r in rows.collect()) == [o for o in range(30) if o % 5]
    assert [(r["read"], r["written"]) for r in batch_records(spark, state).orderBy("batch_id").collect()] == [(20, 16), (10, 8)]
