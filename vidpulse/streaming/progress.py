"""What a drained stream did, from the stream itself: rows by micro-batch, kept by batch id.

Rows are counted by ``observe`` while they pass, so neither table is counted before or
after. Each drain leaves one small file of its batches beside the checkpoint; a batch that ran
again counts once, under its id. Batches that were committed without a record (a driver
lost in between, or more batches than Spark keeps progress of) are told by ``missing``.
"""

from __future__ import annotations

import json
import time
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vidpulse.session import hadoop_path

READ, WRITTEN = "rows_read", "rows_written"
#: Micro-batches whose progress Spark keeps for one query.
KEPT_BATCHES = 10_000
RECORD = "batch_id long, read long, written long, seconds double, ended double"


@dataclass(frozen=True)
class BatchRecord:
    """Rows read and written by one micro-batch and the seconds it took."""

    batch_id: int
    read: int
    written: int
    seconds: float
    ended: float

    @property
    def rejected(self) -> int:
        return self.read - self.written

    @property
    def rows_per_second(self) -> float:
        return self.written / self.seconds if self.seconds > 0 else 0.0


def counted(df: DataFrame, name: str) -> DataFrame:
    """``df`` with its rows counted under ``name`` in each micro-batch's progress."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"))


def records_of(query: StreamingQuery) -> list[BatchRecord]:
    """The batches of a query so far; without a count of what was read, that is what was written."""
    found = {}
    for p in query.recentProgress:
        rows = {n: int(r["rows"]) for n, r in (p.observedMetrics or {}).items() if n in (READ, WRITTEN)}
        written = rows.get(WRITTEN, 0)
        seconds = (p.durationMs or {}).get("triggerExecution", 0) / 1000
        if rows:
            found[p.batchId] = BatchRecord(p.batchId, rows.get(READ, written), written, seconds, time.time())
    return [found[k] for k in sorted(found)]


def _folder(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}-progress"


def keep(spark: SparkSession, checkpoint: str, records: list[BatchRecord]) -> None:
    """Write the records of a drain, one JSON line each; a repeated drain replaces its file."""
    if not records:
        return
    fs, path = hadoop_path(spark, f"{_folder(checkpoint)}/from-{records[0].batch_id:012d}.json")
    out = fs.create(path, True)
    try:
        out.write(bytearray("".join(json.dumps(asdict(r)) + "\n" for r in records).encode()))
    finally:
        out.close()


def batch_records(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``batch_id, read, written, rejected, seconds, rows_per_second`` of every recorded batch."""
    fs, path = hadoop_path(spark, _folder(checkpoint))
    if not fs.exists(path):
        return spark.createDataFrame([], RECORD).withColumn("rejected", F.lit(0)).withColumn("rows_per_second", F.lit(0.0))
    last = F.max_by(F.struct("read", "written", "seconds"), "ended").alias("r")
    rows = spark.read.schema(RECORD).json(_folder(checkpoint)).groupBy("batch_id").agg(last).select("batch_id", "r.*")
    speed = F.coalesce(F.try_divide(F.col("written"), F.nullif("seconds", F.lit(0.0))), F.lit(0.0))
    return rows.withColumn("rejected", F.col("read") - F.col("written")).withColumn("rows_per_second", speed)


def missing(spark: SparkSession, checkpoint: str) -> int:
    """Committed batches without a record."""
    fs, path = hadoop_path(spark, f"{checkpoint}/commits")
    if not fs.exists(path):
        return 0
    names = {x.getPath().getName() for x in fs.listStatus(path)}
    committed = {int(n) for n in names if n.isdigit()}
    return len(committed - {r.batch_id for r in batch_records(spark, checkpoint).select("batch_id").collect()})


def totals(spark: SparkSession, checkpoint: str) -> tuple[int, int]:
    """``(read, written)`` of all recorded batches."""
    row = batch_records(spark, checkpoint).agg(F.sum("read"), F.sum("written")).first()
    return row[0] or 0, row[1] or 0
