"""Batch sinks: table writes, the guarded publish and the topic writer."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from vidpulse.schemas import MAX_OFFSETS_PER_TRIGGER
from vidpulse.session import hadoop_path


@dataclass(frozen=True)
class RunReport:
    """Rows written (and rejected, where a job counts them) and the seconds taken."""

    rows: int
    seconds: float
    errors: int = 0

    @property
    def rows_per_second(self) -> float:
        return self.rows / self.seconds if self.seconds > 0 else 0.0


#: Microseconds are kept; Spark's own formats end at milliseconds.
CSV_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


class EmptyResult(RuntimeError):
    """A publish was refused because the result has no rows."""


def write_table(
    df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet", partition_by: str | None = None
) -> RunReport:
    rows = Observation()
    began = time.monotonic()
    writer = df.observe(rows, F.count(F.lit(1)).alias("rows")).write.format(fmt).mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True).options(**CSV_TIMES)
    (writer.partitionBy(partition_by) if partition_by else writer).save(path)
    return RunReport(rows.get.get("rows", 0), time.monotonic() - began)


def publish(
    df: DataFrame, path: str, *, allow_empty: bool = False, fmt: str = "parquet", partition_by: str | None = None
) -> RunReport:
    """Replace the table at ``path`` only when a new one was written whole.

    All tasks write to a sibling folder; the row count is observed during that
    write. A failure or an empty result leaves the old table in place.
    """
    spark = df.sparkSession
    tag = uuid.uuid4().hex
    fresh, previous = f"{path}.new-{tag}", f"{path}.old-{tag}"
    fs, target = hadoop_path(spark, path)
    fresh_path, previous_path = hadoop_path(spark, fresh)[1], hadoop_path(spark, previous)[1]
    try:
        report = write_table(df, fresh, "errorifexists", fmt, partition_by)
        if report.rows == 0 and not allow_empty:
            raise EmptyResult(f"no rows; {path} was not replaced")
        had_table = fs.exists(target)
        if had_table and not fs.rename(target, previous_path):
            raise OSError(f"cannot set {path} aside")
        if not fs.rename(fresh_path, target):
            if had_table:
                fs.rename(previous_path, target)
            raise OSError(f"cannot move the new table to {path}")
        if had_table:
            fs.delete(previous_path, True)
        return report
    finally:
        if fs.exists(fresh_path):
            fs.delete(fresh_path, True)


def write_topic(
    messages: DataFrame,
    topic: str,
    servers: str | None = None,
    fmt: str = "kafka",
    rejects: Observation | None = None,
    **options: str,
) -> RunReport:
    """Append keyed messages to a topic, or to a file-backed topic at path ``topic``.

    ``rejects`` is the observation given to ``to_messages``, whose count goes into the report.
    """
    rows = Observation()
    began = time.monotonic()
    writer = messages.observe(rows, F.count(F.lit(1)).alias("rows")).write.format(fmt)
    if fmt == "kafka":
        writer = (
            writer.option("kafka.bootstrap.servers", servers)
            .option("topic", topic)
            .option("kafka.acks", "all")
            .option("kafka.retries", "3")
        )
        writer.options(**options).save()
    else:
        # A micro-batch reads whole files, so a file holds no more than a batch may take.
        writer.option("maxRecordsPerFile", MAX_OFFSETS_PER_TRIGGER).options(**options).mode("append").save(topic)
    errors = rejects.get.get("errors", 0) if rejects is not None else 0
    return RunReport(rows.get.get("rows", 0), time.monotonic() - began, errors)
