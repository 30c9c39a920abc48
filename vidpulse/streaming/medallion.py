"""Topic -> bronze -> silver as drain-and-stop streaming queries."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vidpulse.operators.cleaning import clean_logs
from vidpulse.schemas import BRONZE
from vidpulse.session import hadoop_path, stage, staging
from vidpulse.sources.sinks import RunReport
from vidpulse.sources.tables import read_table
from vidpulse.sources.topic import read_topic, to_bronze
from vidpulse.streaming.features import each_batch
from vidpulse.streaming.offsets import OffsetLedger
from vidpulse.streaming.progress import (
    KEPT_BATCHES,
    READ,
    WRITTEN,
    BatchRecord,
    counted,
    keep,
    missing,
    records_of,
    totals,
)

#: How long files of a stream's logs stay that a later file holds again. Spark keeps the last hundred batches in any case.
LOG_CLEANUP = "30s"
CLEANUP_DELAYS = ("spark.sql.streaming.fileSource.log.cleanupDelay", "spark.sql.streaming.fileSink.log.cleanupDelay")
LOG_MANAGER = "spark.sql.streaming.checkpointFileManagerClass"
#: Writes log files by the file system's own rename; where Spark 4.1 has it, and where older versions do.
RENAMING_MANAGERS = (
    "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager",
    "org.apache.spark.sql.execution.streaming.FileSystemBasedCheckpointFileManager",
)


def write_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    mode: str = "append",
    partition_by: str | None = None,
) -> StreamingQuery:
    """Start a query that appends all available input to a table and then stops.

    The checkpoint makes it resumable: a second run adds only what is new.
    """
    writer = (
        df.writeStream.format(fmt)
        .outputMode(mode)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    return (writer.partitionBy(partition_by) if partition_by else writer).start()


def _renaming_manager(spark: SparkSession) -> str | None:
    """The class of ``RENAMING_MANAGERS`` that this Spark has."""
    for name in RENAMING_MANAGERS:
        try:
            spark._jvm.java.lang.Class.forName(name)
            return name
        except Py4JError:
            continue
    return None


@contextmanager
def brief_logs(spark: SparkSession, *paths: str) -> Iterator[None]:
    """For a drain inside: the logs of many small micro-batches, in the folders ``paths``, cost little.

    A micro-batch lists the logs of source and sink three times, and Spark leaves their
    superseded files for ten minutes, so the lists of a long drain grow with its batches;
    here they go after ``LOG_CLEANUP``. Readers of the table that meet a removed file go on
    from the next one, as Spark has it. On local folders log files are renamed by the file
    system itself: Spark's usual way asks for links first, for which Hadoop without its native
    library starts eight processes a file; neither renames more safely there. What the session
    has set stays.
    """
    settings = dict.fromkeys(CLEANUP_DELAYS, LOG_CLEANUP)
    if all(hadoop_path(spark, p)[0].getUri().getScheme() == "file" for p in paths):
        settings[LOG_MANAGER] = _renaming_manager(spark)
    settings = {k: v for k, v in settings.items() if v and spark.conf.get(k, None) is None}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in settings:
            spark.conf.unset(key)


def drain(query: StreamingQuery) -> None:
    """Wait for the query to stop; raise what made it fail."""
    query.awaitTermination()
    failure = query.exception()
    if failure is not None:
        raise failure


def append_available(
    df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", partition_by: str | None = None
) -> RunReport:
    """Append all available input and report the rows this run added, as the stream counted them.

    The records of its batches are kept beside the checkpoint. A count of rows read that
    the caller put into ``df`` goes with them.
    """
    spark = df.sparkSession
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", KEPT_BATCHES)
    began = time.monotonic()
    with brief_logs(spark, path, checkpoint):
        query = write_stream(counted(df, WRITTEN), path, checkpoint, fmt, partition_by=partition_by)
        drain(query)
    records = records_of(query)
    keep(spark, checkpoint, records)
    return RunReport(
        sum(r.written for r in records), time.monotonic() - began, sum(r.rejected for r in records)
    )


def table_rows(spark: SparkSession, path: str, fmt: str = "parquet") -> int:
    """Row count of a table (read from file footers), 0 when it does not exist."""
    try:
        return read_table(spark, path, fmt).count()
    except FileNotFoundError:
        return 0


def read_bronze_stream(
    spark: SparkSession, path: str, fmt: str = "parquet", max_files: int | None = None, rewritten: bool = False
) -> DataFrame:
    """Bronze as a stream; a table that is rewritten does not stop it, but its rewritten rows come again.

    With ``rewritten`` a table of files is read by what lies in its folder and not by the
    log of the stream that filled it, which doesn't name files that others put there. A file
    that is gone when its batch runs is passed over: its rows come with the files that replaced it.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "delta":
        return reader.option("ignoreChanges", "true").load(path)
    reader = reader.schema(BRONZE)
    reader = reader.option("maxFilesPerTrigger", max_files) if max_files else reader
    if rewritten:
        return reader.option("ignoreMissingFiles", "true").load(f"{path}/*.{fmt}")
    return reader.load(path)


def run_bronze(
    spark: SparkSession,
    topic: str,
    path: str,
    checkpoint: str,
    *,
    servers: str | None = None,
    topic_fmt: str = "kafka",
    fmt: str = "parquet",
    **topic_options,
) -> RunReport:
    messages = read_topic(spark, topic, servers, fmt=topic_fmt, **topic_options)
    return append_available(to_bronze(messages), path, checkpoint, fmt)


def run_silver(
    spark: SparkSession,
    bronze: str,
    path: str,
    checkpoint: str,
    *,
    fmt: str = "parquet",
    by_day: bool = False,
    rewritten: bool = False,
    **source_options,
) -> RunReport:
    """Strict cleaning of what is new in bronze. ``rows`` is what silver gained,
    ``errors`` the bronze rows that so far did not pass, over all runs; both come from the
    stream's own counts, and from the tables only where records of batches are missing.
    ``by_day`` partitions the table by ``event_date``, so that later jobs read only the days they need.
    ``rewritten`` is for a bronze whose files others rewrite (merge, sort, delete columns): messages
    are told by their offsets, and silver is a table of micro-batches for ``read_silver``."""
    if rewritten:
        source = read_bronze_stream(spark, bronze, fmt, rewritten=True, **source_options)
        report = silver_each_batch(source, path, checkpoint, by_day)
        read, written = totals(spark, checkpoint)
        return RunReport(report.rows, report.seconds, errors=read - written)
    source = counted(read_bronze_stream(spark, bronze, fmt, **source_options), READ)
    cleaned = clean_logs(source)
    if by_day:
        cleaned = cleaned.withColumn("event_date", F.to_date("event_time"))
    report = append_available(cleaned, path, checkpoint, fmt, "event_date" if by_day else None)
    if missing(spark, checkpoint):
        read, written = table_rows(spark, bronze, fmt), table_rows(spark, path, fmt)
    else:
        read, written = totals(spark, checkpoint)
    return RunReport(report.rows, report.seconds, errors=read - written)


def silver_each_batch(bronze: DataFrame, path: str, checkpoint: str, by_day: bool = False) -> RunReport:
    """Strict cleaning of the messages of bronze that were not cleaned before, by partition and offset.

    Each micro-batch writes its rows under its id, then its offsets beside the checkpoint,
    then its record; one that runs again replaces them. ``read_silver`` reads the table.
    """
    spark = bronze.sparkSession
    ledger = OffsetLedger(spark, f"{checkpoint.rstrip('/')}-offsets")
    done: list[BatchRecord] = []

    def handle(batch: DataFrame, batch_id: int) -> None:
        began = time.monotonic()
        read, written = Observation(), Observation()
        rows = F.count(F.lit(1)).alias("rows")
        with staging(spark):
            # One reading of the files, which may be rewritten at any time, serves rows and offsets.
            batch = stage(batch, "batch")
            fresh = ledger.unread(batch, batch_id)
            cleaned = clean_logs(fresh.observe(read, rows))
            if by_day:
                cleaned = cleaned.withColumn("event_date", F.to_date("event_time"))
            writer = cleaned.observe(written, rows).write.mode("overwrite")
            (writer.partitionBy("event_date") if by_day else writer).parquet(f"{path}/batch_id={batch_id}")
            ledger.add(batch, batch_id)
        figures = [o.get.get("rows", 0) for o in (read, written)]
        done.append(BatchRecord(batch_id, *figures, time.monotonic() - began, time.time()))
        keep(spark, checkpoint, done[-1:])

    began = time.monotonic()
    with brief_logs(spark, checkpoint):
        drain(each_batch(bronze, handle, checkpoint))
    return RunReport(sum(r.written for r in done), time.monotonic() - began, sum(r.rejected for r in done))


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """The rows that ``silver_each_batch`` wrote, without their batch."""
    return read_table(spark, path).drop("batch_id")
