"""Offset ranges of the files of a file-backed topic, so that readers open only what they need.

The manifest lies in the topic's folder under a name that readers of the topic skip. A row
says that a file holds offsets ``first`` to ``last`` of a partition, in ``rows`` messages. New files
are added by one narrow scan of the two columns; files that are known are not opened again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vidpulse.schemas import TOPIC
from vidpulse.session import hadoop_path
from vidpulse.sources.topic import peek_topic

FOLDER = "_offsets"
ROWS = "file string, partition int, first bigint, last bigint, rows bigint"


def manifest(spark: SparkSession, topic: str) -> DataFrame:
    """``file, partition, first, last, rows`` as far as recorded."""
    fs, path = hadoop_path(spark, f"{topic}/{FOLDER}")
    if not fs.exists(path):
        return spark.createDataFrame([], ROWS)
    return spark.read.schema(ROWS).parquet(f"{topic}/{FOLDER}").dropDuplicates(["file", "partition"])


def refresh_manifest(spark: SparkSession, topic: str, fmt: str = "parquet") -> DataFrame:
    """Record the files that are not in the manifest yet, and return it.

    A file is written once and never changed, so two writers can at worst record one twice.
    """
    files = spark.read.format(fmt).schema(TOPIC).load(topic).inputFiles()
    known = {r.file for r in manifest(spark, topic).select("file").distinct().collect()}
    new = sorted(set(files) - known)
    if new:
        ranges = (
            spark.read.format(fmt).schema(TOPIC).load(new)
            .groupBy(F.input_file_name().alias("file"), "partition")
            .agg(F.min("offset").alias("first"), F.max("offset").alias("last"), F.count(F.lit(1)).alias("rows"))
        )
        ranges.coalesce(1).write.mode("append").parquet(f"{topic}/{FOLDER}")
    return manifest(spark, topic)


def first_files(ranges: DataFrame, n: int) -> list[str]:
    """The files that can hold one of the first ``n`` messages by partition and offset.

    Files in the order of their last offsets hold ``n`` messages up to some offset; files that
    begin behind it are not needed. The rows before that point are few: a partition's
    totals are compared first, then the files of the partition in which the n-th message lies.
    """
    if n <= 0:
        return []
    sizes = sorted((r.partition, r.rows) for r in ranges.groupBy("partition").agg(F.sum("rows").alias("rows")).collect())
    before = 0
    for partition, rows in sizes:
        if before + rows >= n:
            break
        before += rows
    else:
        return [r.file for r in ranges.select("file").distinct().collect()]
    own = ranges.filter(F.col("partition") == partition)
    upto = F.sum("rows").over(Window.orderBy("last", "file").rowsBetween(Window.unboundedPreceding, 0))
    end = own.withColumn("upto", upto).filter(F.col("upto") >= n - before).agg(F.min("last")).first()[0]
    needed = ranges.filter((F.col("partition") < partition) | ((F.col("partition") == partition) & (F.col("first") <= end)))
    return sorted(r.file for r in needed.select("file").distinct().collect())


def peek_files(spark: SparkSession, topic: str, n: int = 10, fmt: str = "parquet") -> DataFrame:
    """The first ``n`` messages, decoded, from the files that hold them."""
    files = first_files(refresh_manifest(spark, topic, fmt), n)
    reader = spark.read.format(fmt).schema(TOPIC)
    found = reader.load(files) if files else spark.createDataFrame([], TOPIC)
    return peek_topic(found, n)
