"""Reading tables and CSV files, and the checks made before a job starts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from vidpulse.session import hadoop_path
from vidpulse.sources.versions import resolve


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Raises with the list of missing columns; runs no job."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df


def require_path(spark: SparkSession, path: str) -> str:
    fs, jpath = hadoop_path(spark, path)
    if not fs.globStatus(jpath):  # null or empty
        raise FileNotFoundError(f"Input not found: {path}")
    return path


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None
) -> DataFrame:
    """The table at ``path``; of a published one the version that is current now."""
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema is not None else reader).load(resolve(spark, require_path(spark, path)))


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str, header: bool = True
) -> DataFrame:
    """CSV with a given schema, which saves the inference pass. The header line has
    to agree with the names of ``schema``; unreadable fields are null."""
    return (
        spark.read.schema(schema)
        .option("header", header)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .csv(require_path(spark, path))
    )


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """CSV of unknown layout: names from the header line, every field as text."""
    return spark.read.option("header", True).csv(require_path(spark, path))


def scan(
    df: DataFrame, columns: Sequence[str], limit: int | None = None, order: Sequence[str] = ()
) -> DataFrame:
    """Pruned scan; with a limit, the first rows by ``order``."""
    from vidpulse.operators.order import take_smallest

    if limit is None:
        return df.select(*columns)
    if not order:
        return df.select(*columns).limit(limit)
    needed = list(dict.fromkeys([*columns, *order]))
    return take_smallest(df.select(*needed), limit, list(order)).select(*columns)


def replay(df: DataFrame, limit: int | None = None, order: Sequence[str] = ("event_time", "event_id")) -> DataFrame:
    """The log in sending order, or its first ``limit`` rows."""
    if limit is None:
        return df.orderBy(*order)
    return scan(df, df.columns, limit, order)
