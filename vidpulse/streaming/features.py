"""Windowed features and scoring on a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vidpulse.operators.features import with_growth
from vidpulse.operators.scoring import score_hot
from vidpulse.schemas import FEATURE_COLUMNS, WINDOW
from vidpulse.session import stage, staging
from vidpulse.sources.sinks import publish
from vidpulse.sources.tables import read_table


def stream_cells(logs: DataFrame, window: str = WINDOW, lateness: str = "10 minutes") -> DataFrame:
    """Closed (video, window) cells in append mode, without growth.

    Exact distinct users come from two chained aggregations: per user first, so
    that a popular video's state is spread over its users, then per video. Rows
    later than ``lateness`` are dropped by the watermark and counted by Spark.
    """
    per_user = (
        logs.withWatermark("event_time", lateness)
        .groupBy(F.window("event_time", window), "video_id", "user_id")
        .agg(
            F.count(F.lit(1)).alias("views"),
            F.sum("watch_ratio").alias("ratio_sum"),
            F.count("watch_ratio").alias("ratio_n"),
            F.sum("watch_time").alias("watch_sum"),
            F.count("watch_time").alias("watch_n"),
            F.sum(F.col("is_like") + F.col("is_share")).alias("engaged"),
        )
    )
    return (
        per_user.groupBy("window", "video_id")
        .agg(
            F.sum("views").alias("views_count"),
            F.count("user_id").alias("unique_users"),
            F.try_divide(F.sum("ratio_sum"), F.sum("ratio_n")).alias("avg_watch_ratio"),
            F.try_divide(F.sum("watch_sum"), F.sum("watch_n")).alias("avg_watch_time"),
            F.sum("engaged").alias("engagement_count"),
        )
        .select(
            "video_id",
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "views_count",
            "unique_users",
            "avg_watch_ratio",
            "avg_watch_time",
            "engagement_count",
        )
    )


def grown_cells(cells: DataFrame) -> DataFrame:
    """The written cells with growth: the batch feature table."""
    return with_growth(cells).select(*FEATURE_COLUMNS)


def rescore_each_batch(
    cells: DataFrame, cells_path: str, predictions_path: str, checkpoint: str, **score_options
) -> StreamingQuery:
    """Append each micro-batch of closed cells and rescore the whole cell table.

    Maxima and the quantile are table-wide, so new cells can change old labels;
    readers see the old predictions until the new ones are written whole. A
    micro-batch writes to its own ``batch_id`` partition, so repeating it after a
    failure replaces its cells instead of adding them twice.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        numbered = batch.withColumn("batch_id", F.lit(batch_id))
        (
            numbered.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(cells_path)
        )
        written = read_table(spark, cells_path, schema=numbered.schema).drop("batch_id")
        with staging(spark):
            features = stage(grown_cells(written), "features")
            publish(score_hot(features, **score_options), predictions_path, allow_empty=True)

    return each_batch(cells, handle, checkpoint)


def each_batch(
    df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    return (
        df.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
