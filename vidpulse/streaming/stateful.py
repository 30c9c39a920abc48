"""Growth, running statistics, labels and de-duplication that follow a stream."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from vidpulse.operators.cleaning import clamped
from vidpulse.operators.incremental import HotStore
from vidpulse.operators.order import ranked_rows
from vidpulse.operators.replay import ARRIVAL, Served, totals_after, with_running_stats
from vidpulse.schemas import CELL_COLUMNS, FEATURE_COLUMNS, LOG_COLUMNS
from vidpulse.session import hadoop_path, staging
from vidpulse.streaming.features import each_batch

GROWN = (
    "video_id string, window_start timestamp, window_end timestamp, views_count bigint, unique_users bigint,"
    " avg_watch_ratio double, avg_watch_time double, growth_rate double, engagement_count bigint"
)


# --- growth -------------------------------------------------------------------


def stream_growth(cells: DataFrame, forget_after: str | None = None) -> DataFrame:
    """Closed cells, streamed, with growth against the video's last window with views.

    State is one row for each video: its last window and that window's views. A micro-batch
    touches the videos that it holds and no others. With ``forget_after`` (such as
    ``90 days`` behind the watermark) a video without new windows gives up its
    state, and its next window counts as the first one; without it a video is never
    forgotten. A window at or before the video's last one was handled before and is left out.
    """
    expires = None if forget_after is None else int(pd.Timedelta(forget_after).total_seconds() * 1000)

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last, views = state.get if state.exists else (-(2**62), 0)
        rows = pd.concat(list(frames)).sort_values("window_start")
        starts = rows["window_start"].astype("datetime64[us]").astype("int64")
        rows = rows[(starts > last).to_numpy()].copy()
        if len(rows):
            before = rows["views_count"].shift(fill_value=0).astype("float64")
            before.iloc[0] = views
            change = (rows["views_count"] - before) / before.where(before != 0, 1.0)
            rows["growth_rate"] = change.where(before != 0, rows["views_count"].astype("float64"))
            last, views = int(starts.max()), int(rows["views_count"].iloc[-1])
            state.update((last, views))
        if expires is not None:
            state.setTimeoutTimestamp(max(last // 1000 + expires, state.getCurrentWatermarkMs() + 1))
        if len(rows):
            yield rows[FEATURE_COLUMNS]

    if expires is not None:
        cells = cells.withWatermark("window_start", "0 seconds")
    timeout = GroupStateTimeout.NoTimeout if expires is None else GroupStateTimeout.EventTimeTimeout
    grouped = cells.select(*CELL_COLUMNS).groupBy("video_id")
    return grouped.applyInPandasWithState(step, GROWN, "last_start bigint, last_views bigint", "append", timeout)


# --- running statistics -------------------------------------------------------


def _ledger(spark: SparkSession, folder: str, batch_id: int) -> Served:
    """The totals that batch ``batch_id`` left; zeros before the first."""
    path = f"{folder}/batch_id={batch_id}"
    fs, jpath = hadoop_path(spark, path)
    if batch_id < 0 or not fs.exists(jpath):
        if batch_id >= 0:
            raise FileNotFoundError(f"no totals of batch {batch_id} in {folder}")
        return Served()
    return Served(**spark.read.parquet(path).first().asDict())


def running_stats_each_batch(
    served: DataFrame, path: str, checkpoint: str, order: Sequence[str] = ARRIVAL
) -> StreamingQuery:
    """Append each micro-batch of served requests with number and running figures.

    Numbers and sums within the batch come from ranges and two-level prefix sums; what came
    before is one row, left by the batch before in ``path/totals``. Requests and totals lie
    under the batch's id, so a batch that runs again writes the same rows again.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        base = _ledger(spark, f"{path}/totals", batch_id - 1)
        with staging(spark):
            numbered, last = ranked_rows(batch, list(order), "request_id")
            log = with_running_stats(numbered, base, last=last)
            log = log.withColumn("request_id", F.col("request_id") + F.lit(base.requests))
            log.write.mode("overwrite").parquet(f"{path}/requests/batch_id={batch_id}")
            after = totals_after(numbered, base)
        totals = spark.createDataFrame([tuple(after)], "requests long, hits long, latency_ms long")
        totals.coalesce(1).write.mode("overwrite").parquet(f"{path}/totals/batch_id={batch_id}")

    return each_batch(served, handle, checkpoint)


def read_running_stats(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", f"{path}/requests").parquet(f"{path}/requests").drop("batch_id")


# --- labels -------------------------------------------------------------------


def label_each_batch(cells: DataFrame, store: HotStore, checkpoint: str) -> StreamingQuery:
    """Add each micro-batch of closed cells to the store, which reads its tail and not its cells."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        with staging(batch.sparkSession):
            store.add(batch.select(*CELL_COLUMNS), batch_id)

    return each_batch(cells, handle, checkpoint)


# --- cleaning -----------------------------------------------------------------


def stream_clamped(logs: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """The clamp cleaner on a stream, with bounded state.

    Copies agree in the event time, so one that comes no later than ``lateness`` after the
    newest event is told and dropped. State holds the rows of that span. Rows that are
    later still are dropped by the watermark and counted (``late_rows``).
    """
    return clamped(logs, "timestamp").withWatermark("event_time", lateness).dropDuplicatesWithinWatermark(LOG_COLUMNS)


def late_rows(query: StreamingQuery) -> int:
    """Rows that the watermark dropped so far."""
    return sum(_operators(query, "numRowsDroppedByWatermark"))


def state_rows(query: StreamingQuery) -> list[int]:
    """Rows of state after each micro-batch."""
    return _operators(query, "numRowsTotal")


def _operators(query: StreamingQuery, figure: str) -> list[int]:
    get: Callable = lambda op: getattr(op, figure)
    return [sum(get(op) for op in p.stateOperators) for p in query.recentProgress]
