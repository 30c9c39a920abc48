"""The interaction topic: reading, decoding, peeking and encoding messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vidpulse.functions import lenient, time_text
from vidpulse.schemas import LOG_COLUMNS, MAX_OFFSETS_PER_TRIGGER, MESSAGE, TOPIC


def read_topic(
    spark: SparkSession,
    topic: str,
    servers: str | None = None,
    *,
    starting: str = "earliest",
    max_offsets: int = MAX_OFFSETS_PER_TRIGGER,
    fmt: str = "kafka",
    max_files: int = 1,
) -> DataFrame:
    """Topic as a stream. With another ``fmt`` it is a folder of files with the
    broker's columns, ``max_files`` per micro-batch."""
    if fmt == "kafka":
        return (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting)
            .option("failOnDataLoss", "false")
            .option("maxOffsetsPerTrigger", max_offsets)
            .load()
        )
    return (
        spark.readStream.format(fmt).schema(TOPIC).option("maxFilesPerTrigger", max_files).load(topic)
    )


def read_topic_batch(
    spark: SparkSession, topic: str, servers: str | None = None, fmt: str = "kafka"
) -> DataFrame:
    """What the topic holds now, from the earliest to the latest offset."""
    if fmt == "kafka":
        return (
            spark.read.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", "earliest")
            .option("endingOffsets", "latest")
            .load()
        )
    return spark.read.format(fmt).schema(TOPIC).load(topic)


def parse_messages(
    messages: DataFrame, schema: StructType = MESSAGE, keep: tuple[str, ...] = ()
) -> DataFrame:
    """JSON payload to columns; a malformed payload gives nulls, a bad field one null."""
    parsed = F.from_json(F.col("value").cast("string"), schema).alias("d")
    return messages.select(*keep, parsed).select(*keep, "d.*")


def to_bronze(messages: DataFrame) -> DataFrame:
    """Payload text, broker columns and the parsed fields."""
    payload = messages.withColumn("raw_data", F.col("value").cast("string"))
    return parse_messages(payload, keep=("raw_data", "partition", "offset", "timestamp"))


def peek_topic(messages: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` messages by partition and offset, decoded."""
    first = messages.select("partition", "offset", "value").orderBy("partition", "offset").limit(n)
    # Through a generator: the planner moves a limit above plain projections, and
    # two of them would turn the top-n into a sort of the whole topic.
    parsed = F.from_json(F.col("value").cast("string"), MESSAGE)
    return first.select("partition", "offset", F.inline(F.array(parsed)))


def to_messages(logs: DataFrame, keep: tuple[str, ...] = (), rejects: Observation | None = None) -> DataFrame:
    """Log rows as (key = video id, value = JSON); a null ratio stays an explicit null.

    Rows without two whole-number ids make no message; ``rejects`` counts them as ``errors``.
    """
    ids = {n: lenient(F.col(n), "bigint") for n in ("user_id", "video_id")}
    bad = ids["user_id"].isNull() | ids["video_id"].isNull()
    if rejects is not None:
        logs = logs.observe(rejects, F.count_if(bad).alias("errors"))
    logs = logs.filter(~bad)
    is_text = dict(logs.dtypes)["event_time"] == "string"
    event_time = F.col("event_time") if is_text else time_text(F.col("event_time"), micros=True)
    fields = {
        "event_time": event_time,
        **ids,
        "watch_time": F.round("watch_time", 3),
        "duration": F.round("duration", 3),
        "watch_ratio": F.round("watch_ratio", 4),
        **{n: F.col(n).cast("int") for n in LOG_COLUMNS[6:]},
    }
    payload = F.to_json(
        F.struct(*(c.alias(n) for n, c in fields.items())), {"ignoreNullFields": "false"}
    )
    return logs.select(
        *keep,
        fields["video_id"].cast("string").cast("binary").alias("key"),
        payload.cast("binary").alias("value"),
    )
