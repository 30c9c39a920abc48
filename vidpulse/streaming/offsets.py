"""Which messages a stream has handled, by partition and offset: rewritten files add nothing.

Offsets are kept as bitmaps of ``BLOCK_OFFSETS`` bits, one for each block of a partition
that a micro-batch touched, in a folder under the batch's id. A batch is compared with the
blocks that it touches itself, so a batch behind all offsets so far reads at most the last
block of each partition, and only rows of blocks met before are joined with bits. Batches
from the one in hand on are not looked at, so a batch that runs again finds the same rows.

Defined results: rows without partition or offset can't be told apart and count as new; of
rows with one offset in one batch, one stays; an empty batch has no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vidpulse.session import hadoop_path, stage

#: Offsets of one bitmap, as the bitmap functions have it.
BLOCK_OFFSETS = 32_768
BLOCKS = "batch_id long, partition int, block long, bits binary"


def block_of(offset: str = "offset") -> Column:
    return F.bitmap_bucket_number(offset)


def is_set(bits: str, offset: str = "offset") -> Column:
    """Whether the bitmap holds the offset; false where there is no bitmap."""
    at = F.bitmap_bit_position(offset)
    byte = F.conv(F.hex(F.substring(bits, (at / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, F.pmod(at, F.lit(8)).cast("int")) == 1, F.lit(False))


@dataclass(frozen=True)
class OffsetLedger:
    """Offsets handled so far, in the folder ``path``."""

    spark: SparkSession
    path: str

    def read(self, before: int) -> DataFrame:
        """``partition, block, bits`` of the batches before ``before``, one row a block and batch."""
        fs, jpath = hadoop_path(self.spark, self.path)
        if not fs.exists(jpath):
            return self.spark.createDataFrame([], BLOCKS).drop("batch_id")
        return self.spark.read.schema(BLOCKS).parquet(self.path).filter(F.col("batch_id") < before).drop("batch_id")

    def unread(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """The rows of a batch that no batch before has handled. Needs a ``staging`` scope or leaves tables."""
        known = F.col("partition").isNotNull() & F.col("offset").isNotNull()
        blocks = stage(
            batch.filter(known)
            .groupBy("partition", block_of().alias("block"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("offset")).alias("bits"), F.count(F.lit(1)).alias("rows")),
            "blocks",
        )
        low, high, repeated = blocks.agg(
            F.min("block"), F.max("block"), F.sum(F.col("rows") - F.bitmap_count("bits"))
        ).first()
        if low is None:
            return batch
        touched = self.read(batch_id).filter(F.col("block").between(low, high))
        touched = touched.join(blocks.select("partition", "block"), ["partition", "block"], "left_semi")
        seen = stage(touched.groupBy("partition", "block").agg(F.bitmap_or_agg("bits").alias("bits")), "seen")
        if not seen.isEmpty():
            batch = (
                batch.withColumn("_block", block_of())
                .join(seen.select("partition", F.col("block").alias("_block"), F.col("bits").alias("_bits")), ["partition", "_block"], "left")
                .filter(~is_set("_bits"))
                .select(*batch.columns)
            )
        if repeated:
            batch = batch.filter(known).dropDuplicates(["partition", "offset"]).unionByName(batch.filter(~known))
        return batch

    def add(self, batch: DataFrame, batch_id: int) -> None:
        """Remember the offsets of a batch; once more replaces them."""
        blocks = batch.filter(F.col("partition").isNotNull() & F.col("offset").isNotNull())
        blocks = blocks.groupBy("partition", block_of().alias("block")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("offset")).alias("bits")
        )
        blocks.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")

    def compact(self, before: int) -> None:
        """One row a block for all batches before ``before``, for which no batch may run again.

        They go under the last of these batches. Bits of a batch may be there twice if
        this stops halfway, which changes nothing.
        """
        fs, root = hadoop_path(self.spark, self.path)
        if not fs.exists(root):
            return
        ids = sorted(int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(root) if s.isDirectory() and "=" in s.getPath().getName())
        old = [i for i in ids if i < before]
        if len(old) < 2:
            return
        whole = self.read(before).groupBy("partition", "block").agg(F.bitmap_or_agg("bits").alias("bits"))
        stage(whole, "blocks").write.mode("append").parquet(f"{self.path}/batch_id={old[-1]}")
        for i in old[:-1]:
            fs.delete(hadoop_path(self.spark, f"{self.path}/batch_id={i}")[1], True)
