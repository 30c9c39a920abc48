"""Concatenate and cut: documents laid end to end and cut into windows of fixed length.

Pass one encodes every document, writes its ids with its offset within its partition,
and leaves one token total per partition. A prefix sum over these totals turns offsets
into global ones; pass two cuts each document where windows begin. A window that spans
two partitions is made of the last pieces of one and the first of the next, under the
same sequence number, so nothing is dropped or padded at a partition's edge: only the
last sequence of all can be shorter than the window.

Defined results: a null text counts as empty and is packed as its end id alone;
repeated rows are packed each by itself; an empty table gives no pieces.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vidpulse.llm.common import slices, texts_of
from vidpulse.llm.wordbpe import encoder
from vidpulse.session import stage

WINDOW = 4096
END_ID = 2
#: Each task compares one text of this many with the tokenizers library.
CHECK_EVERY = 4096


def encode_rows(docs: DataFrame, path: str, end_id: int, text: str = "text") -> DataFrame:
    """``doc_id, ids, n, part, at``: little-endian 32-bit ids, their number, and where they lie.

    ``at`` counts the ids of the rows before in the same partition ``part``.
    """

    def run(batches):
        own, part, at, seen = encoder(path), TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            for rows in slices(batch, text):
                texts = texts_of(rows, text)
                ids, counts = own.encode(texts)
                if seen // CHECK_EVERY != (seen + len(texts)) // CHECK_EVERY or not seen:
                    own.check(texts[0].as_py(), ids[: counts[0]])
                seen += len(texts)
                ids = np.insert(ids, np.cumsum(counts), end_id).astype("<u4")
                counts = counts + 1
                ends = np.cumsum(counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id"),
                        pa.Array.from_buffers(
                            pa.binary(),
                            len(counts),
                            [
                                None,
                                pa.py_buffer(np.concatenate([[0], ends * 4]).astype(np.int32)),
                                pa.py_buffer(ids),
                            ],
                        ),
                        pa.array(counts),
                        pa.array(np.full(len(counts), part, np.int64)),
                        pa.array(at + ends - counts),
                    ],
                    ["doc_id", "ids", "n", "part", "at"],
                )
                at += int(ends[-1])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text).mapInArrow(run, f"doc_id {kind}, ids binary, n long, part long, at long")


def laid_out(docs: DataFrame, path: str, end_id: int = END_ID, text: str = "text") -> DataFrame:
    """``doc_id, ids, n, first``: encoded documents with their global offset."""
    rows = stage(encode_rows(docs, path, end_id, text), "encoded", compression="zstd")
    totals = rows.groupBy("part").agg(F.sum("n").alias("total"))
    # One row per partition of the input, which bounds the window and the broadcast.
    before = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = totals.select("part", F.coalesce(before, F.lit(0)).alias("base"))
    return rows.join(F.broadcast(bases), "part").select(
        "doc_id", "ids", "n", (F.col("base") + F.col("at")).alias("first")
    )


def pack(docs: DataFrame, path: str, window: int = WINDOW, end_id: int = END_ID, text: str = "text") -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence, and its ids."""
    rows = laid_out(docs, path, end_id, text)
    first, last = F.col("first"), F.col("first") + F.col("n") - 1
    numbers = F.sequence(F.floor(first / window), F.floor(last / window))

    def piece(number):
        start = F.greatest(number * window - first, F.lit(0))
        length = F.least((number + 1) * window - first, F.col("n")) - start
        return F.struct(
            number.alias("sequence_id"),
            start.alias("start"),
            length.alias("length"),
            (first + start - number * window).alias("offset"),
            F.substring(F.col("ids"), (start * 4 + 1).cast("int"), (length * 4).cast("int")).alias("piece_ids"),
        )

    cut = rows.select("doc_id", F.col("n").alias("doc_tokens"), F.explode(F.transform(numbers, piece)).alias("p"))
    return cut.select("doc_id", "doc_tokens", "p.*")


def piece_table(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("piece_ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def sequences(pieces: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """``sequence_id, ids, length``: whole sequences as bytes of 32-bit ids.

    A group holds ``window`` ids at most. The short last sequence is padded to the
    window unless its length is a power of two.
    """
    runs = F.sort_array(F.collect_list(F.struct("offset", "piece_ids")))
    joined = pieces.groupBy("sequence_id").agg(runs.alias("runs"), F.sum("length").alias("length"))
    ids = F.aggregate("runs", F.lit(b""), lambda a, x: F.concat(a, x["piece_ids"]))
    power = F.bit_count(F.col("length")) == 1
    missing = F.when(power, 0).otherwise(window - F.col("length")).cast("int")
    pad = F.unhex(F.repeat(F.lit(pad_id.to_bytes(4, "little").hex()), missing))
    return joined.select("sequence_id", F.concat(ids, pad).alias("ids"), "length")
