"""Helpers shared by the operators: tables, Arrow slices, files in the shared folder."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from vidpulse.session import hadoop_path, shared_folder

SLICE_BYTES = 2 << 20


def ship(spark: SparkSession) -> None:
    """Have Spark send this package to the executors, once for each context."""
    import vidpulse

    context = spark.sparkContext
    if getattr(context, "_vidpulse_shipped", False):
        return
    root, packed = Path(vidpulse.__file__).parent, io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    uri = f"{new_folder(spark, 'code')}/vidpulse-{uuid.uuid4().hex}.zip"
    fs, path = file_system(uri)
    with fs.open_output_stream(path) as stream:
        stream.write(packed.getvalue())
    context.addPyFile(uri)
    context._vidpulse_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows with about ``size`` bytes in ``column`` (one row at least)."""
    if not batch.num_rows:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    block = (np.cumsum(lengths.astype(np.int64)) - 1).clip(0) // size
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    """The column's values, null as the empty text."""
    return pc.fill_null(batch.column(column), "")


#: ASCII white space, the only characters that part words here: space and 0x09 to 0x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def string_array(lengths: np.ndarray, data: np.ndarray) -> pa.Array:
    """Strings of the given byte lengths that lie one after the other in ``data``."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(lengths), pa.py_buffer(offsets), pa.py_buffer(data))


def raw_bytes(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(offsets, bytes)`` of a string array without nulls."""
    if not len(strings):
        return np.zeros(1, np.int64), np.empty(0, np.uint8)
    if pa.types.is_large_string(strings.type):
        kind = np.int64
    else:
        strings, kind = strings.cast(pa.string()), np.int32
    _, offsets, data = strings.buffers()
    offsets = np.frombuffer(offsets, kind)[strings.offset : strings.offset + len(strings) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.empty(0, np.uint8)
    return offsets - offsets[0], data


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Words between ASCII white space: ``(offsets, words)``; text ``i`` has ``words[offsets[i]:offsets[i + 1]]``.

    ``texts`` holds no nulls. Works on UTF-8 bytes, of which white space never is a part.
    """
    bounds, data = raw_bytes(texts)
    solid = ~SPACE[data]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    first[inner] = solid[inner]
    last[inner - 1] = solid[inner - 1]
    starts = np.flatnonzero(first)
    lengths = np.flatnonzero(last) - starts + 1
    return np.searchsorted(starts, bounds), string_array(lengths, data[solid])


def coded(strings: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """``(codes, distinct strings)``."""
    found = strings.dictionary_encode()
    return found.indices.to_numpy().astype(np.int64), found.dictionary


def ragged_take(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions ``start, start + 1, ...`` of each run, one run after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - ends + lengths, lengths)


def new_folder(spark: SparkSession, label: str) -> str:
    """A new folder below the shared one, removed when the session's JVM ends."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    fs, jpath = hadoop_path(spark, path)
    fs.mkdirs(jpath)
    fs.deleteOnExit(jpath)
    return str(fs.makeQualified(jpath))


def file_system(uri: str):
    """``(pyarrow file system, path)`` of a URI, on an executor or the driver."""
    from pyarrow import fs

    if urlparse(uri).scheme in ("", "file"):
        return fs.LocalFileSystem(), urlparse(uri).path
    return fs.FileSystem.from_uri(uri)


def put_file(spark: SparkSession, data: bytes, label: str) -> str:
    """Write bounded ``data`` to the shared folder and have Spark copy it to every executor.

    Returns the name to pass to ``SparkFiles.get`` inside a task.
    """
    name = f"{label}-{uuid.uuid4().hex}"
    uri = f"{new_folder(spark, label)}/{name}"
    fs, path = file_system(uri)
    with fs.open_output_stream(path) as out:
        out.write(data)
    spark.sparkContext.addFile(uri)
    return name
