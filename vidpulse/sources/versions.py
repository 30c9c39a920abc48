"""Tables in numbered folders and one small pointer file that names the current one.

A writer fills a new version folder and then replaces the pointer whole; readers resolve
the pointer once and read that folder to the end. At every moment one whole version can be
read, nothing large is renamed or copied, and a crash leaves at most a folder that no pointer
names. ``sweep`` removes such folders and old versions later.
"""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from vidpulse.session import hadoop_path

POINTER = "_current"
PREFIX = "version-"
#: File systems on which a rename of one file replaces the target at once.
RENAMING = ("hdfs", "viewfs", "abfs", "abfss")


def current_version(spark: SparkSession, root: str) -> str | None:
    """The folder of the version that the pointer names, None without a pointer."""
    fs, pointer = hadoop_path(spark, f"{root}/{POINTER}")
    if not fs.exists(pointer):
        return None
    stream = fs.open(pointer)
    try:
        name = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()
    return f"{root}/{name}"


def resolve(spark: SparkSession, path: str) -> str:
    """Where the table at ``path`` lies: in its current version, or in ``path`` itself."""
    return current_version(spark, path) or path


def _point_to(spark: SparkSession, root: str, name: str) -> None:
    """Replace the pointer by one that names ``name``, whole or not at all."""
    fs, pointer = hadoop_path(spark, f"{root}/{POINTER}")
    pointer = fs.makeQualified(pointer)
    scheme = pointer.toUri().getScheme()
    fresh = f"{root}/{POINTER}-{uuid.uuid4().hex}"
    if scheme == "file":
        target = pointer.toUri().getPath()
        local = f"{target}-{uuid.uuid4().hex}"
        with open(local, "w") as out:
            out.write(name)
            out.flush()
            os.fsync(out.fileno())
        os.replace(local, target)
    elif scheme in RENAMING:
        jvm = spark._jvm
        fresh_path = fs.makeQualified(hadoop_path(spark, fresh)[1])
        _write(fs, fresh_path, name)
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(pointer.toUri(), spark._jsc.hadoopConfiguration())
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        options = spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        context.rename(fresh_path, pointer, options)
    else:  # an object appears whole when its stream is closed
        _write(fs, pointer, name)


def _write(fs, path, text: str) -> None:
    out = fs.create(path, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


@contextmanager
def new_version(spark: SparkSession, root: str) -> Iterator[str]:
    """A new folder below ``root`` that becomes the current version when the block ends well.

    The block may write any number of tables into it, which readers then see together.
    After an error the folder is removed and the version before stays.
    """
    name = f"{PREFIX}{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    fs, folder = hadoop_path(spark, f"{root}/{name}")
    fs.mkdirs(folder)
    try:
        yield f"{root}/{name}"
    except BaseException:
        fs.delete(folder, True)
        raise
    _point_to(spark, root, name)


def sweep(spark: SparkSession, root: str, keep: int = 2, min_age_seconds: float = 3600) -> list[str]:
    """Remove versions older than the last ``keep``, the current one never; returns their names.

    ``min_age_seconds`` leaves time to readers that resolved a version before, and to
    writers that fill a folder now.
    """
    fs, path = hadoop_path(spark, root)
    current = current_version(spark, root)
    if not fs.exists(path):
        return []
    names = sorted(x.getPath().getName() for x in fs.listStatus(path) if x.getPath().getName().startswith(PREFIX))
    stays = {*names[len(names) - keep :], (current or "").rpartition("/")[2]}
    limit = time.time_ns() - int(min_age_seconds * 1e9)
    gone = [n for n in names if n not in stays and int(n.removeprefix(PREFIX).split("-")[0]) < limit]
    for name in gone:
        fs.delete(hadoop_path(spark, f"{root}/{name}")[1], True)
    return gone


def publish_version(
    df: DataFrame, path: str, *, allow_empty: bool = False, fmt: str = "parquet", partition_by: str | None = None
):
    """Write ``df`` as the new version of the table at ``path``; ``read_table`` reads the current one.

    A failure or an empty result leaves the version before. A plain table that stands at
    ``path`` is readable until the pointer is there. Returns the report of the write.
    """
    from vidpulse.sources.sinks import EmptyResult, write_table

    with new_version(df.sparkSession, path) as folder:
        report = write_table(df, folder, "overwrite", fmt, partition_by)
        if report.rows == 0 and not allow_empty:
            raise EmptyResult(f"no rows; {path} was not replaced")
    return report
