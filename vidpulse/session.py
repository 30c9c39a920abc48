"""Session helper and tables staged in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "vidpulse", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs are written for.

    A cluster submits with its own master and sizing; ``conf`` overrides.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        # Call sites are looked up for every column expression otherwise.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def hadoop_path(spark: SparkSession, path: str):
    """``(FileSystem, Path)`` for any URI the session can reach."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or the context's checkpoint folder.

    Where it is unset a local-mode session gets a temporary folder; a cluster
    has to name one that every executor can reach.
    """
    folder = (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getCheckpointDir()
        or spark.conf.get("spark.vidpulse.localStageDir", None)
    )
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="vidpulse-stage-")
    spark.conf.set("spark.vidpulse.localStageDir", folder)
    fs, jpath = hadoop_path(spark, folder)
    fs.deleteOnExit(jpath)
    return folder


#: Paths staged inside the innermost open scope of the running thread, None outside of scopes.
#: Micro-batches run on threads of their own, so no scope sees tables of another stream.
_scope: ContextVar[list[str] | None] = ContextVar("scope", default=None)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Tables that ``stage`` writes inside are removed at the end; results must be written before."""
    own: list[str] = []
    outer = _scope.set(own)
    try:
        yield
    finally:
        _scope.reset(outer)
        for path in own:
            fs, jpath = hadoop_path(spark, path)
            fs.delete(jpath, True)


def stage(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where a result is needed by several jobs: later jobs prune columns on
    the written table instead of repeating the work, its file size lets the
    planner choose join strategies, and a lost executor costs nothing. ``options`` go
    to the writer. The table goes with the ``staging`` scope around it, or else when the
    session's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    staged = _scope.get()
    if staged is not None:
        staged.append(path)
    df.write.options(**options).parquet(path)
    fs, jpath = hadoop_path(spark, path)
    fs.deleteOnExit(jpath)
    return spark.read.schema(df.schema).parquet(path)
