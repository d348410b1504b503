"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_run: ContextVar[str | None] = ContextVar("run", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Where none is named, a temporary folder is used in local mode only: on a cluster a
    machine-local folder would not be visible to the other executors.
    """
    named = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_SETTING} to a folder that all executors can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="reviewmart-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses; in the run's folder if there is one."""
    return f"{_run.get() or shared_folder(spark)}/{label}-{uuid4().hex}"


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """A folder of the shared one for all intermediate tables made meanwhile, removed at the end.

    What is still needed afterwards must be written elsewhere.
    """
    folder = f"{shared_folder(spark)}/run-{uuid4().hex}"
    token = _run.set(folder)
    try:
        yield folder
    finally:
        _run.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files under ``path``, as its file system tells."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()


def remove_folders(
    spark: SparkSession, root: str, keep: tuple[str | None, ...], prefix: str = ""
) -> None:
    """Remove the folders right under ``root`` whose name has the prefix and is not among ``keep``."""
    at = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.listStatus(at):
        name = status.getPath().getName()
        if name.startswith(prefix) and name not in keep:
            files.delete(status.getPath(), True)


def cut(
    df: DataFrame, label: str, lasting: bool = False, compression: str | None = None
) -> DataFrame:
    """Write ``df`` to the shared folder and return it read back.

    Used for per-key summaries that a larger table is joined to next: they are computed once,
    can be measured before the join is chosen, and survive the loss of an executor. With ``lasting``
    it also survives the end of a ``run_folder``. ``compression`` is for tables of many rows.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid4().hex}" if lasting else fresh_path(spark, label)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
