"""Where intermediate data goes: the folder every executor can reach, as named by the cluster."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

_CHECKPOINT_CONF = "spark.checkpoint.dir"
# The folder for what a thread stores in passing, see ``passing_folders``.
_PASSING: ContextVar[str | None] = ContextVar("passing", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder from ``spark.checkpoint.dir``; only in local mode without it one below the warehouse folder."""
    configured = spark.conf.get(_CHECKPOINT_CONF, None)
    if configured:
        return configured
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError(f"set {_CHECKPOINT_CONF} to a folder shared by all executors")
    folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared-{uuid.uuid4().hex}"
    context.setCheckpointDir(folder)
    return folder


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing else uses."""
    base = _PASSING.get() or shared_folder(spark).rstrip("/")
    return f"{base}/{label}-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder with all that is in it; none is there no more, which is as well."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def passing_folders(spark: SparkSession) -> Iterator[None]:
    """Inside, by this thread, fresh folders are for the time being: deleted at the end.

    For work whose result has been written somewhere else by then.
    """
    folder = fresh_folder(spark, "passing")
    outer = _PASSING.set(folder)
    try:
        yield
    finally:
        _PASSING.reset(outer)
        delete_folder(spark, folder)
