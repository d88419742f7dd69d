"""Session settings the library is written for."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def get_spark(app: str = "stratamart", master: str | None = None, **conf: object) -> SparkSession:
    """A session with adaptive execution (coalescing, skew splitting), ANSI casts and UTC times."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # Bucketed snapshots have one sorted file per bucket: merges need not sort them again.
        "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # Recording a Python call site for every column costs more than planning small merges.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    } | {k: str(v) for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Bytes of input for each shuffle partition before adaptive execution merges small ones.
_PARTITION_BYTES = 128 << 20
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


@contextmanager
def shuffles_for(spark: SparkSession, input_bytes: int) -> Iterator[None]:
    """Inside, shuffles start with enough partitions for the input; adaptive execution can only merge them.

    A number set for the session is kept.
    """
    wanted = -(-input_bytes // _PARTITION_BYTES)
    if spark.conf.get(_INITIAL, None) or wanted <= int(spark.conf.get("spark.sql.shuffle.partitions")):
        yield
        return
    spark.conf.set(_INITIAL, wanted)
    try:
        yield
    finally:
        spark.conf.unset(_INITIAL)


_held, _held_lock = Counter(), Lock()


@contextmanager
def _setting(spark: SparkSession, name: str, value: object, unset: str) -> Iterator[None]:
    """Inside, a setting of the session has a value, unless the session gives it one other than ``unset``.

    Several threads may be inside at once, the last one resets the session.
    """
    key = (id(spark), name)
    with _held_lock:
        ours = _held[key] > 0 or spark.conf.get(name, unset) == unset
        if ours:
            _held[key] += 1
            spark.conf.set(name, value)
    try:
        yield
    finally:
        with _held_lock:
            if ours:
                _held[key] -= 1
                if not _held[key]:
                    spark.conf.unset(name)


#: Files a task may hold open at once in a write with partition columns; with none its rows are sorted by these first.
_OPEN_FILES = 8


@contextmanager
def unsorted_partitions(spark: SparkSession) -> Iterator[None]:
    """Inside, a write with few values in its partition columns does not sort the rows of each task by them.

    Such a sort holds a whole input split as rows. A number set for the session is kept; a task that meets more
    values sorts the rest.
    """
    with _setting(spark, "spark.sql.maxConcurrentOutputFileWriters", _OPEN_FILES, "0"):
        yield


@contextmanager
def passing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside, what a write or another action has shuffled leaves the disks when that ends.

    Else it stays until the driver collects its garbage, and a load of many writes holds the shuffles of all.
    """
    with _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true", "false"):
        yield


def require_ansi(spark: SparkSession) -> None:
    """Without ANSI casts a malformed number would become NULL, then a default: refuse to load."""
    if spark.conf.get("spark.sql.ansi.enabled", "true").lower() != "true":
        raise RuntimeError("spark.sql.ansi.enabled must be true: bad values have to fail the load")


def timestamp_literal(value: dt.datetime) -> Column:
    """The run timestamp as a zone-less literal; one with a zone is taken in UTC."""
    if value.tzinfo is not None:
        value = value.astimezone(dt.UTC).replace(tzinfo=None)
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
