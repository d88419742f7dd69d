"""Layered tables as immutable Parquet snapshots with an atomic publish.

A table is a folder ``<root>/<layer>/<table>``. Every write goes to a new data folder that nobody
reads yet. Publishing adds one small commit file that names the folders making up the snapshot; the
highest commit is the current one. So a load that fails half-way changes nothing, and a merge never
overwrites what it is reading.

A snapshot can be bucketed and sorted by its key. Merges, key checks and fact loads then find both
sides already co-partitioned and shuffle only what is new.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratamart.session import unsorted_partitions
from stratamart.specs import LAYERS

_COMMITS = "_commits"
#: Measured in every write: its rows, and a sum over their hashes.
ROWS, CHECKSUM = "rows", "checksum"
#: Every layer holds about the same rows, so what a codec saves counts several times.
CODEC = "zstd"
#: Bytes of a row in memory besides its values.
_ROW_BYTES = 8


def empty_frame(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows of a schema; Spark plans joins with it away."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def plan_size(df: DataFrame) -> int:
    """Spark's own estimate of the bytes in a DataFrame; for stored tables it follows their files."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def bucket_count_for(df: DataFrame, bucket_bytes: int = 32 << 20) -> int:
    """How many buckets a table about as large as ``df`` needs; one if it fits one, whatever the cores.

    ``bucket_bytes`` are of rows in memory, by Spark's width of their types: a task sorts and joins a bucket
    as rows, and files hold them in anything from a tenth to a third of that. Rows are counted, for stored tables
    in the footers.
    """
    most = int(df.sparkSession.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000"))
    in_memory = df.count() * (_ROW_BYTES + df._jdf.schema().defaultSize())
    return min(most, max(1, -(-in_memory // bucket_bytes)))


def _version_of(folder: str) -> int:
    """The version that a data folder was written for."""
    return int(folder.split("-")[1])


@dataclass(frozen=True)
class Snapshot:
    """A written version of a table: its data folders (none if empty) and the layout if bucketed."""

    layer: str
    table: str
    version: int
    folders: tuple[str, ...]
    schema: StructType
    bucket_count: int = 0
    bucket_keys: tuple[str, ...] = ()
    # What was measured while each folder was written, "rows" and "checksum" among it.
    measured: Mapping[str, Mapping[str, Any]] = field(default_factory=dict, compare=False)
    # Feed files (path, bytes, time of change) that each folder was read from, if it was.
    files: Mapping[str, tuple[tuple[str, int, int], ...]] = field(default_factory=dict, compare=False)
    # What the version was made from: the run and the state of every input, see ``plans.jobs``.
    made_from: Mapping[str, Any] = field(default_factory=dict, compare=False)

    @property
    def metrics(self) -> Mapping[str, Any]:
        """What was measured in the last write."""
        return self.measured[self.folders[-1]] if self.folders else {}

    def over_folders(self, name: str, combine: Callable[[Iterable[Any]], Any]) -> Any:
        """A measure of the whole table from those of its folders; NULLs are left out."""
        values = [self.measured[f][name] for f in self.folders if self.measured[f][name] is not None]
        return combine(values) if values else None

    @property
    def all_rows(self) -> int:
        return self.over_folders(ROWS, sum) or 0

    @property
    def checksum(self) -> str:
        """Of the rows in all folders, in any order: equal tables have equal ones."""
        return f"{self.all_rows}:{self.over_folders(CHECKSUM, sum) or 0}"

    def landed_files(self) -> dict[str, tuple[int, int]]:
        """Bytes and time of change of every feed file in the table."""
        return {path: (size, changed) for f in self.folders for path, size, changed in self.files.get(f, ())}

    def to_json(self) -> str:
        return json.dumps(
            {
                "folders": self.folders,
                "schema": self.schema.jsonValue(),
                "bucket_count": self.bucket_count,
                "bucket_keys": self.bucket_keys,
                "measured": {f: {n: _to_text(v) for n, v in m.items()} for f, m in self.measured.items()},
                "files": self.files,
                "made_from": self.made_from,
            }
        )

    @staticmethod
    def from_json(layer: str, table: str, version: int, text: str) -> Snapshot:
        stored = json.loads(text)
        return Snapshot(
            layer,
            table,
            version,
            tuple(stored["folders"]),
            StructType.fromJson(stored["schema"]),
            stored["bucket_count"],
            tuple(stored["bucket_keys"]),
            {f: {n: _from_text(v) for n, v in m.items()} for f, m in stored["measured"].items()},
            {f: tuple(map(tuple, listed)) for f, listed in stored["files"].items()},
            stored["made_from"],
        )


def _to_text(value: Any) -> Any:
    return {"decimal": str(value)} if isinstance(value, Decimal) else value


def _from_text(value: Any) -> Any:
    return Decimal(value["decimal"]) if isinstance(value, dict) else value


class Warehouse:
    """The tables below one root folder on any Hadoop-compatible file system.

    ``buckets`` maps table names to bucket counts; size them so that one bucket fits a task (see
    ``bucket_count_for``). Tables left out are plain Parquet.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: Mapping[str, int] | None = None):
        self.spark = spark
        self.buckets = dict(buckets or {})
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())
        self.root = self._fs.makeQualified(self._path(root)).toString().rstrip("/")

    # -- layers ---------------------------------------------------------------------------------

    def reset(self) -> None:
        """Drop every layer with its tables and create the layers again."""
        for layer in LAYERS:
            for table in self._children(self.root, layer):
                for folder in self._children(self.root, layer, table):
                    self._delete_data(layer, table, folder)
            self._fs.delete(self._path(self.root, layer), True)
            self._fs.mkdirs(self._path(self.root, layer))

    def layers(self) -> list[str]:
        """Existing layers in name order."""
        return self._children(self.root)

    def tables(self, layer: str, like: str | None = None) -> list[str]:
        """Tables of a layer in name order; ``like`` is an SQL pattern with % and _."""
        names = [t for t in self._children(self.root, layer) if self.exists(layer, t)]
        if like is not None:
            pattern = re.compile(
                "".join({"%": ".*", "_": "."}.get(ch, re.escape(ch)) for ch in like), re.DOTALL
            )
            names = [t for t in names if pattern.fullmatch(t)]
        return names

    # -- tables ---------------------------------------------------------------------------------

    def create(self, layer: str, table: str, schema: StructType) -> None:
        """Create the table empty, replacing what was there."""
        self.publish(Snapshot(layer, table, self._next_version(layer, table), (), schema))

    def exists(self, layer: str, table: str) -> bool:
        return bool(self._commit_versions(layer, table))

    def current(self, layer: str, table: str) -> Snapshot:
        versions = self._commit_versions(layer, table)
        if not versions:
            raise LookupError(f"no table {layer}.{table} below {self.root}")
        commit = self._path(self.root, layer, table, _COMMITS, f"{versions[-1]:08d}")
        return Snapshot.from_json(layer, table, versions[-1], self._read_text(commit))

    def read(self, layer: str, table: str, bucketed: bool = True) -> DataFrame:
        """The published snapshot; without ``bucketed`` as plain files, see ``read_snapshot``."""
        return self.read_snapshot(self.current(layer, table), bucketed)

    def count(self, layer: str, table: str) -> int:
        """Rows of the published snapshot, as counted when they were written."""
        return self.current(layer, table).all_rows

    def read_snapshot(self, snapshot: Snapshot, bucketed: bool = True) -> DataFrame:
        """A written snapshot, published or not.

        Spark brings what is joined with a bucketed table by its key into as many tasks as that has buckets. Where
        the other side is the larger one, as in a lookup, read the table without ``bucketed``.
        """
        if not snapshot.folders:
            return empty_frame(self.spark, snapshot.schema)
        if snapshot.bucket_count and bucketed:
            return self.spark.table(self._register(snapshot))
        paths = [f"{self.root}/{snapshot.layer}/{snapshot.table}/{f}" for f in snapshot.folders]
        return self.spark.read.schema(snapshot.schema).parquet(*paths)

    def write(
        self,
        layer: str,
        table: str,
        rows: DataFrame,
        keys: tuple[str, ...] = (),
        append: bool = False,
        merged_from: Snapshot | None = None,
        measure: Mapping[str, Column] | None = None,
        measured_only: tuple[str, ...] = (),
        partition_by: tuple[str, ...] = (),
        files: Iterable[tuple[str, int, int]] = (),
        made_from: Mapping[str, Any] | None = None,
    ) -> Snapshot:
        """Write a new, unpublished version; with ``append`` it includes the current one.

        ``merged_from`` is the target snapshot ``rows`` were merged with. If it has the same buckets,
        the merge already left each bucket in one task; otherwise rows are brought together first.
        ``measure`` names aggregates to take in passing; they, the row count and a checksum are the snapshot's
        ``metrics``, so a check needs no second pass over the data. They stay with the folder, so that
        those of a table of several folders can be combined. Columns in ``measured_only`` are
        there for these aggregates and not written. Rows are put in one folder for each value of
        ``partition_by``, so that a reader of some values opens no other files. ``files`` and ``made_from``
        are kept with the snapshot.
        """
        version = self._next_version(layer, table)
        folder = f"data-{version:08d}-{uuid.uuid4().hex[:8]}"
        location = f"{self.root}/{layer}/{table}/{folder}"
        bucket_count = self.buckets.get(table, 0) if keys and not append else 0
        layout = (merged_from.bucket_count, merged_from.bucket_keys) if merged_from else None
        if bucket_count and layout != (bucket_count, keys):
            rows = rows.repartition(bucket_count, *keys)
        observation = Observation()
        written = [F.col(f"`{c}`") for c in rows.columns if c not in measured_only]
        taken = {ROWS: F.count(F.lit(1)), CHECKSUM: F.sum(F.xxhash64(*written).cast("decimal(38,0)"))} | dict(measure or {})
        observed = rows.observe(observation, *[c.alias(n) for n, c in taken.items()])
        observed = observed.drop(*measured_only)
        writer = observed.write.format("parquet").mode("errorifexists").option("compression", CODEC)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        before = self.current(layer, table) if append and self.exists(layer, table) else None
        if bucket_count:
            name = self._catalog_name(layer, table, folder)
            (
                writer.bucketBy(bucket_count, *keys)
                .sortBy(*keys)
                .option("path", location)
                .saveAsTable(name)
            )
        else:
            with unsorted_partitions(self.spark):
                writer.save(location)
        return Snapshot(
            layer,
            table,
            version,
            (*(before.folders if before else ()), folder),
            observed.schema,
            bucket_count,
            keys if bucket_count else (),
            {**(before.measured if before else {}), folder: dict(observation.get)},
            {**(before.files if before else {}), folder: tuple(files)},
            dict(made_from or {}),
        )

    def publish(self, snapshot: Snapshot) -> None:
        """Make a written version the current one, in one step."""
        commits = (self.root, snapshot.layer, snapshot.table, _COMMITS)
        hidden = self._path(*commits, f".{snapshot.version:08d}-{uuid.uuid4().hex[:8]}")
        final = self._path(*commits, f"{snapshot.version:08d}")
        self._write_text(hidden, snapshot.to_json())
        if not self._fs.rename(hidden, final):
            raise RuntimeError(f"{snapshot.layer}.{snapshot.table}: version taken by another writer")

    def vacuum(self, layer: str, table: str, keep: int = 2) -> None:
        """Delete data of versions before the last ``keep`` published ones that none of these uses.

        Data of later versions stays, also if nothing names it yet: it may be just being written. Whoever
        still reads an older version than those kept will miss its files.
        """
        if keep < 1:
            raise ValueError("the current version must be kept")
        commits = self._commit_versions(layer, table)
        if not commits:
            return
        oldest = commits[-keep:][0]
        kept = set()
        for version in commits[-keep:]:
            commit = self._path(self.root, layer, table, _COMMITS, f"{version:08d}")
            kept.update(Snapshot.from_json(layer, table, version, self._read_text(commit)).folders)
        for version in commits[:-keep]:
            self._fs.delete(self._path(self.root, layer, table, _COMMITS, f"{version:08d}"), False)
        for folder in self._children(self.root, layer, table):
            if folder not in kept and _version_of(folder) < oldest:
                self._delete_data(layer, table, folder)

    def drop(self, layer: str, table: str) -> None:
        """Delete a table with all its versions."""
        for folder in self._children(self.root, layer, table):
            self._delete_data(layer, table, folder)
        self._fs.delete(self._path(self.root, layer, table), True)

    def _delete_data(self, layer: str, table: str, folder: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS `{self._catalog_name(layer, table, folder)}`")
        self._fs.delete(self._path(self.root, layer, table, folder), True)

    # -- catalog names for bucketed snapshots ---------------------------------------------------

    def _catalog_name(self, layer: str, table: str, folder: str) -> str:
        where = hashlib.sha1(f"{self.root}/{folder}".encode()).hexdigest()[:16]
        return f"{layer}__{table}__{where}"

    def _register(self, snapshot: Snapshot) -> str:
        """Bucketing is a catalog property in Spark: declare it for files written elsewhere too."""
        name = self._catalog_name(snapshot.layer, snapshot.table, snapshot.folders[0])
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in snapshot.schema)
            keys = ", ".join(f"`{k}`" for k in snapshot.bucket_keys)
            location = f"{self.root}/{snapshot.layer}/{snapshot.table}/{snapshot.folders[0]}"
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS `{name}` ({columns}) USING parquet "
                f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {snapshot.bucket_count} BUCKETS "
                f"LOCATION '{location}'"
            )
        return name

    # -- file system ----------------------------------------------------------------------------

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join(parts))

    def _children(self, *parts: str) -> list[str]:
        folder = self._path(*parts)
        if not self._fs.exists(folder):
            return []
        names = [status.getPath().getName() for status in self._fs.listStatus(folder)]
        return sorted(n for n in names if not n.startswith((".", "_")))

    def _commit_versions(self, layer: str, table: str) -> list[int]:
        return [int(name) for name in self._children(self.root, layer, table, _COMMITS)]

    def _next_version(self, layer: str, table: str) -> int:
        versions = self._commit_versions(layer, table)
        return versions[-1] + 1 if versions else 1

    def _read_text(self, path) -> str:
        stream = self._fs.open(path)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _write_text(self, path, text: str) -> None:
        stream = self._fs.create(path, False)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
