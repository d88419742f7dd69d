"""Delimited feeds: positional, all-text scans and their landing tables."""

from __future__ import annotations

import codecs
import csv
import datetime as dt
import re
from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.session import timestamp_literal
from stratamart.sources.multiline import read_records
from stratamart.sources.warehouse import Snapshot, Warehouse
from stratamart.specs import AUDIT_CREATED, LANDING, FeedSpec

_QUOTE = '"'
# Stands for a quoted empty field ("") while reading. NUL cannot be part of a text value.
_QUOTED_EMPTY = "\u0000"
# Separates nothing: a control character that no text feed holds.
_NO_DELIMITER = "\u0001"
# One-byte line breaks and quotes, so that lines can be found before decoding.
_ASCII_COMPATIBLE = {"utf-8", "ascii", "iso8859-1", "iso8859-15", "cp1252"}
# Those of them that Spark can decode as an expression, by Spark's names.
_DECODED = {"utf-8": "UTF-8", "ascii": "US-ASCII", "iso8859-1": "ISO-8859-1"}


def _hadoop_path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file, folder or glob exists on whatever file system the path names."""
    hadoop_path, fs = _hadoop_path(spark, path)
    return bool(fs.globStatus(hadoop_path))


def folder_bytes(spark: SparkSession, path: str) -> int:
    """The size of all files below a folder."""
    hadoop_path, fs = _hadoop_path(spark, path)
    return int(fs.getContentSummary(hadoop_path).getLength())


def feed_files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, bytes, time of change) of the files that a feed at a path consists of, in order of their paths."""
    hadoop_path, fs = _hadoop_path(spark, path)
    files = []
    for status in fs.globStatus(hadoop_path) or []:
        entries = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
        files += [
            (e.getPath().toString(), int(e.getLen()), int(e.getModificationTime()))
            for e in entries
            if not e.isDirectory() and not e.getPath().getName().startswith(("_", "."))
        ]
    return sorted(files)


def _first_file(spark: SparkSession, path: str | Sequence[str]) -> str:
    files = [path] if isinstance(path, str) else path
    found = [f for p in files for f, _, _ in feed_files(spark, p)]
    if not found:
        raise FileNotFoundError(path)
    return min(found)


def resolve_delimiter(spark: SparkSession, path: str | Sequence[str], spec: FeedSpec) -> str:
    """The delimiter fixed for the feed, else the one sniffed from its first line."""
    if spec.delimiter is not None:
        return spec.delimiter
    header = spark.read.text(_first_file(spark, path)).limit(1).first()
    if header is None:
        raise ValueError(f"{path}: no header line to take the delimiter from")
    return csv.Sniffer().sniff(header.value).delimiter


def _well_formed(line: Column, delimiter: str, fields: int) -> Column:
    """As many fields as declared, each without a quote or quoted from end to end with inner quotes doubled."""
    sep = re.escape(delimiter)
    field = f'(?:"(?:[^"]++|"")*+"|[^"{sep}]*+)'
    quoted = line.rlike(f"^{field}(?:{sep}{field}){{{fields - 1}}}+\\z")
    plain = F.length(line) - F.length(F.replace(line, F.lit(delimiter), F.lit(""))) == fields - 1
    return F.when(F.contains(line, F.lit(_QUOTE)), quoted).otherwise(plain)


def _parse_options(delimiter: str) -> dict[str, str]:
    return {
        "sep": delimiter,
        "quote": _QUOTE,
        "escape": _QUOTE,
        "emptyValue": _QUOTED_EMPTY,
        "mode": "FAILFAST",
        "unescapedQuoteHandling": "RAISE_ERROR",
    }


def _by_line(spark: SparkSession, path: str | list[str], spec: FeedSpec, delimiter: str) -> DataFrame:
    """Every line is a record: files stay splittable and are read once.

    Lines are scanned whole, without their files' header lines, checked and then parsed by Spark. A line
    whose quotes do not enclose whole fields fails the feed: it is malformed or part of a longer record.
    """
    if codecs.lookup(spec.encoding).name not in _ASCII_COMPATIBLE:
        raise ValueError(f"{spec.file}: lines of {spec.encoding} files cannot be told apart; set multiline=True")
    lines = (
        spark.read.schema("line string")
        .option("header", True)
        .option("enforceSchema", True)
        .option("sep", _NO_DELIMITER)
        .option("quote", "")
        .option("encoding", spec.encoding)
        .option("mode", "FAILFAST")
        .csv(path)
    )
    return _parsed(lines, spec, delimiter, " (a line break inside quotes needs multiline=True)")


def _parsed(lines: DataFrame, spec: FeedSpec, delimiter: str, hint: str = "", **options: object) -> DataFrame:
    """The fields of every record in ``line``. One that is not well formed fails the feed."""
    line = F.col("line")
    message = F.concat(
        F.lit(f"{spec.file}: MALFORMED line, {len(spec.columns)} fields and quotes around whole fields are expected{hint}: "),
        F.substring(line, 1, 200),
    )
    # A filter, so that it is checked however few columns are asked for.
    checked = lines.where(F.when(_well_formed(line, delimiter, len(spec.columns)), True).otherwise(F.raise_error(message)))
    ddl = ", ".join(f"`{c}` string" for c in spec.columns)
    return checked.select(F.from_csv(line, ddl, _parse_options(delimiter) | options).alias("record")).select("record.*")


def _by_record(spark: SparkSession, path: str | list[str], spec: FeedSpec, delimiter: str) -> DataFrame:
    """Records may span lines: found in parallel where quotes and line feeds can be told apart as bytes."""
    charset = _DECODED.get(codecs.lookup(spec.encoding).name)
    if charset is None:
        return _whole_files(spark, path, spec, delimiter)
    return _parsed(read_records(spark, path, charset), spec, delimiter, multiLine="true")


def _whole_files(spark: SparkSession, path: str | list[str], spec: FeedSpec, delimiter: str) -> DataFrame:
    """Records may span lines, and only decoding the file from its start finds them: one task for each file."""
    return (
        spark.read.schema(spec.schema())
        .option("header", True)
        .option("enforceSchema", True)
        .options(**_parse_options(delimiter))
        .option("encoding", spec.encoding)
        .option("columnPruning", False)  # else a short row goes unnoticed under a narrow projection
        .option("multiLine", True)
        .csv(path)
    )


def _paths(path: str | Sequence[str]) -> str | list[str]:
    return path if isinstance(path, str) else list(path)


def read_feed(spark: SparkSession, path: str | Sequence[str], spec: FeedSpec) -> DataFrame:
    """All-text scan by position: header dropped, unquoted empty = NULL, quoted empty = ''.

    A row with another number of fields than the feed declares raises, as do misplaced quotes. How records
    are found is up to the feed's spec alone, never to its content.
    """
    if not spec.columns:
        raise ValueError(f"{spec.file}: no columns declared")
    if spec.refuse_blank_lines and not spark.read.text(_paths(path)).where(F.trim("value") == "").isEmpty():
        raise ValueError(f"{spec.file}: blank lines")
    delimiter = resolve_delimiter(spark, path, spec)
    raw = (_by_record if spec.multiline else _by_line)(spark, _paths(path), spec, delimiter)
    return raw.select(
        *[F.when(F.col(c) == _QUOTED_EMPTY, F.lit("")).otherwise(F.col(c)).alias(c) for c in spec.columns]
    )


def land(
    warehouse: Warehouse,
    rows: DataFrame,
    table: str,
    run_ts: dt.datetime,
    truncate: bool = True,
    files: Iterable[tuple[str, int, int]] = (),
    made_from: Mapping[str, Any] | None = None,
) -> Snapshot:
    """Write raw rows with their load time, replacing the landing table or adding to it.

    ``files`` tells the commit which feed files the rows are from, see ``new_files``.
    """
    stamped = rows.withColumn(AUDIT_CREATED, timestamp_literal(run_ts))
    snapshot = warehouse.write(LANDING, table, stamped, append=not truncate, files=files, made_from=made_from)
    warehouse.publish(snapshot)
    return snapshot


def new_files(warehouse: Warehouse, table: str, files: Sequence[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Those of a feed's files that the landing table does not hold yet.

    A file that changed after it was landed is an error: its old rows cannot be told from those of others.
    """
    landed = warehouse.current(LANDING, table).landed_files() if warehouse.exists(LANDING, table) else {}
    changed = [path for path, size, time in files if landed.get(path, (size, time)) != (size, time)]
    if changed:
        raise ValueError(f"{table}: changed after it was landed: {', '.join(changed[:3])}")
    return [f for f in files if f[0] not in landed]
