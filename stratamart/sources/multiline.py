"""Records that span lines, found in parallel in files that stay split.

Whether a place of a file lies inside quotes depends on all quotes before it. A first pass counts them for
each split, one small row, and a running sum over the splits of a file says how each of them begins. With
that, every split finds its records by itself. Only a record that goes over a split's border is sent on: the
parts of it are put together by key, and there are at most two for each split. Splits without such a border
are left out before their lines are looked at again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A record of more bytes fails the feed: a quote that is never closed would make one of all that follows.
MAX_RECORD_BYTES = 64 << 20

_SPLIT = ["file", "start"]
_WHOLE, _GOES_ON, _OPENS = 0, 1, 2
_PARTS = "file string, start long, header boolean, kind int, record binary"


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Raw lines, by line feeds alone, with the split that each was read from; in order within a split."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("value").cast("binary").alias("line"),
    )


def split_states(lines: DataFrame) -> DataFrame:
    """(file, start, inside, open): whether a split begins, and ends, inside quotes. One row a split."""
    line = F.col("line").cast("string")
    quotes = F.octet_length(line) - F.octet_length(F.replace(line, F.lit('"'), F.lit("")))
    counted = lines.groupBy(*_SPLIT).agg(F.sum(quotes).alias("quotes"))
    upto = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("quotes").over(upto)
    return counted.select(*_SPLIT, ((total - F.col("quotes")) % 2 == 1).alias("inside"), (total % 2 == 1).alias("open"))


def _cut(max_record: int):
    """The records, and the parts of records, of every split; lines come in order, some splits to a task."""
    schema = pa.schema(
        [("file", pa.string()), ("start", pa.int64()), ("header", pa.bool_()), ("kind", pa.int32()), ("record", pa.binary())]
    )

    def made(key, header, kind, records: pa.Array) -> pa.RecordBatch:
        n = len(records)
        columns = [pa.array([key[0]] * n, pa.string()), pa.array([key[1]] * n, pa.int64()), pa.array([header] * n, pa.bool_())]
        return pa.RecordBatch.from_arrays([*columns, pa.array([kind] * n, pa.int32()), records], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, inside, held, size, begun, first = None, False, [], 0, False, False

        def put(kind):
            """What is held, as one record or part; the first record of a file is its header."""
            nonlocal held, size, first
            record, header, first = pa.array([b"\n".join(held)], pa.binary()), first, False
            held, size = [], 0
            if not (header and kind == _WHOLE):
                yield made(key, header, kind, record)

        for batch in batches:
            files, starts = batch.column("file").to_numpy(zero_copy_only=False), batch.column("start").to_numpy()
            borders = (np.flatnonzero((files[1:] != files[:-1]) | (starts[1:] != starts[:-1])) + 1).tolist()
            for low, high in zip([0, *borders], [*borders, batch.num_rows], strict=True):
                if low == high:
                    continue
                if (files[low], starts[low]) != key:
                    if held:
                        yield from put(_OPENS if begun else _GOES_ON)
                    key, inside = (files[low], int(starts[low])), batch.column("inside")[low].as_py()
                    if inside is None:
                        raise ValueError(f"{key[0]}: its splits are not those in which quotes were counted")
                    begun, first = not inside, key[1] == 0
                lines = batch.column("line").slice(low, high - low)
                after = (int(inside) + np.cumsum(pc.count_substring(lines, b'"').to_numpy())) % 2 == 1
                before = np.r_[inside, after[:-1]]
                single = ~before & ~after
                if first and not held and single[0]:
                    single[0], first = False, False
                for at in np.flatnonzero(before | after).tolist():
                    held.append(lines[at].as_py())
                    size += len(held[-1]) + 1
                    if size > max_record:
                        raise ValueError(f"{key[0]}: MALFORMED, over {max_record} bytes in one record; is a quote never closed?")
                    if not after[at]:
                        yield from put(_WHOLE if begun else _GOES_ON)
                        begun = True
                if single.any():
                    yield made(key, False, _WHOLE, lines.filter(pa.array(single)))
                inside = bool(after[-1])
        if held:
            yield from put(_OPENS if begun else _GOES_ON)

    return run


def _joined_parts(parts: DataFrame) -> DataFrame:
    """Records from their parts. A part that opens one is followed by those that go on with it."""
    order = Window.partitionBy("file").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, 0)
    numbered = parts.withColumn("number", F.sum((F.col("kind") == _OPENS).cast("long")).over(order))
    pieces = F.array_sort(F.collect_list(F.struct("start", "kind", "record")))
    whole = numbered.groupBy("file", "number").agg(F.bool_or("header").alias("header"), pieces.alias("pieces"))
    text = F.array_join(F.transform("pieces", lambda p: p["record"].cast("string")), "\n")
    return whole.where(~F.col("header")).select(text.cast("binary").alias("record"))


def read_records(spark: SparkSession, path: str | list[str], encoding: str, max_record: int = MAX_RECORD_BYTES) -> DataFrame:
    """(line): the records of all files below a path without their headers and without blank ones.

    Lines end in a line feed, with or without a carriage return before it; inside quotes both are kept as
    they are. ``encoding`` is UTF-8 or another that Spark decodes, with quotes and line feeds as in ASCII.
    """
    lines = _lines(spark, path)
    states = split_states(lines)
    # One row for each split of the files, so small beside them at any size.
    begun = lines.join(F.broadcast(states.select(*_SPLIT, "inside")), _SPLIT, "left")
    whole = begun.mapInArrow(_cut(max_record), _PARTS).where(F.col("kind") == _WHOLE).select("record")
    crossed = lines.join(F.broadcast(states.where(F.col("inside") | F.col("open"))), _SPLIT).drop("open")
    parts = crossed.mapInArrow(_cut(max_record), _PARTS).where(F.col("kind") != _WHOLE)
    records = whole.unionByName(_joined_parts(parts))
    text = F.col("record").cast("string") if encoding == "UTF-8" else F.decode("record", encoding)
    line = F.when(F.endswith(text, F.lit("\r")), F.regexp_replace(text, r"\r\z", "")).otherwise(text)
    return records.select(line.alias("line")).where(F.trim("line") != "")
