"""Splitting groups of vectors that hold too many rows, level by level, on the executors.

A first division is fitted on one bounded sample, so it has a bounded number of groups, however large the
table is. A group that is still too large is divided by spherical k-means on a sample of its own rows, in one
task a group; its rows are then assigned in tasks of their own, each with the centres of its group. What comes
out is looked at again, so groups grow in number and not in size. A group that cannot be divided, because
its vectors point the same way, stays as it is.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.llm.common import materialise
from stratamart.llm.vectors import matrix, spherical_kmeans, unit
from stratamart.sources.warehouse import plan_size

#: Parts that a group is divided into at most, rows that this is fitted on, and rows assigned in one task.
PARTS, SAMPLE_ROWS, CHUNK_ROWS = 64, 4_096, 32_768
#: A part with more than this share of a group's sample is no division of it.
_LARGEST_SHARE = 0.9
#: Bytes of a stored table up to which it is sent to every task; larger ones are joined by a shuffle.
SENT_BYTES = 8 << 20

CENTRES = "array<array<double>>"


def sent(df: DataFrame) -> DataFrame:
    """A stored table, marked to be sent to every task if it is small enough."""
    return F.broadcast(df) if plan_size(df) <= SENT_BYTES else df


def vectors_of(column: pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length as rows of doubles."""
    return matrix(column, len(column[0]) if len(column) else 0)


def _fitted(group: Sequence[str], part_rows: int, divides: Callable[[np.ndarray, np.ndarray], bool]):
    def run(rows: pa.Table) -> pa.Table:
        units, n = unit(vectors_of(rows.column("vector"))), rows.column("n")[0].as_py()
        key = rows.select([*group, "n"]).slice(0, 1)
        parts = min(PARTS, -(-n // part_rows), len(units) // 8)
        if parts > 1:
            centres = spherical_kmeans(units, parts)
            used, counts = np.unique((units @ centres.T).argmax(1), return_counts=True)
            centres = centres[used]
            if len(used) > 1 and counts.max() <= _LARGEST_SHARE * len(units) and divides(units, centres):
                kind = pa.list_(pa.list_(pa.float64()))
                return key.append_column("centres", pa.array([centres.tolist()], kind))
        return key.slice(0, 0).append_column("centres", pa.array([], pa.list_(pa.list_(pa.float64()))))

    return run


def division(
    rows: DataFrame,
    group: Sequence[str],
    key: str,
    limit: int,
    part_rows: int,
    divides: Callable[[np.ndarray, np.ndarray], bool] = lambda units, centres: True,
) -> DataFrame | None:
    """(group, n, centres) of every group of more than ``limit`` rows that can be divided; None if there is none.

    ``divides`` may refuse centres after a look at the sample, given as unit vectors.
    """
    sizes = materialise(rows.groupBy(*group).agg(F.count("*").alias("n")).where(F.col("n") > limit), "large-groups")
    if sizes.isEmpty():
        return None
    every = F.ceil(F.col("n") / SAMPLE_ROWS)
    sample = rows.join(sent(sizes), list(group)).where(F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), every) == 0)
    types = dict(rows.dtypes)
    ddl = ", ".join([*[f"{c} {types[c]}" for c in group], "n long", f"centres {CENTRES}"])
    fitted = sample.select(*group, "n", "vector").groupBy(*group).applyInArrow(_fitted(group, part_rows, divides), ddl)
    found = materialise(fitted, "centres")
    return None if found.isEmpty() else found


def divide(
    rows: DataFrame, centres: DataFrame, group: Sequence[str], key: str, assign: Callable[[pa.Table, np.ndarray], pa.Table], ddl: str
) -> tuple[DataFrame, DataFrame]:
    """The rows of groups without centres as they are, and what ``assign`` makes of those of the others.

    ``assign`` gets some rows of a group and its centres, one a row.
    """
    divided = sent(centres.select(*group))
    stay = rows.join(divided, list(group), "left_anti")
    counts = rows.join(divided, list(group)).groupBy(*group).agg(F.ceil(F.count("*") / CHUNK_ROWS).cast("int").alias("chunks"))
    chunks = materialise(counts, "chunks")
    chunk = F.pmod(F.xxhash64(F.lit("chunk"), F.col(key)), F.col("chunks")).cast("int")
    columns = [c for c in rows.columns]
    left = rows.join(sent(chunks), list(group)).select(*columns, chunk.alias("chunk"))
    right = centres.join(chunks, list(group)).select(
        *group, "centres", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk")
    )
    by = [*group, "chunk"]

    def run(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        return assign(mine.select(columns), np.array(theirs.column("centres")[0].as_py()))

    return stay, left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(run, ddl)
