"""Near-duplicates of vectors: spherical k-means cells, blocked cosine products within them.

Only vectors with one label are compared. A vector belongs to the cell of its nearest centre and also
visits every later cell whose members could be near enough: for unit vectors x of cell b and y of cell j
with |x - y| <= r it holds that x.(c_b - c_j) <= r |c_b - c_j|, so no link across a border is missed and
none is met twice. Equal vectors are one, with a count, before anything is compared. Cells are compared
block by block in tasks of their own; a task returns counts and a spanning forest, never all pairs. Cells that
hold too many vectors are divided again by the same rule, as often as it takes (see ``cells``): there a
visitor goes on to every part whose members could be near enough, and a member to its own and later ones.
Only vectors so near each other that parts would not tell them apart stay together, in blocks.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and those
without a label, have no links and their own id as component. Vectors of different lengths are not
compared. Repeated rows are linked to each other like any equal vectors. A row without an id has a
component too and is never kept. Extra columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.llm.cells import divide, division
from stratamart.llm.common import materialise
from stratamart.llm.components import Forest, connected_components
from stratamart.llm.vectors import KEY, matrix, spherical_kmeans, unit, usable, vector_key

THRESHOLD = 0.98
MAX_SAMPLE = 20_000
#: Cells of the first division, which is fitted on one sample; larger cells are divided further.
FIRST_CELLS = 1_024
#: Vectors of one label for each cell, and of one block.
CELL_ROWS = 4_096
BLOCK = 2_048

_HOME, _VISIT = 0, 1
#: A cell with this many times ``cell_rows`` members is divided, if they go to few parts each.
_CROWDED, _FEW_PARTS = 4, 4
_GROUP = ["label", "size", "cell"]
_CELLED = "label int, size int, node long, copies long, cell string, role int, vector array<float>"
_FOUND = "a long, b long, links long"
_FOUND_ARROW = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64())])


def _assign(shared, reach: float):
    """Home and visits of every vector: cells of its size by nearest centre."""
    names = ["label", "size", "node", "copies", "cell", "role", "vector"]

    def run(batches):
        centres_of, spans_of = shared.value
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes).tolist():
                rows = batch.filter(pa.array(sizes == size))
                for start in range(0, rows.num_rows, 2_048):
                    part = rows.slice(start, 2_048)
                    near = unit(matrix(part.column("vector"), size)) @ centres_of[size].T
                    home = near.argmax(1)
                    best = near[np.arange(len(near)), home]
                    goes = best[:, None] - near <= reach * spans_of[size][home] + 1e-9
                    goes &= np.arange(near.shape[1])[None, :] > home[:, None]
                    goes[np.arange(len(near)), home] = True
                    row, cell = np.nonzero(goes)
                    out = part.take(pa.array(row))
                    role = np.where(cell == home[row], _HOME, _VISIT).astype(np.int32)
                    columns = [out.column(c) for c in ("label", "size", "node", "copies")]
                    columns += [pa.array(cell).cast(pa.string()), pa.array(role), out.column("vector")]
                    yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _parts(reach: float, near: np.ndarray, centres: np.ndarray, member: np.ndarray) -> np.ndarray:
    """Whether each row goes to each part: members to their own and to later ones, visitors to all, within reach."""
    home = near.argmax(1)
    best = near[np.arange(len(near)), home]
    spans = np.sqrt(np.maximum(2 - 2 * centres @ centres.T, 0))
    goes = best[:, None] - near <= reach * spans[home] + 1e-9
    goes &= (np.arange(near.shape[1])[None, :] > home[:, None]) | ~member[:, None]
    goes[np.arange(len(near)), home] = True
    return goes


def _divides(reach: float):
    """Whether parts tell vectors apart: members go to few of them on average."""

    def check(units: np.ndarray, centres: np.ndarray) -> bool:
        goes = _parts(reach, units @ centres.T, centres, np.ones(len(units), bool))
        return goes.sum() <= min(_FEW_PARTS, len(centres) / 2) * len(units)

    return check


def _assign_parts(reach: float):
    def run(rows: pa.Table, centres: np.ndarray) -> pa.Table:
        near = unit(matrix(rows.column("vector"), centres.shape[1])) @ centres.T
        member = rows.column("role").to_numpy() == _HOME
        row, part = np.nonzero(_parts(reach, near, centres, member))
        out = rows.take(pa.array(row))
        home = member[row] & (part == near.argmax(1)[row])
        cells = [f"{cell}/{p}" for cell, p in zip(out.column("cell").to_pylist(), part.tolist(), strict=True)]
        columns = [out.column(c) for c in ("label", "size", "node", "copies")]
        columns += [pa.array(cells, pa.string()), pa.array(np.where(home, _HOME, _VISIT).astype(np.int32)), out.column("vector")]
        return pa.table(columns, ["label", "size", "node", "copies", "cell", "role", "vector"])

    return run


def _divided(celled: DataFrame, cell_rows: int, reach: float) -> DataFrame:
    """The rows in cells that are not crowded, or cannot be divided."""
    done = []
    while True:
        homes = celled.where(F.col("role") == _HOME)
        centres = division(homes, _GROUP, "node", _CROWDED * cell_rows, cell_rows, _divides(reach))
        if centres is None:
            return reduce(DataFrame.unionByName, [*done, celled])
        stay, parts = divide(celled, centres, _GROUP, "node", _assign_parts(reach), _CELLED)
        done.append(materialise(stay, "cells"))
        celled = materialise(parts, "cells")


def _compare(threshold: float):
    """Links between the two sides of one pair of blocks; a block met with itself counts each pair once."""

    def run(table: pa.Table) -> pa.Table:
        size = table.column("size")[0].as_py()
        side = table.column("side").to_numpy()
        units = unit(matrix(table.column("vector"), size))
        nodes, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        linked = units[left] @ units[right].T >= threshold
        linked &= nodes[left][:, None] != nodes[right][None, :]
        a, b = np.nonzero(linked)
        a, b = left[a], right[b]
        links = np.zeros(len(nodes), np.int64)
        np.add.at(links, a, copies[b])
        if (side != 2).any():  # two different blocks: the other side counts too
            np.add.at(links, b, copies[a])
        forest = Forest(len(nodes))
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            forest.join(x, y)
        roots = np.array([forest.root(i) for i in range(len(nodes))], int)
        counted, tied = np.flatnonzero(links), np.flatnonzero(roots != np.arange(len(nodes)))
        return pa.table(
            [
                pa.array(np.r_[nodes[counted], nodes[tied]], pa.int64()),
                pa.concat_arrays([pa.nulls(len(counted), pa.int64()), pa.array(nodes[roots[tied]], pa.int64())]),
                pa.array(np.r_[links[counted], np.zeros(len(tied), np.int64)], pa.int64()),
            ],
            schema=_FOUND_ARROW,
        )

    return run


def _block_pairs(celled: DataFrame, block: int) -> DataFrame:
    """Rows repeated for every pair of blocks they take part in. side: 0 left, 1 right, 2 both."""
    group = _GROUP
    counts = celled.groupBy(*group).agg(
        F.count_if(F.col("role") == _HOME).alias("homes"), F.count_if(F.col("role") == _VISIT).alias("visits")
    )
    blocks = counts.select(
        *group,
        F.ceil(F.col("homes") / block).cast("int").alias("homes"),
        F.ceil(F.col("visits") / block).cast("int").alias("visits"),
    ).where("homes > 0")
    rows = celled.join(blocks, group)
    own = F.pmod(F.xxhash64("node"), F.when(F.col("role") == _HOME, F.col("homes")).otherwise(F.col("visits")))
    rows = rows.withColumn("own", own.cast("int"))
    # kind 0: home with home (left <= right); kind 1: visitors on the left, homes on the right
    pairs = F.expr(
        f"""if(role = {_VISIT},
            transform(sequence(0, homes - 1), h -> struct(1 as kind, own as i, h as j, 0 as side)),
            concat(
              transform(sequence(0, homes - 1), h -> struct(
                0 as kind, least(own, h) as i, greatest(own, h) as j,
                case when h = own then 2 when own < h then 0 else 1 end as side)),
              if(visits > 0, transform(sequence(0, visits - 1), v -> struct(1 as kind, v as i, own as j, 1 as side)),
                 array())))"""
    )
    return rows.select(*group, "node", "copies", "vector", F.explode(pairs).alias("pair")).select(
        *group, "node", "copies", "vector", "pair.*"
    )


def near_duplicate_vectors(
    embeddings: DataFrame,
    threshold: float = THRESHOLD,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    cell_rows: int = CELL_ROWS,
    block: int = BLOCK,
    max_sample: int = MAX_SAMPLE,
) -> DataFrame:
    """vec_id, n_links (rows linked directly), component_id (least id reachable) and kept, for every row."""
    spark = embeddings.sparkSession
    rows = embeddings.select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(label_column).cast("int").alias("label"),
        F.col(vector_column).cast("array<float>").alias("vector"),
    ).withColumn("usable", F.col("label").isNotNull() & usable("vector"))
    rows = rows.select("*", *vector_key("vector"))
    compared = rows.where("usable").select("vec_id", "label", F.size("vector").alias("size"), *KEY, "vector")
    nodes = compared.groupBy("label", "size", *KEY).agg(
        F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("vector").alias("vector")
    )
    # The numbers hold once they are stored: what is read later is what one attempt of each task wrote.
    nodes = materialise(nodes.withColumn("node", F.monotonically_increasing_id()), "vectors")
    sizes = nodes.groupBy("size", "label").agg(F.count("*").alias("n")).groupBy("size").agg(F.max("n").alias("n"))
    largest = {r["size"]: r["n"] for r in sizes.collect()}  # as many rows as there are vector lengths
    centres, spans = {}, {}
    for size, n in largest.items():
        picked = nodes.where(F.col("size") == size).select("vector", *KEY).orderBy(*KEY).limit(max_sample)
        sample = unit(matrix(picked.select("vector").toArrow().column("vector"), size))
        found = spherical_kmeans(sample, min(-(-n // cell_rows), FIRST_CELLS, max(1, len(sample) // 8)))
        centres[size] = found
        spans[size] = np.sqrt(np.maximum(2 - 2 * found @ found.T, 0))
    shared = spark.sparkContext.broadcast((centres, spans))
    reach = float(np.sqrt(2 - 2 * threshold))
    celled = nodes.select("label", "size", "node", "copies", "vector").mapInArrow(_assign(shared, reach), _CELLED)
    pairs = _block_pairs(_divided(materialise(celled, "cells"), cell_rows, reach), block)
    found = pairs.groupBy("label", "size", "cell", "kind", "i", "j").applyInArrow(_compare(threshold), _FOUND)
    found = materialise(found, "vector-links")
    roots = connected_components(found.where("b is not null").select("a", "b"))
    links = found.where("b is null").groupBy("a").agg(F.sum("links").alias("links"))
    named = (
        nodes.select("label", *KEY, "node", "least", "copies")
        .join(links, F.col("node") == links["a"], "left")
        .drop("a")
        .join(roots.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left")
        .select(
            "label",
            *KEY,
            "least",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
            F.coalesce("root", "node").alias("root"),
        )
    )
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = rows.where("usable").select("vec_id", "label", *KEY).join(
        named.join(ids, "root").select("label", *KEY, "n_links", "component_id"), ["label", *KEY]
    )
    alone = rows.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    every = linked.select("vec_id", "n_links", "component_id").unionByName(alone)
    return every.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
