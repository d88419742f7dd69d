"""Approximate nearest neighbours: a hierarchical k-means tree with best-bin-first traversal.

The upper tree is fitted on a bounded sample. Every row goes down to one leaf of it, and leaves that hold too
many rows are divided further on the executors, as often as it takes (see ``cells``): leaves grow in number
with the table, not in size. A query walks the upper tree with a priority queue, best centre first. Leaves
that it reaches and that were divided are opened, and of all it has open it goes on with the best. How many it
visits at each level is calibrated: for a bounded set of distinct queries the exact neighbours over *all* rows
are found in blocks, copies of the query left out, and visits widen until the leaves visited hold enough of them.

Leaves meet the queries that visit them in blocks of bounded size. Of equal vectors only those with the
``k + 1`` smallest ids can be among the results of any query, so the others need not be compared.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take no part, nor
do rows without an id. Vectors of each length have an index of their own; a query finds vectors of its length.
Rows repeated with the same id and vector are one. A query id with several vectors of one length asks with the
one of the least key; all of them are candidates for others. A query never finds its own id. Ties go to the
smaller id. Extra columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratamart.llm.cells import divide, division, sent
from stratamart.llm.common import materialise
from stratamart.llm.vectors import KEY, matrix, spherical_kmeans, unit, usable, vector_key

NEIGHBOURS = 5
TARGET_RECALL = 0.96
MAX_SAMPLE = 20_000
CALIBRATION_QUERIES = 100
BRANCHES = 8
#: A node is split while it stands for more rows than this; leaves of the upper tree with _CROWDED times as many
#: rows are divided.
LEAF_ROWS = 1_024
_CROWDED = 4
_LEAF_SAMPLE = 24
BLOCK = 16_384
_QUERIES_AT_ONCE = 256
_SLACK = 1e-9

_HITS = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
_HITS_DDL = "query_id long, vec_id long, score double"


@dataclass
class Tree:
    """Nodes in arrays: centres, the children of each, and the leaf number of each (-1 inside)."""

    centres: np.ndarray
    children: list[np.ndarray]
    leaf: np.ndarray

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def assign(self, units: np.ndarray) -> np.ndarray:
        """The leaf of each row, going down to the nearest child."""
        out = np.empty(len(units), np.int32)
        waiting = [(0, np.arange(len(units)))]
        while waiting:
            node, rows = waiting.pop()
            below = self.children[node]
            if not len(below):
                out[rows] = self.leaf[node]
                continue
            pick = (units[rows] @ self.centres[below].T).argmax(1)
            waiting += [(int(child), rows[pick == i]) for i, child in enumerate(below) if (pick == i).any()]
        return out

    def order(self, query: np.ndarray, visits: int) -> list[int]:
        """Best bin first: the leaves in the order in which a priority queue over centres reaches them."""
        near = (-(self.centres @ query)).tolist()
        queue, out = [(near[0], 0)], []
        while queue and len(out) < visits:
            _, node = heapq.heappop(queue)
            if self.leaf[node] >= 0:
                out.append(int(self.leaf[node]))
            for child in self.children[node].tolist():
                heapq.heappush(queue, (near[child], child))
        return out


def fit_tree(units: np.ndarray, n_rows: int, branches: int = BRANCHES, leaf_rows: int = LEAF_ROWS) -> Tree:
    """Split nodes by k-means while they stand for more than ``leaf_rows`` rows and the sample allows it."""
    centres, children, leaf = [units.mean(0)], [np.empty(0, int)], [-1]
    waiting, leaves = [(0, np.arange(len(units)))], 0
    while waiting:
        node, rows = waiting.pop()
        size = len(rows) * n_rows / max(1, len(units))
        if size > leaf_rows and len(rows) >= 2 * _LEAF_SAMPLE:
            found = spherical_kmeans(units[rows], min(branches, len(rows) // _LEAF_SAMPLE), seed=node)
            owner = (units[rows] @ found.T).argmax(1)
            used = np.unique(owner)
            if len(used) > 1:
                first = len(centres)
                children[node] = np.arange(first, first + len(used))
                for i, cell in enumerate(used.tolist()):
                    centres.append(found[cell])
                    children.append(np.empty(0, int))
                    leaf.append(-1)
                    waiting.append((first + i, rows[owner == cell]))
                continue
        leaf[node], leaves = leaves, leaves + 1
    return Tree(np.array(centres), children, np.array(leaf))


def _top(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def _cosines(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The measure itself on original vectors, the same for equal vectors wherever they stand."""
    return (rows * query).sum(1) / (np.sqrt((query * query).sum()) * np.sqrt((rows * rows).sum(1)))


def _best(query_ids, queries, ids, rows, k: int, twins=None) -> Iterator[tuple[int, int, float, int]]:
    """(query id, id, score, row) of the k best of each query; a product finds them, the measure ranks them.

    ``twins`` tells of a query which rows are copies of it and not looked for.
    """
    row_units, near = unit(rows).T, None
    for q, query in enumerate(queries):
        if q % _QUERIES_AT_ONCE == 0:
            near = unit(queries[q : q + _QUERIES_AT_ONCE]) @ row_units
        own = ids == query_ids[q] if twins is None else (ids == query_ids[q]) | twins(q)
        scores = np.where(own, -np.inf, near[q % _QUERIES_AT_ONCE])
        last = np.partition(scores, -k)[-k] if len(scores) > k else -np.inf
        picked = np.flatnonzero((scores >= last - _SLACK) & (scores > -np.inf))
        exact = _cosines(query, rows[picked])
        for i in _top(ids[picked], exact, k).tolist():
            yield int(query_ids[q]), int(ids[picked[i]]), float(exact[i]), int(picked[i])


def _exact(shared, size: int, k: int):
    """The k best of each calibration query within every batch, with their leaves; copies of it left out."""
    names = ["query_id", "vec_id", "score", "leaf"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, keys, queries = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, ids = matrix(batch.column("vector"), size), batch.column("vec_id").to_numpy()
            own = [batch.column(c).to_numpy() for c in KEY]
            twins = lambda q: (own[0] == keys[0][q]) & (own[1] == keys[1][q])  # noqa: B023, E731
            hits = list(_best(query_ids, queries, ids, rows, k, twins))
            leaves = batch.column("leaf").take(pa.array([r for _, _, _, r in hits], pa.int64()))
            columns = list(zip(*hits, strict=True))[:3] or [()] * 3
            kinds = (pa.int64(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays([*[pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], leaves], names)

    return run


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


_HELD = "leaf string, vec_id long, key1 long, key2 long, vector array<float>"
_OPEN = "leaf string, vec_id long, near double, vector array<float>"


def _assigned(shared, size: int):
    names = ["leaf", "vec_id", *KEY, "vector"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves = shared.value.assign(unit(matrix(batch.column("vector"), size))) if batch.num_rows else []
            named = pa.array(leaves, pa.int32()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([named, *[batch.column(c) for c in names[1:]]], names)

    return run


def _visiting(shared, size: int, visits: int):
    names = ["leaf", "vec_id", "near", "vector"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = shared.value
        centres = {int(leaf): tree.centres[node] for node, leaf in enumerate(tree.leaf) if leaf >= 0}
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                units = unit(matrix(part.column("vector"), size))
                orders = [tree.order(u, visits) for u in units]
                near = [float(u @ centres[leaf]) for u, order in zip(units, orders, strict=True) for leaf in order]
                out = part.take(pa.array(np.repeat(np.arange(len(orders)), [len(o) for o in orders])))
                leaves = pa.array([str(leaf) for o in orders for leaf in o], pa.string())
                yield pa.RecordBatch.from_arrays([leaves, out.column("vec_id"), pa.array(near), out.column("vector")], names)

    return run


def _to_parts(rows: pa.Table, centres: np.ndarray) -> pa.Table:
    """Rows of the index: each to the part of its nearest centre."""
    part = (unit(matrix(rows.column("vector"), centres.shape[1])) @ centres.T).argmax(1)
    leaves = [f"{leaf}/{p}" for leaf, p in zip(rows.column("leaf").to_pylist(), part.tolist(), strict=True)]
    return pa.table([pa.array(leaves, pa.string()), *[rows.column(c) for c in ("vec_id", *KEY, "vector")]], ["leaf", "vec_id", *KEY, "vector"])


def _open_parts(rows: pa.Table, centres: np.ndarray) -> pa.Table:
    """Rows of queries: each to all parts, with how near their centres are."""
    near = unit(matrix(rows.column("vector"), centres.shape[1])) @ centres.T
    out = rows.take(pa.array(np.repeat(np.arange(len(near)), len(centres))))
    parts = list(range(len(centres))) * len(near)
    leaves = [f"{leaf}/{p}" for leaf, p in zip(out.column("leaf").to_pylist(), parts, strict=True)]
    return pa.table([pa.array(leaves, pa.string()), out.column("vec_id"), pa.array(near.ravel()), out.column("vector")], ["leaf", "vec_id", "near", "vector"])


@dataclass
class Index:
    """Rows with their leaves, the upper tree, the centres of every level below it, and visits by level."""

    held: DataFrame
    size: int
    tree: Tree
    shared: object
    levels: list[DataFrame]
    visits: list[int]

    def opened(self, queries: DataFrame, levels: int, visits: list[int]) -> DataFrame:
        """Leaves (down to some level) that each query has open, with how near they are; cut as ``visits`` tells."""
        first = visits[0] if visits else self.tree.leaves
        frontier = queries.select("vec_id", "vector").mapInArrow(_visiting(self.shared, self.size, first), _OPEN)
        for level, centres in enumerate(self.levels[:levels], 1):
            stay, parts = divide(materialise(frontier, "open"), centres, ["leaf"], "vec_id", _open_parts, _OPEN)
            frontier = stay.unionByName(parts)
            if level < len(visits):
                frontier = _nearest_leaves(frontier).where(F.col("place") <= visits[level]).drop("place")
        return frontier

    def visited(self, queries: DataFrame) -> DataFrame:
        return self.opened(queries, len(self.levels), self.visits)


def _nearest_leaves(frontier: DataFrame) -> DataFrame:
    best = Window.partitionBy("vec_id").orderBy(F.desc("near"), "leaf")
    return frontier.withColumn("place", F.row_number().over(best))


def build(
    index: DataFrame, size: int, leaf_rows: int = LEAF_ROWS, max_sample: int = MAX_SAMPLE
) -> Index:
    """The tree of all rows (vec_id, keys, vector): fitted on a sample above, on the rows of each leaf below."""
    n_rows = index.count()
    sample = index.select("vector", *KEY, "vec_id").orderBy(*KEY, "vec_id").limit(max_sample).select("vector").toArrow()
    tree = fit_tree(unit(matrix(sample.column("vector"), size)), n_rows, leaf_rows=leaf_rows)
    shared = index.sparkSession.sparkContext.broadcast(tree)  # bounded by the sample
    held = materialise(index.select("vec_id", *KEY, "vector").mapInArrow(_assigned(shared, size), _HELD), "leaves")
    done, levels = [], []
    while True:
        centres = division(held, ["leaf"], "key1", _CROWDED * leaf_rows, leaf_rows)
        if centres is None:
            return Index(reduce(DataFrame.unionByName, [*done, held]), size, tree, shared, levels, [])
        stay, parts = divide(held, centres, ["leaf"], "key1", _to_parts, _HELD)
        done.append(materialise(stay, "leaves"))
        held = materialise(parts, "leaves")
        levels.append(centres)


def calibrate(
    index: Index, queries: DataFrame, k: int = NEIGHBOURS, target: float = TARGET_RECALL, n_queries: int = CALIBRATION_QUERIES
) -> list[int]:
    """How many leaves a query must go on with at each level for the target recall over exact search of all rows."""
    chosen = queries.select("vec_id", "vector", *KEY).dropDuplicates(KEY).orderBy(*KEY, "vec_id").limit(n_queries)
    sample = chosen.toArrow()
    query_ids, vectors = sample.column("vec_id").to_numpy(), matrix(sample.column("vector"), index.size)
    asked = index.held.sparkSession.sparkContext.broadcast((query_ids, [sample.column(c).to_numpy() for c in KEY], vectors))
    hits = index.held.mapInArrow(_exact(asked, index.size, k), "query_id long, vec_id long, score double, leaf string")
    found = _ranked(hits, k).collect()  # at most n_queries * k rows
    everything = [index.tree.leaves, *[2**31 - 1] * len(index.levels)]
    if not found:
        return everything
    loss = (1 - target) / len(everything)
    units = dict(zip(query_ids.tolist(), unit(vectors), strict=True))
    place = {q: {str(leaf): i for i, leaf in enumerate(index.tree.order(u, index.tree.leaves), 1)} for q, u in units.items()}
    visits = [_enough([place[r["query_id"]][r["leaf"].split("/")[0]] for r in found], loss, everything[0])]
    chosen = materialise(chosen, "calibration")
    for level in range(1, len(everything)):
        opened = _nearest_leaves(index.opened(chosen, level, visits)).select("vec_id", "leaf", "place")
        reached = {(r["query_id"], "/".join(r["leaf"].split("/")[: level + 1])) for r in found}
        wanted = index.held.sparkSession.createDataFrame(sorted(reached), "vec_id long, leaf string")
        places = {(r["vec_id"], r["leaf"]): r["place"] for r in opened.join(F.broadcast(wanted), ["vec_id", "leaf"]).collect()}
        needed = [places.get((r["query_id"], "/".join(r["leaf"].split("/")[: level + 1]))) for r in found]
        visits.append(_enough([n for n in needed if n is not None], loss, everything[level]))
    return visits


def _enough(needed: list[int], loss: float, most: int) -> int:
    """The least number of visits that reaches all but a share of what is needed; all of them if none may be lost."""
    if loss < 0 or not needed:
        return most
    ordered = sorted(needed)
    return ordered[min(len(ordered) - 1, max(0, math.ceil((1 - loss) * len(ordered)) - 1))]


def _search(size: int, k: int):
    def run(table: pa.Table) -> pa.Table:
        asked = table.column("asks").to_numpy()
        ids, vectors = table.column("vec_id").to_numpy(), matrix(table.column("vector"), size)
        hits = []
        if asked.any() and not asked.all():
            hits = [h[:3] for h in _best(ids[asked], vectors[asked], ids[~asked], vectors[~asked], k)]
        columns = list(zip(*hits, strict=True)) or [()] * 3
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, _HITS, strict=True)], schema=_HITS)

    return run


def nearest(
    embeddings: DataFrame,
    asks: Column,
    k: int = NEIGHBOURS,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    target: float = TARGET_RECALL,
    leaf_rows: int = LEAF_ROWS,
    max_sample: int = MAX_SAMPLE,
    block: int = BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest of every row for which ``asks`` (of vec_id) holds."""
    spark = embeddings.sparkSession
    rows = embeddings.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<float>").alias("vector")
    ).where(F.col("vec_id").isNotNull() & usable("vector"))
    rows = rows.select("vec_id", "vector", F.size("vector").alias("size"), *vector_key("vector"))
    lengths = sorted(r["size"] for r in rows.where(asks).select("size").distinct().collect())
    found = [
        _nearest_of(rows.where(F.col("size") == size).drop("size"), asks, size, k, target, leaf_rows, max_sample, block)
        for size in lengths
    ]
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return _ranked(reduce(DataFrame.unionByName, found), k).select("query_id", "rank", "vec_id", "score")


def _nearest_of(
    rows: DataFrame, asks: Column, size: int, k: int, target: float, leaf_rows: int, max_sample: int, block: int
) -> DataFrame:
    """Hits among vectors of one length."""
    rows = rows.dropDuplicates(["vec_id", *KEY])
    copies = Window.partitionBy(*KEY).orderBy("vec_id")
    first_key = Window.partitionBy("vec_id").orderBy(*KEY)
    kept = rows.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1).drop("copy")
    queries = rows.where(asks).withColumn("copy", F.row_number().over(first_key)).where("copy = 1").drop("copy")
    queries = materialise(queries, "queries")
    index = build(materialise(kept, "index"), size, leaf_rows, max_sample)
    index.visits = calibrate(index, queries, k, target)
    asking = materialise(index.visited(queries).select("leaf", "vec_id", "vector"), "visits")
    held = index.held
    blocks = held.groupBy("leaf").agg(F.ceil(F.count("*") / block).cast("int").alias("row_blocks"))
    asked = asking.groupBy("leaf").agg(F.ceil(F.count("*") / block).cast("int").alias("query_blocks"))
    blocks = sent(materialise(blocks.join(asked, "leaf"), "blocks"))  # one row for each leaf

    def dealt(df: DataFrame, mine: str, other: str, asks_now: bool) -> DataFrame:
        """Each row in its own block, repeated for every block of the other side."""
        own = F.pmod(F.xxhash64("vec_id"), F.col(mine)).cast("int")
        spread = df.join(blocks, "leaf").withColumn("own", own)
        spread = spread.withColumn("met", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        sides = ("met", "own") if asks_now else ("own", "met")
        return spread.select(
            "leaf", F.col(sides[0]).alias("i"), F.col(sides[1]).alias("j"), F.lit(asks_now).alias("asks"), "vec_id", "vector"
        )

    met = dealt(held, "row_blocks", "query_blocks", False).unionByName(dealt(asking, "query_blocks", "row_blocks", True))
    hits = met.groupBy("leaf", "i", "j").applyInArrow(_search(size, k), _HITS_DDL)
    return hits
