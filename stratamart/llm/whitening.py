"""Whitening of vectors by a covariance that is weighted by multiplicity.

Entries become whole numbers (scaled, rounded down, shifted), so many vectors become equal. Equal ones are
one row with a count, and everything after that works on distinct vectors: their sums, their covariance as a
product of centred matrices in which each counts as often as it occurs (or once, if asked), its eigenvectors,
and the whitened vector of each. Last, the rows are joined back to what was computed once for their vector.

Sums and deviations are whole numbers and exact. Matrices are made in blocks of rows inside tasks; blocks are
added up by Spark, entry by entry, and only a matrix of the vectors' size reaches the driver. Vectors that
very many rows share are spread over several tasks when they are joined back.

Defined results: vectors that are null or hold null or non-finite entries, and those with an entry too large
for a 64-bit whole number, are left out. A row without an id keeps its result. Repeated rows give repeated
results. Vectors of each length are fitted by themselves. Components without variance cannot be whitened and
have no rows, so vectors that are all equal, single or empty have none. A deviation of more than 38 digits is
null. Extra columns are not read, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.llm.common import materialise
from stratamart.llm.vectors import KEY, vector_key

SCALE, SHIFT = 64, 1_000_000
MAX_COMPONENTS = 32
#: Rows of one vector that a task may get when results are joined back; more are spread over several.
HOT_ROWS = 4_096
#: No more vectors than this can each have more than 1 / MOST_HOT of the rows.
MOST_HOT = 10_000
#: Distinct vectors made a matrix at a time.
BLOCK = 4_096
#: Eigenvalues below this share of the largest are rounding, not variance.
_LEAST_SHARE = 1e-13
_ENTRY_LIMIT = float(1 << 62)
_DIGITS = 10**38


@dataclass(frozen=True)
class Model:
    """What whitens the vectors of one length: n fitted vectors, their sums, and the components with variance."""

    n: int
    sums: list[int]
    components: np.ndarray  # one unit eigenvector a row, by falling eigenvalue
    eigenvalues: np.ndarray
    explained: np.ndarray

    @property
    def reference(self) -> np.ndarray:
        """Whole numbers near the mean, from which distances stay small."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)

    @property
    def rest(self) -> list[int]:
        """What the sums are above n times the reference: at most n / 2 either way."""
        return [s - self.n * r for s, r in zip(self.sums, self.reference.tolist(), strict=True)]

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - sums / n, without the rounding of a mean that is large against the distances."""
        return (x - self.reference) - np.array([r / self.n for r in self.rest])


def whole(vector: str, scale: int = SCALE, shift: int = SHIFT) -> Column:
    """floor(scale * entry) + shift of every entry, as whole numbers."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * scale) + F.lit(shift).cast("long"))


def _fits(vector: str, scale: int) -> Column:
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double") * scale) < _ENTRY_LIMIT)
    return F.coalesce(F.forall(vector, finite), F.lit(False))


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """size, keys, x and copies of each distinct whole-number vector; counts are combined before the shuffle."""
    return rows.groupBy(F.size("x").alias("size"), *KEY, "x").agg(F.count(F.lit(1)).alias("copies"))


def _blocks(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The listed columns by vector length, in blocks; list columns as matrices."""
    for batch in batches:
        sizes = batch.column("size").to_numpy()
        for size in np.unique(sizes[sizes > 0]).tolist():  # an empty vector has no components
            of_size = batch.filter(pa.array(sizes == size))
            for start in range(0, of_size.num_rows, BLOCK):
                part, out = of_size.slice(start, BLOCK), []
                for name in columns:
                    column = part.column(name)
                    is_list = pa.types.is_list(column.type)
                    values = (column.flatten() if is_list else column).to_numpy(zero_copy_only=False)
                    out.append(values.reshape(part.num_rows, -1) if is_list else values)
                yield size, out


def exact_sums(x: np.ndarray, weights: np.ndarray) -> list[int]:
    """Weighted column sums, exact whatever their size."""
    bound = int(np.abs(x).max(initial=0)) * int(weights.sum())
    if bound < 1 << 62:
        return (weights @ x).tolist()
    return [sum(int(w) * int(v) for w, v in zip(weights, column, strict=True)) for column in x.T]


def _sums(by_count: bool):
    kind = pa.decimal128(38, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for size, (x, copies) in _blocks(batches, ["x", "copies"]):
            weights = copies if by_count else np.ones_like(copies)
            n, sums = int(weights.sum()), exact_sums(x, weights)
            columns = [pa.array([size] * size, pa.int32()), pa.array(range(size), pa.int32())]
            columns += [pa.array([n] * size, pa.int64()), pa.array([Decimal(s) for s in sums], kind)]
            yield pa.RecordBatch.from_arrays(columns, ["size", "i", "n", "total"])

    return run


def _products(column: str, centre, by_count: bool):
    """Upper triangle of the weighted product of rows that ``centre(size, rows)`` centres, one block at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for size, (x, copies) in _blocks(batches, [column, "copies"]):
            centred = centre(size, x)
            weights = copies.astype(np.float64) if by_count else np.ones(len(copies))
            product = (centred * weights[:, None]).T @ centred
            totals[size] = totals[size] + product if size in totals else product
        for size, total in totals.items():
            for i in range(len(total)):  # a row at a time: matrices of long vectors are large
                columns_out = [[size], [i], [total[i, i:].tolist()]]
                kinds = (pa.int32(), pa.int32(), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns_out, kinds, strict=True)], ["size", "i", "entries"]
                )

    return run


def _added(products: DataFrame, dimensions: dict[int, int]) -> dict[int, np.ndarray]:
    """The sum of all blocks' matrices by vector length: as many entries as the vectors' size squared, halved."""
    entries = products.select("size", "i", F.posexplode("entries").alias("j", "value"))
    rows = entries.groupBy("size", "i", "j").agg(F.sum("value").alias("value")).toArrow()
    out = {size: np.zeros((d, d)) for size, d in dimensions.items()}
    of, i, j, value = (rows.column(c).to_numpy() for c in ("size", "i", "j", "value"))
    for size, total in out.items():
        mine = of == size
        total[i[mine], i[mine] + j[mine]] = value[mine]
        total[i[mine] + j[mine], i[mine]] = value[mine]
    return out


def components_of(covariance: np.ndarray, n_components: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit eigenvectors as rows with their eigenvalues, largest first; the entry of greatest size is positive."""
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:n_components]
    order = order[values[order] > max(values.max(initial=0.0), 0.0) * _LEAST_SHARE]
    rows = vectors[:, order].T
    signs = np.sign(rows[np.arange(len(rows)), np.abs(rows).argmax(1)]) if len(rows) else np.ones(0)
    return rows * signs[:, None], values[order]


def fit(distinct: DataFrame, n_components: int = MAX_COMPONENTS, by_count: bool = True) -> dict[int, Model]:
    """A model for each vector length that has variance. ``by_count``: a vector counts as often as it occurs, else once."""
    spark = distinct.sparkSession
    sums = distinct.select("size", "x", "copies").mapInArrow(_sums(by_count), "size int, i int, n long, total decimal(38,0)")
    totals: dict[int, dict[int, tuple[int, int]]] = {}
    added = sums.groupBy("size", "i").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    for row in added.collect():  # one row for each dimension
        totals.setdefault(row["size"], {})[row["i"]] = (row["n"], int(row["total"]))
    bare = {
        size: Model(of[0][0], [of[i][1] for i in range(size)], np.zeros((0, size)), np.zeros(0), np.zeros(0))
        for size, of in totals.items()
    }
    shared = spark.sparkContext.broadcast(bare)
    products = distinct.select("size", "x", "copies").mapInArrow(
        _products("x", lambda size, x: shared.value[size].centred(x), by_count), "size int, i int, entries array<double>"
    )
    models = {}
    for size, total in _added(products, {size: size for size in bare}).items():
        covariance = total / bare[size].n
        rows, values = components_of(covariance, n_components)
        if len(rows):
            models[size] = Model(bare[size].n, bare[size].sums, rows, values, values / np.trace(covariance))
    return models


def deviations(x: np.ndarray, model: Model) -> list[int]:
    """Sum over dimensions of (n * x - sum)^2 for each row, exact: from whole-number moments about the reference."""
    n, reference, rest = model.n, model.reference, model.rest
    near = x - reference
    spread = int(np.abs(near).max(initial=0))
    if len(reference) * max(spread, 1) * max(spread, n) < 1 << 62:
        squares, mixed = (near * near).sum(1).tolist(), (near @ np.array(rest, np.int64)).tolist()
    else:
        wide = [[int(v) for v in row] for row in near]
        squares = [sum(v * v for v in row) for row in wide]
        mixed = [sum(v * r for v, r in zip(row, rest, strict=True)) for row in wide]
    constant = sum(r * r for r in rest)
    return [n * (n * a - 2 * b) + constant for a, b in zip(squares, mixed, strict=True)]


_WHITE_DDL = "size int, key1 long, key2 long, copies long, deviation decimal(38,0), whitened array<double>"


def _whiten(shared):
    kind = pa.decimal128(38, 0)
    names = ["size", *KEY, "copies", "deviation", "whitened"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for size, (x, key1, key2, copies) in _blocks(batches, ["x", *KEY, "copies"]):
            model = shared.value.get(size)
            if model is None:
                continue
            projected = model.centred(x) @ model.components.T / np.sqrt(model.eigenvalues)
            exact = [Decimal(d) if d < _DIGITS else None for d in deviations(x, model)]
            offsets = np.arange(0, projected.size + 1, projected.shape[1], np.int32)
            whitened = pa.ListArray.from_arrays(pa.array(offsets), pa.array(projected.ravel()))
            columns = [pa.array(np.full(len(x), size, np.int32)), pa.array(key1), pa.array(key2), pa.array(copies)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(exact, kind), whitened], names)

    return run


def identity_errors(white: DataFrame, models: dict[int, Model], by_count: bool = True) -> dict[int, float]:
    """Largest entry, by size, of the covariance of the whitened vectors less the identity, measured on all of them."""
    weight = F.col("copies") if by_count else F.lit(1)
    parts = white.select("size", (weight / 1.0).alias("weight"), F.posexplode("whitened").alias("i", "value"))
    sums = parts.groupBy("size", "i").agg((F.sum(F.col("weight") * F.col("value")) / F.sum("weight")).alias("mean"))
    found = {(r["size"], r["i"]): r["mean"] for r in sums.collect()}  # one row for each component
    means = {size: np.array([found[size, i] for i in range(len(m.components))]) for size, m in models.items()}
    shared = white.sparkSession.sparkContext.broadcast(means)
    products = white.select("size", "whitened", "copies").mapInArrow(
        _products("whitened", lambda size, x: x - shared.value[size], by_count), "size int, i int, entries array<double>"
    )
    added = _added(products, {size: len(m.components) for size, m in models.items()})
    return {size: float(np.abs(total / models[size].n - np.eye(len(total))).max()) for size, total in added.items()}


def whiten(
    embeddings: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    n_components: int = MAX_COMPONENTS,
    by_count: bool = True,
    scale: int = SCALE,
    shift: int = SHIFT,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """vec_id, size, n, deviation, whitened (one entry a component), explained and identity_error of every row left."""
    spark = embeddings.sparkSession
    rows = embeddings.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vector")
    ).where(F.col("vector").isNotNull() & _fits("vector", scale))
    rows = rows.select("vec_id", whole("vector", scale, shift).alias("x"))
    rows = rows.select("vec_id", "x", *vector_key("x"))
    distinct = materialise(distinct_vectors(rows), "distinct-vectors")
    models = fit(distinct, n_components, by_count)
    shared = spark.sparkContext.broadcast(models)  # components of the vectors' size
    white = distinct.select("size", "x", *KEY, "copies").mapInArrow(_whiten(shared), _WHITE_DDL)
    white = materialise(white, "whitened")
    errors = identity_errors(white, models, by_count)
    fitted = [
        (size, m.n, m.explained.tolist(), errors[size]) for size, m in models.items()
    ]  # a row for each vector length
    fitted = spark.createDataFrame(fitted, "size int, n long, explained array<double>, identity_error double")
    n_rows = white.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    share = max(hot_rows, -(-n_rows // MOST_HOT))
    tasks = F.ceil(F.col("copies") / share).cast("int")
    hot = F.broadcast(white.where(F.col("copies") > share).select(*KEY, tasks.alias("salts")))  # fewer than MOST_HOT rows
    keyed = rows.select("vec_id", *KEY).join(hot, KEY, "left")
    salt = F.pmod(F.xxhash64("vec_id"), F.coalesce("salts", F.lit(1))).cast("int")
    keyed = keyed.select("vec_id", *KEY, salt.alias("salt"))
    spread = white.join(F.broadcast(fitted), "size").withColumn("salt", F.explode(F.sequence(F.lit(0), tasks - 1)))
    joined = keyed.join(spread.drop("copies"), [*KEY, "salt"])
    return joined.select("vec_id", "size", "n", "deviation", "whitened", "explained", "identity_error")


def by_component(whitened: DataFrame) -> DataFrame:
    """A row for each vector and component, numbered from 1; a deviation that is no 64-bit number is null."""
    pairs = F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "of")
    deviation = F.expr("try_cast(deviation as bigint)").alias("deviation")
    rows = whitened.select("vec_id", "n", deviation, "identity_error", pairs)
    return rows.select(
        "vec_id", (F.col("place") + 1).alias("component"), "n", "deviation",
        F.col("of.whitened").alias("whitened"), F.col("of.explained").alias("explained"), "identity_error",
    )
