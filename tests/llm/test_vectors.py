"""Vector neighbours and near-duplicates against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratamart.llm import ann, cells, vector_dedup
from stratamart.llm.vectors import vector_key

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<float>, label int, node string, cell string, score string, key1 int, size int"


def _frame(spark, rows):
    return spark.createDataFrame([(i, v, lab, "x", "x", "x", 0, 0) for i, v, lab in rows], SCHEMA)


def _crowd(n, dim, seed, labels=3, spread=0.05):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(max(2, n // 12), dim))
    rows = []
    for i in range(n):
        v = centres[rng.integers(len(centres))] * rng.uniform(0.5, 3) + rng.normal(size=dim) * spread * rng.integers(0, 4)
        rows.append((i * 2, v.astype(np.float32).tolist(), int(rng.integers(labels))))
    return rows


ODD = [
    (901, None, 1), (902, [], 1), (903, [0.0] * 8, 1), (904, [1.0, None] + [0.0] * 6, 1), (905, [NAN] * 8, 1),
    (906, [INF] + [1.0] * 7, 1), (907, [1.0] * 8, None), (908, [1.0] * 8, 1), (908, [1.0] * 8, 1),
    (909, [2.0] * 8, 1), (910, [1.0] * 5, 1), (None, [1.0] * 8, 1), (911, [1e-30] * 8, 1), (950, [1.0] * 8, 2),
]


def _fine(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)


def _cos(a, b):
    a, b = np.array(a, np.float32).astype(float), np.array(b, np.float32).astype(float)
    a, b = a / np.abs(a).max(), b / np.abs(b).max()
    return float(a @ b / np.sqrt(a @ a) / np.sqrt(b @ b))


def _brute_links(rows, threshold=0.98):
    n = len(rows)
    owner, links = list(range(n)), [0] * n
    for i in range(n):
        for j in range(i):
            (_, v, lv), (_, w, lw) = rows[i], rows[j]
            if lv is None or lv != lw or not (_fine(v) and _fine(w)) or len(v) != len(w) or _cos(v, w) < threshold:
                continue
            links[i] += 1
            links[j] += 1
            if owner[i] != owner[j]:
                old, new = owner[i], owner[j]
                owner = [new if o == old else o for o in owner]
    least = {}
    for (i, _, _), o in zip(rows, owner, strict=True):
        if i is not None:
            least[o] = min(i, least.get(o, i))
    return sorted(
        ((i, k, least.get(o), i is not None and i == least.get(o)) for (i, _, _), k, o in zip(rows, links, owner, strict=True)),
        key=repr,
    )


@pytest.mark.parametrize(("cell_rows", "block"), [(4096, 2048), (20, 7)])
def test_near_duplicates(spark, rows, cell_rows, block):
    data = _crowd(260, 8, 1) + ODD
    data += [(2000 + i, data[3][1], data[3][2]) for i in range(30)]
    got = vector_dedup.near_duplicate_vectors(_frame(spark, data), cell_rows=cell_rows, block=block)
    assert rows(got) == _brute_links(data)


def test_isotropic_vectors_across_cell_borders(spark, rows):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(120, 6))
    data = [(i, v.astype(np.float32).tolist(), 0) for i, v in enumerate(base)]
    data += [(500 + i, (v + rng.normal(size=6) * 0.08).astype(np.float32).tolist(), 0) for i, v in enumerate(base)]
    got = vector_dedup.near_duplicate_vectors(_frame(spark, data), cell_rows=12)
    assert rows(got) == _brute_links(data)


def test_crowded_cells_are_divided(spark, rows, monkeypatch):
    """Cells far too large for the first division, one label with most rows, and a crowd too dense to divide."""
    rng = np.random.default_rng(9)
    base = rng.normal(size=(500, 6))
    data = [(i, v.astype(np.float32).tolist(), int(i % 7 == 0)) for i, v in enumerate(base)]
    data += [(2000 + i, (v + rng.normal(size=6) * 0.1).astype(np.float32).tolist(), int(i % 7 == 0)) for i, v in enumerate(base)]
    data += [(9000 + i, (np.ones(6) + rng.normal(size=6) * 0.004).astype(np.float32).tolist(), 1) for i in range(120)]
    divided = []
    find = vector_dedup.division
    monkeypatch.setattr(vector_dedup, "FIRST_CELLS", 2)
    monkeypatch.setattr(cells, "PARTS", 4)
    monkeypatch.setattr(vector_dedup, "division", lambda *a: divided.append(find(*a)) or divided[-1])
    got = vector_dedup.near_duplicate_vectors(_frame(spark, data), cell_rows=12, block=50)
    assert rows(got) == _brute_links(data)
    assert len(divided) >= 3 and divided[-1] is None  # two levels at least, until nothing is left to divide


def test_near_duplicates_of_nothing(spark):
    assert vector_dedup.near_duplicate_vectors(_frame(spark, [])).count() == 0
    assert vector_dedup.near_duplicate_vectors(_frame(spark, ODD[:3])).count() == 3


def _brute_nearest(rows, divisor, k=5):
    seen = {(i, tuple(v)) for i, v, _ in rows if i is not None and _fine(v)}
    queries = {i: v for i, v in sorted(seen) if i % divisor == 0}
    out = {}
    for q, v in queries.items():
        found = {}
        for i, w in seen:
            if i != q and len(v) == len(w):
                found[(i, w)] = _cos(v, w)
        out[q] = sorted(((-round(s, 12), i) for (i, _), s in found.items()))[:k]
    return out


def test_every_leaf_visited_is_exact(spark):
    data = _crowd(300, 8, 2) + ODD + [(3000 + i, [1.0] * 8, 1) for i in range(40)]
    got = ann.nearest(_frame(spark, data), F.col("vec_id") % 50 == 0, target=1.1, leaf_rows=20, block=16).collect()
    expected = _brute_nearest(data, 50)
    mine = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(mine.setdefault(r.query_id, [])) + 1
        mine[r.query_id].append((-round(r.score, 12), r.vec_id))
    # Vectors of one direction and several lengths differ in the last digit of a cosine: any order among them is right.
    assert {q: sorted(near) for q, near in mine.items()} == expected
    for near in mine.values():
        assert [s for s, _ in near] == sorted(s for s, _ in near)


def test_lengths_have_an_index_each(spark):
    """Three vectors in ten have another length; they ask and are found."""
    rng = np.random.default_rng(3)
    data = [(i, rng.normal(size=8 if i // 25 % 10 < 7 else 5).astype(np.float32).tolist(), 0) for i in range(0, 1500, 5)]
    got = ann.nearest(_frame(spark, data), F.col("vec_id") % 25 == 0, target=1.1, leaf_rows=20).collect()
    mine = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        mine.setdefault(r.query_id, []).append(r.vec_id)
    expected = _brute_nearest(data, 25)
    assert mine == {q: [i for _, i in near] for q, near in expected.items()}
    assert {len(dict((i, v) for i, v, _ in data)[q]) for q in expected} == {5, 8}


def _index(spark, data, leaf_rows, max_sample):
    df = _frame(spark, data).select("vec_id", F.col("embedding").alias("vector"), *vector_key("embedding"))
    return df, ann.build(df, 8, leaf_rows, max_sample)


def test_leaves_grow_in_number(spark, monkeypatch):
    """Rows that a query is compared with, on tables of one kind: they grow far slower than the table."""
    monkeypatch.setattr(cells, "PARTS", 16)
    candidates = []
    for n in (2_000, 16_000):
        rng = np.random.default_rng(n)
        centres = rng.normal(size=(n // 40, 8))
        vectors = centres[rng.integers(len(centres), size=n)] + rng.normal(size=(n, 8)) * 0.1
        data = [(i, v.astype(np.float32).tolist(), 0) for i, v in enumerate(vectors)]
        df, index = _index(spark, data, 30, 500)
        held = index.held.groupBy("leaf").agg(F.count("*").alias("n"))
        assert held.agg(F.sum("n"), F.max("n") <= 4 * 30 + 100).first() == (n, True) and index.levels
        asking = df.where("vec_id % 50 = 0")
        index.visits = ann.calibrate(index, asking)
        visited = index.visited(asking).join(held, "leaf").groupBy("vec_id").agg(F.sum("n").alias("n"))
        candidates.append(visited.agg(F.avg("n")).first()[0])
    assert candidates[1] < 3 * candidates[0] and candidates[1] < 16_000 / 10


@pytest.mark.parametrize("target", [1.1, 0.96])
def test_divided_leaves_are_searched(spark, monkeypatch, target):
    """Two levels below a small upper tree, against brute force; a crowd of copies among those who ask."""
    monkeypatch.setattr(cells, "PARTS", 6)
    rng = np.random.default_rng(12)
    data = [(i, v.astype(np.float32).tolist(), 0) for i, v in enumerate(rng.normal(size=(2500, 8)))]
    data += [(5000 + 20 * i, data[40][1], 0) for i in range(150)]
    got = ann.nearest(_frame(spark, data), F.col("vec_id") % 20 == 0, target=target, leaf_rows=12, max_sample=100).collect()
    hits = {(r.query_id, r.vec_id) for r in got}
    expected = {q: near for q, near in _brute_nearest(data, 20).items() if q < 5000}
    wanted = [(q, i) for q, near in expected.items() for _, i in near]
    assert np.mean([w in hits for w in wanted]) >= (1 if target > 1 else 0.9)


def test_equal_vectors_by_id(spark):
    data = [(i, [1.0, 2.0, 3.0], 0) for i in range(40, 0, -1)] + [(50, [3.0, 2.0, 1.5], 0), (100, [1.0, 2.0, 3.0], 0)]
    got = ann.nearest(_frame(spark, data), F.col("vec_id") % 50 == 0, leaf_rows=8, block=4).collect()
    for q in (50, 100):
        assert [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] == [1, 2, 3, 4, 5]


@pytest.mark.parametrize("seed", [5, 6])
def test_calibrated_recall(spark, seed):
    rng = np.random.default_rng(seed)
    data = [(i, v.astype(np.float32).tolist(), 0) for i, v in enumerate(rng.normal(size=(2500, 8)))]
    got = ann.nearest(_frame(spark, data), F.col("vec_id") % 20 == 0, leaf_rows=60).collect()
    expected = _brute_nearest(data, 20)
    hits = {(r.query_id, r.vec_id) for r in got}
    assert len(got) == 5 * len(expected)
    found = sum((q, i) in hits for q, near in expected.items() for _, i in near)
    assert found >= 0.9 * 5 * len(expected)


def test_nearest_of_few_and_none(spark):
    ask = F.col("vec_id") % 50 == 0
    assert ann.nearest(_frame(spark, []), ask).count() == 0
    assert ann.nearest(_frame(spark, [(50, [1.0, 2.0], 0)]), ask).count() == 0
    few = ann.nearest(_frame(spark, [(50, [1.0, 2.0], 0), (51, [1.0, 2.0], 0), (7, [2.0, 1.0], 1)]), ask).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in sorted(few, key=lambda r: r.rank)] == [(50, 1, 51), (50, 2, 7)]
