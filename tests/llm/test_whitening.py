"""Whitening against numpy and whole-number arithmetic over all rows."""

import numpy as np
import pytest

from stratamart.llm.common import importable, table
from stratamart.llm.queries import QUERIES
from stratamart.llm.whitening import by_component, deviations, exact_sums, fit, Model, whiten

DDL = "vec_id long, embedding array<float>, label int, n string, x string, size string, copies string"


@pytest.fixture
def vectors(spark):
    importable(spark)

    def made(pairs):
        return spark.createDataFrame([(i, v, 1, "n", "x", "s", "c") for i, v in pairs], DDL)

    return made


def plain(pairs, n_components=32):
    """(vec_id, deviation, whitened up to sign, explained) with the covariance of all rows."""
    kept = [(i, np.array(v, np.float32).astype(float)) for i, v in pairs if v is not None and None not in v and np.isfinite(v).all()]
    x = [[int(np.floor(64 * c)) + 1_000_000 for c in v] for _, v in kept]
    n, sums = len(x), [sum(column) for column in zip(*x, strict=True)]
    exact = [sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x]
    centred = np.array([[c - s / n for c, s in zip(row, sums, strict=True)] for row in x])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:n_components]
    white = centred @ vectors[:, order] / np.sqrt(values[order])
    return {i: (d, w) for (i, _), d, w in zip(kept, exact, white, strict=True)}, values[order] / values.sum()


def compared(rows, expected, explained):
    got = {}
    for r in rows:
        got.setdefault(r["vec_id"], {})[r["component"]] = r
    assert got.keys() == expected.keys()
    signs = None
    for i, of in got.items():
        deviation, white = expected[i]
        assert sorted(of) == list(range(1, len(explained) + 1))
        assert {r["deviation"] for r in of.values()} == {deviation} and {r["n"] for r in of.values()} == {len(expected)}
        mine = np.array([of[c]["whitened"] for c in sorted(of)])
        signs = np.sign(mine * white) if signs is None else signs
        assert np.allclose(mine * signs, white, atol=1e-7)
        assert np.allclose([of[c]["explained"] for c in sorted(of)], explained, rtol=1e-9)
        assert max(r["identity_error"] for r in of.values()) < 1e-9
    return got


def test_query_is_numpy_on_the_given_table(spark):
    folder = "/root/testdata/sf0.01"
    pairs = [(r["vec_id"], r["embedding"]) for r in table(spark, folder, "embeddings").collect()]
    compared(QUERIES["op11_whitening"](spark, folder).collect(), *plain(pairs))


def crowd(n=300, size=6, seed=1):
    rng = np.random.default_rng(seed)
    return [(i, (rng.normal(size=size) * np.arange(1, size + 1)).tolist()) for i in range(n)]


def test_copies_count_as_often_as_they_occur(vectors):
    pairs = crowd()
    hot = [(1000 + i, pairs[0][1]) for i in range(150)]
    df = vectors(pairs + hot)
    for hot_rows in (4_096, 10):  # 10: the copies are spread over 15 tasks
        compared(by_component(whiten(df, hot_rows=hot_rows)).collect(), *plain(pairs + hot))


def test_copies_can_count_once(vectors):
    pairs = crowd()
    hot = [(1000 + i, pairs[0][1]) for i in range(150)]
    once, _ = plain(pairs)
    rows = by_component(whiten(vectors(pairs + hot), by_count=False)).collect()
    of_id = {i: [r for r in rows if r["vec_id"] == i] for i in (0, 1, 1000)}
    assert {r["n"] for r in rows} == {300}
    assert of_id[1][0]["deviation"] == once[1][0]
    assert [r["whitened"] for r in of_id[0]] == [r["whitened"] for r in of_id[1000]]
    assert np.allclose(np.abs([r["whitened"] for r in sorted(of_id[1], key=lambda r: r["component"])]), np.abs(once[1][1]))


def test_odd_rows(vectors):
    good = crowd(60, 3)
    odd = [(901, None), (902, [1.0, None, 2.0]), (903, [1.0, float("nan"), 2.0]), (904, [float("inf"), 1.0, 2.0]), (905, [3e38, 1.0, 2.0])]
    rest = [(906, []), (None, good[0][1]), (0, good[0][1]), (0, good[0][1]), (907, [0.0, 0.0, 0.0]), (908, [1.0, 2.0])]
    rows = by_component(whiten(vectors(good + odd + rest))).collect()
    assert {r["vec_id"] for r in rows} == {i for i, _ in good} | {None, 907}  # a single vector of its length has no variance
    assert sum(r["vec_id"] == 0 for r in rows) == 9 and {r["n"] for r in rows} == {64}
    assert len({tuple(r[1:]) for r in rows if r["vec_id"] in (0, None)}) == 3


def test_lengths_are_fitted_apart(vectors):
    short, long = crowd(50, 2), [(1000 + i, v) for i, v in crowd(40, 5, 2)]
    rows = by_component(whiten(vectors(short + long))).collect()
    compared([r for r in rows if r["vec_id"] < 1000], *plain(short))
    compared([r for r in rows if r["vec_id"] >= 1000], *plain(long))


def test_equal_constant_and_empty(vectors):
    assert by_component(whiten(vectors([(1, [1.0, 2.0]), (2, [1.0, 2.0])]))).collect() == []
    assert by_component(whiten(vectors([]))).collect() == []
    flat = [(i, [v[0], 5.0, v[1]]) for i, v in crowd(50, 2)]
    rows = whiten(vectors(flat)).collect()
    assert {len(r["whitened"]) for r in rows} == {2}  # the constant dimension gives no component


def test_sums_and_deviations_are_exact_beyond_64_bits():
    big = 1 << 60
    x = np.array([[big, -big, 3], [big - 1, big, 4], [5, 6, 7]], np.int64)
    weights = np.array([9, 8, 7], np.int64)
    sums = [sum(int(w) * int(c) for w, c in zip(weights, column, strict=True)) for column in x.T]
    assert exact_sums(x, weights) == sums
    for n in (24, 10**12):
        model = Model(n, sums, np.zeros((0, 3)), np.zeros(0), np.zeros(0))
        expected = [sum((n * int(c) - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x]
        small = [sum((n * int(c % 1000) - s % 99) ** 2 for c, s in zip(row, sums, strict=True)) for row in x]
        near = Model(n, [s % 99 for s in sums], np.zeros((0, 3)), np.zeros(0), np.zeros(0))
        assert deviations(x, model) == expected and deviations(x % 1000, near) == small


def test_model_grows_with_dimensions_only(spark, vectors):
    from stratamart.llm.vectors import vector_key
    from stratamart.llm.whitening import distinct_vectors, whole
    from pyspark.sql import functions as F

    rows = vectors(crowd(200, 4)).select("vec_id", whole("embedding").alias("x"))
    models = fit(distinct_vectors(rows.select("vec_id", "x", *vector_key("x"))), 3)
    assert models[4].components.shape == (3, 4) and models[4].n == 200
    assert np.allclose(models[4].components @ models[4].components.T, np.eye(3))
    assert rows.select(F.min(F.array_min("x"))).first()[0] > 900_000
