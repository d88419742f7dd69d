"""The two scorers: held-out accuracy, labels they must not see, and odd rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratamart.llm import quality, toxicity
from stratamart.llm.common import table
from stratamart.llm.queries import op6_quality, op7_toxicity

FOLDER = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def labels(spark):
    return {r.doc_id: r for r in table(spark, FOLDER, "labels").collect()}


def test_toxicity_on_held_out_labels(spark, labels):
    rows = op7_toxicity(spark, FOLDER).collect()
    assert len(rows) == table(spark, FOLDER, "documents").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
        assert r.predicted == (r.score >= 0.5)
    known = [(r.predicted, labels[r.doc_id].toxic) for r in rows if r.held_out and r.doc_id in labels]
    right = np.mean([p == t for p, t in known])
    clean = [p for p, t in known if t == 0]
    found = [p for p, t in known if t == 1]
    assert right >= 0.96
    assert np.mean(clean) <= 0.02
    assert np.mean(found) >= 0.75  # about one label in ten is of a text without a toxic word


def test_toxicity_ignores_held_out_labels(spark):
    docs, given = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    turned = given.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    first, second = toxicity.train(docs, given), toxicity.train(docs, turned)
    assert np.array_equal(first.weights, second.weights)
    assert first.offset == second.offset


def test_misspellings_share_n_grams(spark):
    docs = table(spark, FOLDER, "documents")
    score = toxicity.train(docs, table(spark, FOLDER, "labels")).scorer()
    misspelt = "idiiot stupidd disgustng worthles loserr idot stupiid pathetick morron trassh".split()
    clean = score("the and of tion")
    assert clean < 0.1
    scores = [score(f"the and {word} of") for word in misspelt]
    assert np.mean([s > clean for s in scores]) == 1
    assert np.mean([s >= 0.5 for s in scores]) >= 0.7


def test_quality_against_labels(spark, labels):
    rows = {r.doc_id: r for r in op6_quality(spark, FOLDER).collect()}
    assert len(rows) == table(spark, FOLDER, "documents").count()
    good = [rows[d].kept for d, r in labels.items() if r.quality == 1]
    bad = [rows[d].kept for d, r in labels.items() if r.quality == 0]
    assert np.mean(good) >= 0.995
    assert np.mean(bad) <= 0.08


def test_label_model_finds_accuracies():
    """Votes drawn with known accuracies; the best and the worst labeller are told apart without labels."""
    rng = np.random.default_rng(1)
    truth = rng.random(20_000) < 0.8
    miss, false = np.array([0.1, 0.3, 0.5, 0.6]), np.array([0.01, 0.05, 0.02, 0.1])
    says_bad = np.where(truth[:, None], rng.random((20_000, 4)) < false, rng.random((20_000, 4)) > miss)
    votes = np.where(rng.random((20_000, 4)) < 0.1, quality.ABSTAIN, np.where(says_bad, quality.BAD, quality.GOOD))
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality.fit_label_model(patterns, counts)
    assert abs(model.prior - 0.8) < 0.03
    assert np.abs(model.chances[:, quality.BAD, 2] - miss).max() < 0.06
    assert np.abs(model.chances[:, quality.GOOD, 1] - false).max() < 0.03


def test_votes_are_weighed_as_by_plain_expectation_maximisation():
    """Document by document and number by number, without patterns, arrays or logarithms."""
    rng = np.random.default_rng(5)
    docs = [[int(v) for v in rng.choice([quality.ABSTAIN, quality.BAD, quality.GOOD], 4, p=[0.3, 0.2, 0.5])] for _ in range(300)]
    prior, bad_calls = 0.8, [[0.5, 0.02] for _ in range(4)]  # the chance of the vote bad, for bad and good texts

    def good_chance(row):
        good, bad = prior, 1 - prior
        for vote, (of_bad, of_good) in zip(row, bad_calls, strict=True):
            if vote != quality.ABSTAIN:
                good *= of_good if vote == quality.BAD else 1 - of_good
                bad *= of_bad if vote == quality.BAD else 1 - of_bad
        return good / (good + bad)

    for _ in range(200):
        chances = [good_chance(row) for row in docs]
        updated = []
        for j in range(4):
            shares = []
            for weights, start in ((([1 - c for c in chances]), 0.5), (chances, 0.02)):
                cast = sum(w for w, row in zip(weights, docs, strict=True) if row[j] != quality.ABSTAIN)
                called = sum(w for w, row in zip(weights, docs, strict=True) if row[j] == quality.BAD)
                shares.append((called + 4 * start) / (cast + 4))
            updated.append([shares[0], min(shares[1], shares[0])])
        prior_before, prior = prior, min(max(sum(chances) / len(docs), 0.02), 0.98)
        moved = max(abs(prior - prior_before), *[abs(a - b) for x, y in zip(updated, bad_calls, strict=True) for a, b in zip(x, y, strict=True)])
        bad_calls = updated
        if moved < 1e-7:
            break
    patterns, counts = np.unique(np.array(docs), axis=0, return_counts=True)
    model = quality.fit_label_model(patterns, counts.astype(float))
    assert model.prior == pytest.approx(prior, abs=1e-6)
    assert model.posterior(np.array(docs)) == pytest.approx(np.array([good_chance(row) for row in docs]), abs=1e-5)


def _plain_grams(word):
    raw = b"<" + word.encode() + b">"
    grams = [raw[i : i + n] for n in (3, 4, 5, 6) for i in range(len(raw)) if i + n <= len(raw)]
    return [zlib.crc32(g) % toxicity.BUCKETS for g in [*grams, raw]]


def test_scores_are_those_of_plain_sums(spark):
    """Both scorers, recomputed word by word from their weights."""
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    model = toxicity.train(docs, table(spark, "/root/testdata/sf0.001", "labels"))
    for r in toxicity.score(docs, model).collect():
        words, total = texts[r.doc_id].lower().split(), 0.0
        for word in words:
            bare = word.strip(toxicity._EDGES)
            if bare:
                grams = _plain_grams(bare)
                total += sum(float(model.weights[g]) for g in grams) / len(grams)
        logit = model.offset + total / (len(words) + toxicity.NEUTRAL_WORDS)
        assert r.score == pytest.approx(1 / (1 + np.exp(-logit)), abs=1e-9)
    learnt = quality.train(docs)
    for r in quality.score(docs, learnt).collect():
        hashed = quality.features(texts[r.doc_id])
        logit = learnt.offset + sum(float(learnt.weights[b]) * w for b, w in hashed.items())
        assert r.score == pytest.approx(1 / (1 + np.exp(-logit)) if hashed else 0.0, abs=1e-9)


def test_long_odd_texts_send_few_bytes_to_the_fit(spark):
    """Long random texts among the labelled ones: only telling n-grams of them reach the driver."""
    rng = np.random.default_rng(2)
    wild = [" ".join("".join(chr(97 + c) for c in rng.integers(0, 26, 8)) for _ in range(5_000)) for _ in range(8)]
    rows = [(i, f"a calm text of words {i}" if i % 2 else f"you horrible idiot {i}", i % 2) for i in range(60)]
    rows += [(100 + i, text, 1) for i, text in enumerate(wild)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    given = spark.createDataFrame([(i, 1 - clean) for i, _, clean in rows], "doc_id long, toxic int")
    kept = []
    fit = toxicity.fit
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(toxicity, "fit", lambda bags, *rest: kept.extend(len(ids) for ids, _ in bags) or fit(bags, *rest))
        score = toxicity.train(docs, given).scorer()
    assert max(kept) < 100 and len(kept) > 40
    assert score("what an idiot, horrible") > 0.5 > score("a calm text of other words")


def test_odd_rows(spark, make_docs, odd_texts):
    docs = make_docs(odd_texts)
    ids = sorted((d for d, _ in odd_texts), key=repr)
    given = spark.createDataFrame(
        [(4, 1, 1), (4, 1, 0), (5, 1, None), (None, 0, 1), (6, None, 0), (7, 1, 0), (8, 1, 7)], "doc_id long, quality int, toxic int"
    )
    scored = toxicity.score(docs, toxicity.train(docs, given)).collect()
    assert sorted((r.doc_id for r in scored), key=repr) == ids
    assert all(0 <= r.score <= 1 for r in scored)
    kept = quality.score(docs, quality.train(docs)).collect()
    assert sorted((r.doc_id for r in kept), key=repr) == ids
    assert {r.doc_id: r.score for r in kept}[1] == {r.doc_id: r.score for r in kept}[3] == 0
    for empty in (make_docs([]), docs.limit(0)):
        assert toxicity.score(empty, toxicity.train(empty, given.limit(0))).count() == 0
        assert quality.score(empty, quality.train(empty)).count() == 0
    without = toxicity.train(docs, given.limit(0))
    assert [r.score for r in toxicity.score(docs, without).collect()] == pytest.approx([0.5 / 10] * len(odd_texts))
