"""Quality: a weak-label model over heuristic labellers, and a hashed linear scorer trained on its posterior.

Each labeller looks at one property of a whole text and votes good, bad or abstains. The labellers overlap
and err; expectation-maximisation estimates their accuracies from how they agree over *all* documents,
without a labelled row. Only the counts of distinct vote patterns reach the driver, at most 3 to the power
of the number of labellers, whatever the corpus holds. The posterior of each pattern then labels a bounded
sample on which a logistic scorer over hashed word shapes and stepped properties of the text is trained. The scorer
generalises: it judges every whole text, also those on which all labellers abstain.

Defined results: NULL and empty texts have no evidence against them but no content either: score 0,
rejected. Repeated rows give repeated results. Extra columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.llm.common import one_text_per_id, row_mapper, slices, texts_of

GOOD, BAD, ABSTAIN = 1, 0, -1
FEATURES = 1 << 14
MAX_SAMPLE = 6_000
#: Texts that score less are rejected. Below one half: a few plain words are no evidence against a text.
REJECT_BELOW = 0.35
_EPOCHS = 30
_RATE = 0.05
_ENDS = re.compile(rb"[A-Za-z\x80-\xff][.!?](?:\s|$)")
_BARE = re.compile(rb"(?<!\S)[!-/:-@\[-`{-~]+(?!\S)")
_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_MARKS = np.zeros(256, bool)
_MARKS[[ord(c) for c in "#$%&*|<>{}[]\\^~=_@+/"]] = True


@dataclass
class Facts:
    """What the labellers look at, over one whole text."""

    words: int
    letters: float  # share of bytes outside white space that are letters
    marks: float  # share of those that are marks prose seldom has
    capitals: float  # share of ASCII letters that are capitals
    distinct: float  # distinct words per word, of a text as long
    same_next: float  # share of words that repeat the word before
    ends: float  # sentence ends per word
    word_bytes: float  # mean bytes of a word
    bare: float  # share of words without a letter or digit
    shouts: float  # exclamation marks per word


def facts(text: str) -> Facts:
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    if not words:
        return Facts(0, 0, 0, 0, 0, 0, 0, 0, 0, 0)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size = sum(map(len, words))
    upper, lower = counts[65:91].sum(), counts[97:123].sum()
    following = sum(map(bytes.__eq__, words, words[1:]))
    return Facts(
        words=len(words),
        letters=counts[_LETTERS].sum() / size,
        marks=counts[_MARKS].sum() / size,
        capitals=upper / max(1, upper + lower),
        distinct=len(set(words)) / len(words) ** 0.85,
        same_next=following / len(words),
        ends=len(_ENDS.findall(raw)) / len(words),
        word_bytes=size / len(words),
        bare=len(_BARE.findall(raw)) / len(words),
        shouts=counts[33] / len(words),
    )


def _vote(bad: bool, good: bool) -> int:
    return BAD if bad else GOOD if good else ABSTAIN


#: Name and vote of each labeller. Between its two limits a labeller abstains.
LABELLERS = (
    ("marks", lambda f: _vote(f.marks > 0.08, f.marks < 0.02)),
    ("letters", lambda f: _vote(f.letters < 0.8, f.letters > 0.93)),
    ("capitals", lambda f: _vote(f.capitals > 0.3, 0.002 < f.capitals < 0.12)),
    ("variety", lambda f: _vote(f.distinct < 0.35, f.distinct > 0.8) if f.words >= 20 else ABSTAIN),
    ("stutter", lambda f: _vote(f.same_next > 0.15, f.same_next < 0.03) if f.words >= 8 else ABSTAIN),
    ("sentences", lambda f: _vote(f.ends < 0.008, 0.02 < f.ends < 0.35) if f.words >= 30 else ABSTAIN),
    ("bare", lambda f: _vote(f.bare > 0.12, f.bare < 0.03) if f.words >= 8 else ABSTAIN),
    ("shouts", lambda f: _vote(f.shouts > 0.25, f.shouts < 0.05) if f.words >= 8 else ABSTAIN),
    ("lengths", lambda f: _vote(not 2 <= f.word_bytes <= 12, 3 <= f.word_bytes <= 9)),
)


def votes(text: str) -> list[int]:
    seen = facts(text)
    return [vote(seen) for _, vote in LABELLERS]


@dataclass
class LabelModel:
    """The share of good texts, and the chance of each vote given a bad or a good text."""

    prior: float
    chances: np.ndarray  # labeller, class, vote + 1

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """The chance of a good text for each row of votes."""
        odds = np.full(len(patterns), np.log(self.prior / (1 - self.prior)))
        for j in range(patterns.shape[1]):
            table = self.chances[j]
            odds += np.log(table[GOOD, patterns[:, j] + 1] / table[BAD, patterns[:, j] + 1])
        return 1 / (1 + np.exp(-np.clip(odds, -60, 60)))

    def accuracies(self) -> dict[str, float]:
        """Of the votes cast, the share that is right."""
        share = np.array([1 - self.prior, self.prior])
        cast = self.chances[:, :, 1:] * share[None, :, None]
        right = cast[:, BAD, BAD] + cast[:, GOOD, GOOD]
        return dict(zip((n for n, _ in LABELLERS), (right / cast.sum((1, 2))).tolist(), strict=True))


def fit_label_model(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> LabelModel:
    """Expectation-maximisation over vote patterns and how many documents have each.

    It starts from labellers that seldom call a good text bad and miss half of the bad ones, as each looks
    for one fault only. Whether a labeller abstains says nothing about the class: only votes cast are
    weighed. A vote never counts against what it says.
    """
    n_labellers = patterns.shape[1] if patterns.size else len(LABELLERS)
    start = np.ones((n_labellers, 2, 3))  # an abstention cancels out of the odds
    start[:, BAD, 1:] = 0.5
    start[:, GOOD, 1:] = 0.02, 0.98
    model = LabelModel(0.8, start)
    if not counts.sum():
        return model
    for _ in range(rounds):
        good = model.posterior(patterns)
        weights = np.stack([(1 - good) * counts, good * counts])
        chances = np.ones((n_labellers, 2, 3))
        for j in range(n_labellers):
            cast = patterns[:, j] >= 0
            called_bad = cast & (patterns[:, j] == BAD)
            share = (weights[:, called_bad].sum(1) + start[j, :, 1] * 4) / (weights[:, cast].sum(1) + 4)
            share[GOOD] = min(share[GOOD], share[BAD])
            chances[j, :, 1], chances[j, :, 2] = share, 1 - share
        updated = LabelModel(float(np.clip(weights[1].sum() / counts.sum(), 0.02, 0.98)), chances)
        moved = max(abs(updated.prior - model.prior), np.abs(updated.chances - model.chances).max())
        model = updated
        if moved < 1e-7:
            break
    return model


#: Kinds of bytes: capitals, other letters (all of UTF-8's upper half), digits; everything else stays.
_KINDS = bytes(
    65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 57 if 48 <= b <= 57 else b for b in range(256)
)
_RUNS = tuple((re.compile(kind + rb"{2,}"), kind) for kind in (b"a", b"A", b"9"))


def shapes(raw: bytes) -> Counter:
    """How often each shape of word occurs: kinds of characters, runs of one kind as one (Aa., A!!, a###)."""
    raw = raw.translate(_KINDS)
    for run, kind in _RUNS:
        raw = run.sub(kind, raw)
    return Counter(raw.split())


def features(text: str) -> dict[int, float]:
    """Hashed features of a whole text: shares of word shapes, and stepped properties of the text.

    Shares are held back in very short texts, where one word is no evidence.
    """
    seen = facts(text)
    if not seen.words:
        return {}
    steps = {
        "marks": min(int(seen.marks * 40), 9),
        "letters": int(seen.letters * 20),
        "capitals": min(int(seen.capitals * 16), 9) if seen.words >= 4 else -1,
        "distinct": min(int(seen.distinct * 8), 9) if seen.words >= 8 else -1,
        "next": min(int(seen.same_next * 16), 9),
        "ends": min(int(seen.ends * 60), 9) if seen.words >= 30 else -1,
        "bytes": min(int(seen.word_bytes), 20),
        "bare": min(int(seen.bare * 20), 9),
        "shouts": min(int(seen.shouts * 10), 9),
    }
    weights: dict[int, float] = {}
    for name, value in steps.items():
        weights[zlib.crc32(f"{name} {value}".encode()) % FEATURES] = 1.0
    for shape, count in shapes(text.encode("utf-8", "replace")).items():
        bucket = zlib.crc32(shape) % FEATURES
        weights[bucket] = weights.get(bucket, 0.0) + 2 * count / (seen.words + 8)
    return weights


@dataclass
class QualityModel:
    labels: LabelModel
    weights: np.ndarray
    offset: float

    def scorer(self):
        table = self.weights.tolist()

        def score(text: str) -> float:
            hashed = features(text)
            if not hashed:
                return 0.0
            logit = self.offset + sum(table[b] * w for b, w in hashed.items())
            return float(1 / (1 + np.exp(-min(max(logit, -60), 60))))

        return score


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray]], targets: np.ndarray, seed: int = 11) -> tuple[np.ndarray, float]:
    """Logistic regression on soft targets, classes balanced, by Adagrad with a small decay."""
    weights, offset = np.zeros(FEATURES), 0.0
    squares, offset_squares = np.full(FEATURES, 1e-6), 1e-6
    rng = np.random.default_rng(seed)
    share = float(np.clip(targets.mean(), 0.02, 0.98))
    cost = 0.5 * (targets / share + (1 - targets) / (1 - share))  # as if half were bad
    for _ in range(_EPOCHS):
        order = rng.permutation(len(rows))
        for start in range(0, len(order), 32):
            batch = order[start : start + 32]
            ids = np.concatenate([rows[i][0] for i in batch])
            values = np.concatenate([rows[i][1] for i in batch])
            owner = np.repeat(np.arange(len(batch)), [len(rows[i][0]) for i in batch])
            logits = np.bincount(owner, weights[ids] * values, len(batch)) + offset
            error = (1 / (1 + np.exp(-np.clip(logits, -60, 60))) - targets[batch]) * cost[batch] / len(batch)
            slope = np.bincount(ids, error[owner] * values, FEATURES) + 1e-5 * weights
            squares += slope * slope
            weights -= _RATE * slope / np.sqrt(squares)
            offset_squares += error.sum() ** 2
            offset -= _RATE * error.sum() / np.sqrt(offset_squares)
    return weights.astype(np.float32), float(offset)


def _voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.int32())
    for batch in slices(batches):
        made = pa.array([votes(t) for t in batch.column("text").to_pylist()], kind)
        yield pa.RecordBatch.from_arrays([made], ["votes"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.list_(pa.int32()), pa.list_(pa.float32()), pa.list_(pa.int32())]
    for batch in slices(batches):
        texts = batch.column("text").to_pylist()
        hashed = [features(t) for t in texts]
        made = ([list(h) for h in hashed], [list(h.values()) for h in hashed], [votes(t) for t in texts])
        columns = [pa.array(m, kind) for m, kind in zip(made, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "ids", "weights", "votes"])


def train(docs: DataFrame, max_sample: int = MAX_SAMPLE) -> QualityModel:
    """Accuracies from the votes on all documents; the scorer from the ``max_sample`` first by a hash of the id."""
    texts = texts_of(docs).where(F.length(F.trim("text")) > 0)
    patterns = texts.select("text").mapInArrow(_voted, "votes array<int>").groupBy("votes").agg(F.count("*").alias("n")).collect()
    table = np.array([r["votes"] for r in patterns], int).reshape(len(patterns), len(LABELLERS))
    labels = fit_label_model(table, np.array([r["n"] for r in patterns], float))
    sample = texts.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_sample)
    chosen = one_text_per_id(texts.join(F.broadcast(sample), "doc_id", "left_semi"))
    rows = chosen.mapInArrow(_hashed, "doc_id long, ids array<int>, weights array<float>, votes array<int>").toArrow()
    if not rows.num_rows:
        return QualityModel(labels, np.zeros(FEATURES, np.float32), 0.0)
    order = np.argsort(rows.column("doc_id").to_numpy())
    ids, weights = rows.column("ids").combine_chunks(), rows.column("weights").combine_chunks()
    bags = [(ids[int(i)].values.to_numpy(), weights[int(i)].values.to_numpy()) for i in order]
    voted = np.array(rows.column("votes").to_pylist(), int)[order]
    return QualityModel(labels, *fit_scorer(bags, labels.posterior(voted)))


def score(docs: DataFrame, model: QualityModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, score (1: likelier good) and kept, for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def prepare():
        one = shared.value.scorer()
        return lambda text: (one(text),)

    run = row_mapper(None, ["score"], [pa.float64()], prepare)
    scored = texts_of(docs, id_column, text_column).mapInArrow(run, "doc_id long, score double")
    return scored.withColumn("kept", F.col("score") >= REJECT_BELOW)


def keep_good(docs: DataFrame, model: QualityModel, text_column: str = "text") -> DataFrame:
    """The rows, all columns, that the scorer does not reject."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def good(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        one = shared.value.scorer()
        for texts in batches:
            yield texts.map(lambda t: one(t) >= REJECT_BELOW)

    return docs.where(good(F.coalesce(F.col(text_column), F.lit(""))))
