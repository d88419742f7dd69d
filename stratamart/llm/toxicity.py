"""Toxicity: bags of subwords, averaged into a linear softmax, trained jointly in numpy.

A word is the mean of the vectors of its byte n-grams, a text the mean of its words, and a softmax over
two classes reads the text's vector; vectors and softmax are learnt together. A misspelt word shares most
n-grams with the word it stands for, so it needs no entry of its own.

The fit uses a bounded sample of labelled rows (``max_per_class`` of either class, the first by a hash of
the id); the base rate is counted over all labelled rows. Scoring reads every whole text. As the softmax
is linear, each n-gram has one number for scoring, and texts are scored where they are.

Defined results: NULL and empty texts get the score of no evidence. Of several labels of one document the
highest counts; NULL labels and labels without a document are ignored. With no usable label, or labels of
one class only, every score is the smoothed base rate. Repeated rows give repeated results; of several texts
of one id the first by hash is learnt from. Extra columns are not read, whatever their names. An empty table
gives no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.llm.common import materialise, one_text_per_id, row_mapper, slices, texts_of

BUCKETS = 1 << 17
GRAMS = (3, 4, 5, 6)
DIM = 8
EPOCHS = 16
MAX_PER_CLASS = 1_500
#: Standard errors by which the shares of texts with an n-gram must differ between the classes.
CLEAR = 5.0
#: Every text is read as if so many words that say nothing followed: one odd word is no proof in a short text.
NEUTRAL_WORDS = 20
_BATCH = 32
_RATE = 0.05
_GAIN = 20.0
#: Words kept with their values in a task, and the length of the longest that are.
_CACHED_WORDS, _CACHED_LENGTH = 400_000, 64
_EDGES = ".,!?;:|#$%&*\"'()[]{}<>-_=+~`/\\"


def word_buckets(token: str) -> list[int]:
    """The buckets of a lower-case token's n-grams and of the token itself; none for bare punctuation."""
    word = token.strip(_EDGES)
    if not word:
        return []
    raw = b"<" + word.encode("utf-8", "replace") + b">"
    crc = zlib.crc32
    grams = [crc(raw[i : i + n]) % BUCKETS for n in GRAMS for i in range(len(raw) - n + 1)]
    grams.append(crc(raw) % BUCKETS)
    return grams


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and their weights: the mean over words of the mean over n-grams."""
    words = text.lower().split()
    ids, weights = [], []
    for token, count in Counter(words).items():
        if grams := word_buckets(token):
            ids += grams
            weights += [count / ((len(words) + NEUTRAL_WORDS) * len(grams))] * len(grams)
    if not ids:
        return np.empty(0, np.int32), np.empty(0, np.float32)
    unique, place = np.unique(np.array(ids, np.int32), return_inverse=True)
    return unique, np.bincount(place, weights).astype(np.float32)


@dataclass
class ToxicityModel:
    """What each bucket adds to the log odds, their offset, and both together for a text."""

    weights: np.ndarray
    offset: float

    def scorer(self):
        """A function of a text, with a bounded cache of word values."""
        table = self.weights.tolist()
        offset = self.offset

        class Values(dict):
            def __missing__(self, token: str) -> float:
                if len(self) >= _CACHED_WORDS:
                    self.clear()
                grams = word_buckets(token)
                value = sum(map(table.__getitem__, grams)) / len(grams) if grams else 0.0
                if len(token) <= _CACHED_LENGTH:
                    self[token] = value
                return value

        values = Values()

        def score(text: str) -> float:
            words = text.lower().split()
            logit = offset + sum(map(values.__getitem__, words)) / (len(words) + NEUTRAL_WORDS)
            return float(1 / (1 + np.exp(-np.clip(logit, -60, 60))))

        return score


def _telling(texts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Buckets that occur in clearly more toxic texts than others; from texts by class and bucket, and by class.

    A text has thousands of n-grams and few that matter; the rest would only be learnt by heart. What is
    rarer in toxic texts says what else they are about, such as their language, and is no excuse.
    """
    sizes = sizes[:, None]
    shares, pooled = texts / sizes, texts.sum(0) / sizes.sum()
    spread = np.sqrt(np.maximum(pooled * (1 - pooled), 1e-12) * (1 / sizes).sum())
    return np.flatnonzero(shares[1] - shares[0] > CLEAR * spread)


def fit(
    bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, kept: np.ndarray, base_rate: float, seed: int = 7
) -> ToxicityModel:
    """Train embeddings and softmax together (Adam, balanced classes), then set the offset to the base rate.

    ``kept`` are the buckets that have an embedding; the bags hold no others.
    """
    prior = float(np.log(base_rate / (1 - base_rate)))
    labels = np.asarray(labels)
    if not len(labels) or labels.min() == labels.max():
        return ToxicityModel(np.zeros(BUCKETS, np.float32), prior)
    place = np.full(BUCKETS, -1, np.int64)
    place[kept] = np.arange(len(kept))
    rows = []
    for ids, weights in bags:
        at = place[ids]
        rows.append((at[at >= 0], weights[at >= 0] * _GAIN))
    rng = np.random.default_rng(seed)
    out, bias = rng.normal(0, 0.1, (DIM, 2)), np.zeros(2)
    # All n-grams start alike on the toxic side, so that those of one word learn the same.
    vectors = rng.normal(0, 0.01, (len(kept), DIM)) + (out[:, 1] - out[:, 0])
    share = np.bincount(labels, minlength=2) / len(labels)
    cost = 0.5 / share[labels]
    parameters = [vectors, out, bias]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in parameters]
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(rows))
        rate = _RATE * (1 - epoch / EPOCHS)
        for start in range(0, len(order), _BATCH):
            batch = order[start : start + _BATCH]
            ids = np.concatenate([rows[i][0] for i in batch])
            weights = np.concatenate([rows[i][1] for i in batch])
            owner = np.repeat(np.arange(len(batch)), [len(rows[i][0]) for i in batch])
            weighted = vectors[ids] * weights[:, None]
            hidden = np.stack([np.bincount(owner, weighted[:, d], len(batch)) for d in range(DIM)], 1)
            logits = hidden @ out + bias
            chance = np.exp(logits - logits.max(1, keepdims=True))
            chance /= chance.sum(1, keepdims=True)
            error = chance
            error[np.arange(len(batch)), labels[batch]] -= 1
            error *= (cost[batch] / len(batch))[:, None]
            back = (error @ out.T)[owner] * weights[:, None]
            slope = np.stack([np.bincount(ids, back[:, d], len(kept)) for d in range(DIM)], 1)
            step += 1
            for value, (first, second), grad in zip(
                parameters, moments, (slope, hidden.T @ error, error.sum(0)), strict=True
            ):
                first += 0.1 * (grad - first)
                second += 0.001 * (grad * grad - second)
                value -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
            # An n-gram of toxic texts never speaks for a text: its vector stays on the toxic side.
            axis = out[:, 1] - out[:, 0]
            vectors -= np.outer(np.minimum(vectors @ axis, 0), axis / max(axis @ axis, 1e-12))
    weights = np.zeros(BUCKETS, np.float32)
    weights[kept] = _GAIN * (vectors @ (out[:, 1] - out[:, 0]))
    return ToxicityModel(weights, float(bias[1] - bias[0]) + prior)


def held_out(doc_id: str = "doc_id"):
    """Rows whose labels are never learnt from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _only(kept: np.ndarray):
    """Bags without the buckets that say nothing, so that few bytes of a text reach the driver."""
    kinds = [pa.list_(pa.int32()), pa.list_(pa.float32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made = []
            for ids, weights in zip(batch.column("ids"), batch.column("weights"), strict=True):
                ids, weights = ids.values.to_numpy(), weights.values.to_numpy()
                told = np.isin(ids, kept)
                made.append((ids[told], weights[told]))
            columns = [pa.array([m[i] for m in made], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "ids", "weights"])

    return run


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.list_(pa.int32()), pa.list_(pa.float32())]
    for batch in slices(batches):
        made = [bag(t) for t in batch.column("text").to_pylist()]
        columns = [pa.array([m[i] for m in made], kind) for i, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "ids", "weights"])


def train(docs: DataFrame, labels: DataFrame, max_per_class: int = MAX_PER_CLASS) -> ToxicityModel:
    """Fit on a sample of the labelled rows of ``docs``; ``labels`` has doc_id and toxic (0 or 1)."""
    usable = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    counts = {r["toxic"]: r["n"] for r in usable.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    base_rate = (counts.get(1, 0) + 0.5) / (sum(counts.values()) + 10)
    if len(counts) < 2:
        return ToxicityModel(np.zeros(BUCKETS, np.float32), float(np.log(base_rate / (1 - base_rate))))
    picked = [
        usable.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_per_class) for c in (0, 1)
    ]
    sample = picked[0].unionByName(picked[1])  # at most 2 * max_per_class rows of two numbers
    chosen = texts_of(docs).join(F.broadcast(sample.select("doc_id")), "doc_id", "left_semi")
    ddl = "doc_id long, ids array<int>, weights array<float>"
    bagged = materialise(one_text_per_id(chosen).mapInArrow(_bags, ddl), "bags")
    known = bagged.join(F.broadcast(sample), "doc_id")
    sizes = np.zeros(2)
    for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect():
        sizes[r["toxic"]] = r["n"]
    if not sizes.all():
        return ToxicityModel(np.zeros(BUCKETS, np.float32), float(np.log(base_rate / (1 - base_rate))))
    counted = known.select("toxic", F.explode("ids").alias("bucket")).groupBy("toxic", "bucket").agg(F.count("*").alias("n"))
    counted, texts = counted.toArrow(), np.zeros((2, BUCKETS))  # as many rows as there are buckets, twice
    texts[counted.column("toxic").to_numpy(), counted.column("bucket").to_numpy()] = counted.column("n").to_numpy()
    kept = _telling(texts, sizes)
    rows = bagged.mapInArrow(_only(kept), ddl).toArrow()
    toxic = {r["doc_id"]: r["toxic"] for r in sample.collect()}
    order = np.argsort(rows.column("doc_id").to_numpy())  # the fit must not depend on the order of arrival
    ids, weights = rows.column("ids").combine_chunks(), rows.column("weights").combine_chunks()
    bags = [(ids[int(i)].values.to_numpy(), weights[int(i)].values.to_numpy()) for i in order]
    known = [toxic[d] for d in rows.column("doc_id").to_numpy()[order].tolist()]
    return fit(bags, np.array(known, np.int64), kept, base_rate)


def score(docs: DataFrame, model: ToxicityModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def prepare():
        one = shared.value.scorer()
        return lambda text: (one(text),)

    run = row_mapper(None, ["score"], [pa.float64()], prepare)
    scored = texts_of(docs, id_column, text_column).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: ToxicityModel, text_column: str = "text") -> DataFrame:
    """The rows, all columns, that the model does not call toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        one = shared.value.scorer()
        for texts in batches:
            yield texts.map(lambda t: one(t) < 0.5)

    return docs.where(clean(F.coalesce(F.col(text_column), F.lit(""))))
