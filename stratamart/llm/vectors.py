"""Shared by the vector operators: which vectors count, keys of equal vectors, spherical k-means."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """Not null, not empty, every component there and finite, and not all zero."""
    column = F.col(vector)
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(column, lambda x: x != 0), F.lit(False))


def vector_key(vector: str) -> list[Column]:
    """Two 64-bit hashes that together stand for a vector: equal vectors, equal keys."""
    return [F.xxhash64(F.lit(seed), F.col(vector)).alias(f"key{seed}") for seed in (1, 2)]


KEY = ["key1", "key2"]


def matrix(column: pa.Array | pa.ChunkedArray, size: int) -> np.ndarray:
    """A list column as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), size)


def unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(1, keepdims=True)  # squares of tiny components would vanish
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def spherical_kmeans(units: np.ndarray, k: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """Unit centres; an empty cell takes the row that fits its centre least."""
    rng = np.random.default_rng(seed)
    k = max(1, min(k, len(units)))
    centres = units[np.sort(rng.choice(len(units), k, replace=False))].copy()
    for _ in range(rounds):
        near = units @ centres.T
        owner = near.argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, owner, units)
        length = np.sqrt((sums * sums).sum(1))
        worst = np.argsort(near[np.arange(len(units)), owner], kind="stable")
        for place, cell in enumerate(np.flatnonzero(length < 1e-12)):
            sums[cell], length[cell] = units[worst[place]], 1.0
        updated = sums / length[:, None]
        if np.abs(updated - centres).max() < 1e-6:
            break
        centres = updated
    return centres
