"""Near-duplicates by SimHash and the generalised pigeonhole principle.

Fingerprints have 64 bits. The bits are grouped into parts, bits that go together into the same part, so
that what is skewed is skewed in few parts. Two fingerprints within ``radius`` bits are, for any thresholds
t_i with sum(t_i + 1) = radius + 1, within t_i bits in some part i; t_i = -1 leaves part i out. Every
fingerprint gets its own thresholds: dynamic programming picks those with the fewest estimated candidates
and probes. The number of parts is chosen the same way. Candidates share a probed part value and are
verified on all 64 bits.

Equal fingerprints are one before anything is compared, so copies cost nothing. A part value that very many
distinct fingerprints share is cut into blocks, and blocks are compared with blocks in tasks of their own.
A task returns a spanning forest of the links that it found, never all pairs.

Defined results: NULL text is empty; empty texts have fingerprint zero and are linked like any other.
Rows without an id have a component too, which is NULL if no id is reachable. Repeated rows give repeated
results. Only the id and the text are read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.llm.common import materialise, slices, texts_of
from stratamart.llm.components import Forest, connected_components

SHINGLE_WORDS = 3
RADIUS = 2
#: Distinct fingerprints from which bit correlations and candidate counts are estimated.
MAX_SAMPLE = 20_000
#: Fingerprints of a block, if more share a part value.
BLOCK = 4_096
#: What a probe costs, in candidates: it is sorted and sent to another task.
_PROBE_COST = 4.0

_BITS = np.array([[(byte >> bit) & 1 for bit in range(8)] for byte in range(256)], np.int64)


def shingle_hashes(text: str, words: int = SHINGLE_WORDS) -> list[int]:
    """XXH64 of every word shingle; bytes.lower lowers A-Z only and bytes.split knows ASCII white space only."""
    tokens = text.encode("utf-8", "replace").lower().split()
    if not tokens:
        return []
    if len(tokens) <= words:
        return [xxhash.xxh64_intdigest(b" ".join(tokens), 42)]
    joined = b" ".join(tokens)
    ends = (np.cumsum([len(t) + 1 for t in tokens]) - 1).tolist()
    starts = [0, *(e + 1 for e in ends)]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], 42) for a, b in zip(starts, ends[words - 1 :])]  # noqa: B905  the shorter ends it


def fingerprint(text: str) -> int:
    hashes = shingle_hashes(text)
    if not hashes:
        return 0
    rows = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(rows[:, byte], minlength=256) @ _BITS for byte in range(8)])
    return sum(1 << bit for bit in np.flatnonzero(2 * ones > len(hashes)).tolist())


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        made = pa.array([_signed(fingerprint(t)) for t in batch.column("text").to_pylist()], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), made], ["doc_id", "fp"])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id and fp, the fingerprint as a signed 64-bit number."""
    return texts_of(docs, id_column, text_column).mapInArrow(_fingerprints, "doc_id long, fp long")


def as_hex(fp) -> object:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


@lru_cache(64)
def _flips(width: int, radius: int) -> np.ndarray:
    """All masks of ``width`` bits with at most ``radius`` ones, the empty mask first."""
    masks = [sum(1 << b for b in bits) for k in range(radius + 1) for bits in combinations(range(width), k)]
    return np.array(masks, np.uint64)


@dataclass
class Parts:
    """Which bits make up each part, and how common its values are in the sample."""

    bits: list[np.ndarray]
    values: list[np.ndarray]
    counts: list[np.ndarray]
    scale: float  # fingerprints of the table for each one of the sample
    radius: int

    def project(self, fps: np.ndarray, part: int) -> np.ndarray:
        out = np.zeros(len(fps), np.uint64)
        for place, bit in enumerate(self.bits[part].tolist()):
            out |= ((fps >> np.uint64(bit)) & np.uint64(1)) << np.uint64(place)
        return out

    def estimated(self, part: int, values: np.ndarray, within: int) -> np.ndarray:
        """Estimated fingerprints that differ from each value in at most ``within`` bits of the part."""
        known, counts = self.values[part], self.counts[part]
        total = np.zeros(len(values))
        width = len(self.bits[part])
        total += counts.sum() * len(_flips(width, within)) * 2.0 ** -width  # what the sample cannot see
        for mask in _flips(width, within):
            near = values ^ mask
            at = np.minimum(np.searchsorted(known, near), len(known) - 1)
            total += np.where(known[at] == near, counts[at], 0)
        return total * self.scale

    def allocate(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Thresholds (fingerprint, part) of least cost by dynamic programming, and those costs."""
        units, n, m = self.radius + 1, len(fps), len(self.bits)
        best = np.full((n, units + 1), np.inf)
        best[:, 0] = 0
        picks = []
        for part in range(m):
            values, width = self.project(fps, part), len(self.bits[part])
            cost = np.zeros((n, units + 1))
            for unit in range(1, units + 1):
                cost[:, unit] = self.estimated(part, values, unit - 1) + _PROBE_COST * len(_flips(width, unit - 1))
            options = np.full((n, units + 1, units + 1), np.inf)  # units so far, units for this part
            for here in range(units + 1):
                options[:, here:, here] = best[:, : units + 1 - here] + cost[:, here : here + 1]
            pick = options.argmin(2)
            best = np.take_along_axis(options, pick[:, :, None], 2)[:, :, 0]
            picks.append(pick)
        thresholds = np.empty((n, m), np.int64)
        left, rows = np.full(n, units), np.arange(n)
        for part in reversed(range(m)):
            here = picks[part][rows, left]
            thresholds[:, part] = here - 1
            left = left - here
        return thresholds, best[:, units]


def _correlated(sample: np.ndarray, parts: int) -> list[np.ndarray]:
    """Parts of nearly equal size; each is grown from a free bit by the bits that go with it most."""
    bits = ((sample[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(float)
    centred = bits - bits.mean(0)
    spread = np.sqrt((centred**2).mean(0)) + 1e-9
    together = np.abs(centred.T @ centred / len(sample) / spread[:, None] / spread)
    np.fill_diagonal(together, 0)
    free, groups = set(range(64)), []
    for part in range(parts):
        size = 64 // parts + (part < 64 % parts)
        left = sorted(free)
        first = left[int(together[np.ix_(left, left)].sum(1).argmax())]
        group = [first]
        free.discard(first)
        while len(group) < size:
            left = sorted(free)
            group.append(left[int(together[np.ix_(left, group)].sum(1).argmax())])
            free.discard(group[-1])
        groups.append(np.array(sorted(group)))
    return groups


def fit_parts(sample: np.ndarray, n_rows: int, radius: int = RADIUS, choices: tuple[int, ...] = (2, 3, 4, 5)) -> Parts:
    """The division into parts of least mean cost over the sample, for a table of ``n_rows`` fingerprints."""
    best, best_cost = None, np.inf
    probe = sample[:512]
    for m in choices:
        bits = _correlated(sample, m)
        made = Parts(bits, [], [], max(1.0, n_rows / len(sample)), radius)
        for part in range(m):
            values, counts = np.unique(made.project(sample, part), return_counts=True)
            made.values.append(values)
            made.counts.append(counts)
        cost = made.allocate(probe)[1].mean() + _PROBE_COST * m
        if cost < best_cost:
            best, best_cost = made, cost
    return best


_SIGNATURE = "part int, value long, fp long, role int"
_DATA, _BOTH, _QUERY = 0, 1, 2


def _signatures(shared):
    """A row for each part of a fingerprint (to be found by) and for each other value that it probes."""
    names = ["part", "value", "fp", "role"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: Parts = shared.value
        for batch in slices(batches, 4096):
            fps = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            thresholds, _ = parts.allocate(fps)
            for part, bits in enumerate(parts.bits):
                values = parts.project(fps, part)
                for at, mask in enumerate(_flips(len(bits), int(max(thresholds[:, part].max(), 0)))):
                    probes = thresholds[:, part] >= int(mask).bit_count()
                    role = np.where(probes, _BOTH, _DATA) if at == 0 else np.full(len(fps), _QUERY)
                    rows = np.ones(len(fps), bool) if at == 0 else probes
                    n = int(rows.sum())
                    if n:
                        columns = [np.full(n, part, np.int32), (values[rows] ^ mask).view(np.int64)]
                        columns += [fps[rows].view(np.int64), role[rows].astype(np.int32)]
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return run


def _forest(fps: np.ndarray, roles: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between queries and data of one group, in blocks."""
    unique, place = np.unique(fps, return_inverse=True)
    queries, data = np.unique(place[roles != _DATA]), np.unique(place[roles != _QUERY])
    forest, step = Forest(len(unique)), 1024
    for q in range(0, len(queries), step):
        mine = queries[q : q + step]
        for d in range(0, len(data), step):
            theirs = data[d : d + step]
            near = np.bitwise_count(unique[mine][:, None] ^ unique[theirs][None, :]) <= radius
            for a, b in zip(*np.nonzero(near), strict=True):
                forest.join(int(mine[a]), int(theirs[b]))
    roots = [forest.root(i) for i in range(len(unique))]
    signed = unique.view(np.int64)
    return [(int(signed[i]), int(signed[r])) for i, r in enumerate(roots) if i != r]


def _verify(radius: int):
    """Groups come sorted and may span batches; the last group of a batch waits for the next one."""

    def edges(keys: np.ndarray, fps: np.ndarray, roles: np.ndarray) -> pa.RecordBatch:
        change = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
        starts, ends = np.r_[0, change], np.r_[change, len(keys)]
        several = np.flatnonzero(ends - starts > 1)
        found = [e for i in several for e in _forest(fps[starts[i] : ends[i]], roles[starts[i] : ends[i]], radius)]
        a, b = zip(*found, strict=True) if found else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            key_columns = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in _GROUP]
            fps = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            roles = batch.column("role").to_numpy(zero_copy_only=False)
            made = (np.stack(key_columns, 1), fps, roles)
            held = made if held is None else tuple(np.concatenate(x) for x in zip(held, made, strict=True))
            keys = held[0]
            other = np.flatnonzero((keys != keys[-1]).any(1))
            if len(other):
                cut = int(other[-1]) + 1
                yield edges(*(x[:cut] for x in held))
                held = tuple(x[cut:] for x in held)
        if held is not None and len(held[0]):
            yield edges(*held)

    return run


_GROUP = ["part", "value", "data_block", "query_block"]


def _blocked(signatures: DataFrame, block: int) -> DataFrame:
    """Groups of more than ``block`` rows become pairs of blocks, each of about ``block`` rows a side."""
    sizes = signatures.groupBy("part", "value").agg(F.count("*").alias("size"))
    large = sizes.where(F.col("size") > block).select(
        "part", "value", F.ceil(F.col("size") / block).cast("int").alias("blocks")
    )
    known = signatures.join(large, ["part", "value"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    sides = known.withColumn("own", own).withColumn(
        "sides", F.expr(f"filter(array({_DATA}, {_QUERY}), s -> role = {_BOTH} or role = s)")
    )
    one = sides.where("blocks = 1").select("part", "value", F.lit(0).alias("data_block"), F.lit(0).alias("query_block"), "fp", "role")
    many = sides.where("blocks > 1").withColumn("side", F.explode("sides"))
    many = many.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    is_data = F.col("side") == _DATA
    return one.unionByName(
        many.select(
            "part",
            "value",
            F.when(is_data, F.col("own")).otherwise(F.col("other")).alias("data_block"),
            F.when(is_data, F.col("other")).otherwise(F.col("own")).alias("query_block"),
            "fp",
            F.col("side").alias("role"),
        )
    )


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS, max_sample: int = MAX_SAMPLE, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that connect just those distinct fingerprints that are within ``radius`` bits of each other.

    ``distinct`` has one row per fingerprint, in the column fp.
    """
    spark = distinct.sparkSession
    n_rows = distinct.count()
    sample = distinct.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(max_sample).toPandas()
    if not len(sample):
        return spark.createDataFrame([], "a long, b long")
    parts = fit_parts(sample["fp"].to_numpy(np.int64).view(np.uint64), n_rows, radius)
    shared = spark.sparkContext.broadcast(parts)  # bounded by max_sample
    signatures = distinct.select("fp").mapInArrow(_signatures(shared), _SIGNATURE)
    grouped = _blocked(materialise(signatures, "signatures"), block)
    ordered = grouped.repartition(*_GROUP).sortWithinPartitions(*_GROUP)
    return ordered.mapInArrow(_verify(radius), "a long, b long")


def near_duplicates(
    docs: DataFrame, radius: int = RADIUS, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id, fingerprint and component_id (least doc_id reachable by links) of every row."""
    rows = materialise(fingerprints(docs, id_column, text_column), "fingerprints")
    distinct = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = connected_components(fingerprint_links(distinct, radius))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    members = rooted.join(ids, "root").select("fp", "component_id")
    return rows.join(members, "fp").select("doc_id", as_hex("fp").alias("fingerprint"), "component_id")
