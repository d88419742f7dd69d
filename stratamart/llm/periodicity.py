"""Periodic runs of words: online detection by dyadic square catching.

Words are appended to a growing sequence. Every aligned block of a power of two words becomes a catcher once
it is complete. Each appended word ends one suffix of every block size, and that suffix is compared with the
one catcher that lies between one and two of its sizes before it (for the smallest size also with those up to
one size before). If they agree, the text between has a square of that period: its extent is found by
comparing words one period apart, to the left at once, to the right as far as words are there. What reaches
the end stays open, and later words carry it on. Squares within one extent merge into one run.

A run of period q has at least 3q words. So the words of it that are repeated one period later hold a whole
aligned block of the power of two next below q, and no run is missed. Equal extents have one smallest period;
the others are multiples of it. Suffixes are compared by 64-bit fingerprints, and what these find is decided
by the words themselves. Appending many words at once compares their suffixes as arrays. Memory and the cost
of a word do not grow beyond the words themselves and the logarithm of their number.

Defined results: NULL and blank texts have no words, no runs and an empty collapsed text. A NULL id stays.
Texts of any length are read whole. Repeated rows give repeated results. Only the id and the text are read,
so extra columns may have any names. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.llm.common import slices, texts_of

#: A run has at least this many words and this many periods.
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Words appended at a time.
APPEND_WORDS = 65_536

_FIRST, _SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)
_SHIFT = np.uint64(29)

Run = tuple[int, int, int]


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Fingerprints of windows from those of their halves."""
    mixed = (left * _FIRST + right) * _SECOND
    return mixed ^ (mixed >> _SHIFT)


class _Level:
    """Fingerprints of the windows of one block size, from window ``first`` on."""

    def __init__(self, block: int, first: int, prints: np.ndarray) -> None:
        self.block, self.first, self.prints = block, first, prints

    @property
    def end(self) -> int:
        return self.first + len(self.prints)

    def windows(self, start: int, stop: int) -> np.ndarray:
        return self.prints[start - self.first : stop - self.first]

    def trim(self) -> None:
        """Keep what later suffixes are compared with, and what the next level is made from."""
        first = max(self.first, self.end - 5 * self.block)
        self.first, self.prints = first, self.prints[first - self.first :].copy()


class Catchers:
    """The runs of a sequence of whole numbers that grows at its end."""

    def __init__(self, least_words: int = LEAST_WORDS) -> None:
        if least_words < LEAST_PERIODS:
            raise ValueError(f"a run has at least {LEAST_PERIODS} words")
        self.least_words = least_words
        # the greatest power of two of which every run's repeated part holds an aligned block
        self._base = 1 << ((2 * least_words // 3 + 1) // 2).bit_length() - 1
        self._held = np.empty(1024, np.int64)
        self._size = 0
        self._levels: list[_Level] = []
        self._open: dict[int, int] = {}  # start by period of what reaches the end
        self._closed: dict[tuple[int, int], int] = {}  # least period by extent

    # -- extents --------------------------------------------------------------------------------

    def _agrees_until(self, at: int, period: int) -> int:
        """The first place from ``at`` on whose word differs from that one period before it."""
        words, step = self._held, 32
        while at < self._size:
            end = min(self._size, at + step)
            differ = np.flatnonzero(words[at:end] != words[at - period : end - period])
            if len(differ):
                return at + int(differ[0])
            at, step = end, step * 2
        return at

    def _agrees_from(self, at: int, period: int) -> int:
        """The least start from which on all words to ``at`` agree with those one period after them."""
        words, step = self._held, 32
        while at > 0:
            begin = max(0, at - step)
            differ = np.flatnonzero(words[begin:at] != words[begin + period : at + period])
            if len(differ):
                return begin + int(differ[-1]) + 1
            at, step = begin, step * 2
        return at

    def _is_run(self, start: int, end: int, period: int) -> bool:
        return end - start >= max(self.least_words, LEAST_PERIODS * period)

    def _note(self, start: int, end: int, period: int) -> None:
        """An extent whose end is known: what reaches the end of the words stays open."""
        if end == self._size:
            self._open[period] = start
        elif self._is_run(start, end, period):
            self._closed[start, end] = min(period, self._closed.get((start, end), period))

    # -- growing --------------------------------------------------------------------------------

    def append(self, words: np.ndarray) -> None:
        """Add words, given as whole numbers, at the end."""
        before, self._size = self._size, self._size + len(words)
        if self._size > len(self._held):
            grown = np.empty(max(self._size, 2 * len(self._held)), np.int64)
            grown[:before] = self._held[:before]
            self._held = grown
        self._held[before : self._size] = words
        carried = {}
        for period, start in list(self._open.items()):
            end = self._agrees_until(before, period)
            carried[period] = (start, end)
            del self._open[period]
            self._note(start, end, period)
        for level, first_new in self._grow(before):
            self._compare(level, first_new, carried)
        for level in self._levels:
            level.trim()

    def _grow(self, before: int) -> Iterator[tuple[_Level, int]]:
        """The levels, smallest first, each with the new words' windows and the first of these."""
        block = self._base
        begin = max(0, before - block + 1)
        prints, half = self._held[begin : self._size].astype(np.uint64), 1
        while half < block and len(prints) > half:
            prints, half = _joined(prints[:-half], prints[half:]), 2 * half
        if half < block or not len(prints):
            return
        number = 0
        while True:
            if number == len(self._levels):
                self._levels.append(_Level(block, 0, prints))
                begin = 0
            else:
                level = self._levels[number]
                level.prints = np.concatenate([level.prints, prints])
            lower = self._levels[number]
            yield lower, begin
            number, block = number + 1, 2 * block
            if 3 * block > self._size:
                return
            begin = self._levels[number].end if number < len(self._levels) else 0
            stop = self._size - block + 1
            prints = _joined(lower.windows(begin, stop), lower.windows(begin + block // 2, stop + block // 2))

    # -- catching -------------------------------------------------------------------------------

    def _compare(self, level: _Level, first_new: int, carried: dict[int, tuple[int, int]]) -> None:
        """Compare each new window with its catcher and follow up what agrees."""
        block, at = level.block, np.arange(first_new, level.end)
        new = level.windows(first_new, level.end)
        catchers = [at // block * block - block]
        if block == self._base:
            catchers.append((at - 1) // block * block)
        found = []
        for catcher in catchers:
            known = np.flatnonzero(catcher >= 0)
            same = known[new[known] == level.prints[catcher[known] - level.first]]
            if len(same):
                found.append(np.stack([at[same] - catcher[same], catcher[same]], 1))
        if not found:
            return
        caught = np.unique(np.concatenate(found), axis=0)  # (period, start of the block)
        for period in np.unique(caught[:, 0]).tolist():
            starts = caught[caught[:, 0] == period, 1]
            self._follow(self._unexplained(starts, period, block), period, block, carried)

    def _unexplained(self, starts: np.ndarray, period: int, block: int) -> np.ndarray:
        """Without those inside a run of a period that divides this one: they repeat that run.

        Runs of short periods overlap by less than two of these, so of those that begin at or before
        a place only the last can hold it and all that a catcher compares.
        """
        runs = [(s, e, p) for (s, e), p in self._closed.items() if p < period and not period % p]
        runs += [(s, self._size, p) for p, s in self._open.items() if p < period and not period % p and self._is_run(s, self._size, p)]
        if not runs:
            return starts
        ordered = np.array(sorted(runs))
        last = np.searchsorted(ordered[:, 0], starts, "right") - 1
        inside = (last >= 0) & (starts + period + block <= ordered[last, 1])
        return starts[~inside]

    def _follow(self, starts: np.ndarray, period: int, block: int, carried: dict[int, tuple[int, int]]) -> None:
        """Find the extent of each catch that no earlier one of its period covers."""
        begin, end = carried.get(period, (0, 0))
        starts = starts[(starts < begin) | (starts + period + block > end)]
        place = 0
        while place < len(starts):
            start = int(starts[place])
            again = start + period
            place += 1
            if not np.array_equal(self._held[start : start + block], self._held[again : again + block]):
                continue  # equal fingerprints of different words
            begin, end = self._agrees_from(start, period), self._agrees_until(again + block, period)
            self._note(begin, end, period)
            place = max(place, int(np.searchsorted(starts, end - period - block, "right")))

    # -- results --------------------------------------------------------------------------------

    def runs(self) -> list[Run]:
        """(start, length, least period) of every run so far, by start and period."""
        least = dict(self._closed)
        for period, start in self._open.items():
            if self._is_run(start, self._size, period):
                extent = (start, self._size)
                least[extent] = min(period, least.get(extent, period))
        return sorted(((s, e - s, p) for (s, e), p in least.items()), key=lambda run: (run[0], run[2]))


def words_of(text: str) -> list[bytes]:
    """The words of a text: what white space of ASCII separates."""
    return text.encode().split()


def find_runs(words: list, least_words: int = LEAST_WORDS, at_once: int = APPEND_WORDS) -> list[Run]:
    if len(words) < least_words:
        return []
    numbers: dict = {}
    coded = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    catchers = Catchers(least_words)
    for start in range(0, len(coded), at_once):
        catchers.append(coded[start : start + at_once])
    return catchers.runs()


def collapse(words: list, runs: list[Run]) -> list:
    """Of every run the words of its first period, and all words outside runs."""
    if not runs:
        return words
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(kept).tolist()]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_FOUND = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())]
)
_FOUND_DDL = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def _found(least_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sizes, runs, texts = [], [], []
            for text in batch.column("text").to_pylist():
                words = words_of(text)
                found = find_runs(words, least_words)
                sizes.append(len(words))
                runs.append([{"start": s, "length": n, "period": p} for s, n, p in found])
                texts.append(b" ".join(collapse(words, found)).decode())
            columns = [pa.array(sizes, pa.int64()), pa.array(runs, _FOUND.field("runs").type), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], schema=_FOUND)

    return run


def periodic_runs(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least_words: int = LEAST_WORDS
) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start and period) and the collapsed text of every row."""
    return texts_of(docs, id_column, text_column).mapInArrow(_found(least_words), _FOUND_DDL)


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """doc_id and text; for a tenth of the ids, chosen by hash, the words from some place on repeat with a period."""
    digest = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = F.coalesce(digest % 10 == 0, F.lit(False))
    words = F.filter(F.split(F.col("text"), r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    picked = texts_of(docs).select(
        "doc_id",
        "text",
        F.floor(digest / 10).alias("_g"),
        F.when(chosen, words).otherwise(F.array().cast("array<string>")).alias("_words"),
    )
    n = F.size("_words").cast("long")
    sized = picked.withColumns({"_a": F.when(n > 0, F.col("_g") % n), "_n": n})
    period = F.lit(1) + F.floor((F.col("_n") - F.col("_a")) / (F.lit(3) + F.col("_g") % 8))
    tailed = sized.withColumn("_p", period)
    a, p = F.col("_a"), F.col("_p")
    place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
    repeated = F.transform(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1), lambda i: F.get("_words", place(i).cast("int")))
    return tailed.select("doc_id", F.when(F.col("_n") > 0, F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


def _strongest(runs: str) -> Column:
    """The run of the most periods; of equal ones the first."""
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    more = lambda best, run: run["length"] * best["period"] > best["length"] * run["period"]
    return F.reduce(runs, none, lambda best, run: F.when(best.isNull() | more(best, run), run).otherwise(best))


def run_digest(found: DataFrame) -> DataFrame:
    """Per row of ``periodic_runs``: the number of runs, the strongest one, and digests of all and of the collapsed text."""
    line = lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n"))
    best = found.withColumn("_best", _strongest("runs"))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"_best.{name}").alias(name) for name in ("start", "length", "period")],
        F.floor(F.lit(1000) * F.col("_best.length") / F.col("_best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
