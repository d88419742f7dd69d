"""Best-fit packing into sequences of a fixed number of tokens, certified by lower bounds.

Documents are cut only where they are longer than a sequence; full pieces are sequences of their own. The
other pieces are dealt to partitions and packed there by best-fit decreasing. A lower bound from
dual-feasible functions certifies a partition whose number of sequences no packing of its pieces can beat.
Its sequences are final, except for the emptiest ones: these, and everything with a gap in partitions
that are not certified, are exchanged. Partitions of the next round are fewer and get pieces from many
others, and best-fit decreasing runs again. The last round, of one partition or after ``max_rounds``, keeps
what comes out. A partition holds a bounded number of pieces in every round.

Defined results: NULL and empty texts are the end id alone. Repeated rows are packed as often as they occur.
Rows without an id are packed too. Only the id and the text are read. An empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stratamart.llm.common import materialise, slices, texts_of

VOCABULARY = "word_bpe_49k.json"
CAPACITY = 4096
END_ID = 1
#: Pieces that a partition gets on average.
PARTITION_PIECES = 50_000
MAX_ROUNDS = 6
#: Words kept with their ids in a task, and the length of the longest that are.
_CACHED_WORDS, _CACHED_LENGTH = 400_000, 64

_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
#: Letters of Latin-1, then ASCII marks but the apostrophe: two words for the tokenizer, without exceptions.
_PLAIN = re.compile(rf"([{_LETTERS}]*)([!-&(-/:-@\[-`{{-~]*)")


@lru_cache(2)
def _tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in kept]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(other)}


class WordIds(dict):
    """Ids of a text's words as bytes (unsigned 32-bit, little-endian), looked up by the word as written.

    The tokenizer never joins letters across a space or a line feed, so words between them can be encoded
    one by one. Words of Latin-1 letters and marks go to its merge model straight away; all others go
    through the whole tokenizer. The cache is bounded.
    """

    def __init__(self, path: str) -> None:
        super().__init__()
        self._whole = _tokenizer(path)
        self._model = self._whole.model
        self._letters = _byte_letters()
        self._parts: dict[str, bytes] = {"": b""}

    def _part(self, part: str) -> bytes:
        known = self._parts.get(part)
        if known is None:
            if len(self._parts) >= _CACHED_WORDS:
                self._parts = {"": b""}
            written = part.encode().decode("latin-1").translate(self._letters)
            known = np.array([t.id for t in self._model.tokenize(written)], "<u4").tobytes()
            if len(part) <= _CACHED_LENGTH:
                self._parts[part] = known
        return known

    def __missing__(self, word: str) -> bytes:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        plain = _PLAIN.fullmatch(word)
        if plain and "<|" not in word:
            ids = self._part(plain[1].lower()) + self._part(plain[2])
        else:
            ids = np.array(self._whole.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        if len(word) <= _CACHED_LENGTH:
            self[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if "<|" in text:  # a special token may hold no space, but stay with the tokenizer itself
            return np.array(self._whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


_PIECE = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
)
_PIECE_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _cut(path: str, capacity: int):
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(path)
        for batch in slices(batches):
            rows = []
            for doc, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text")), strict=True):
                ids = words.encode(text) + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PIECE, strict=True)], schema=_PIECE
            )

    return run


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Token ids of every document with its end id, cut at ``capacity``: one row per piece."""
    return texts_of(docs, id_column, text_column).mapInArrow(_cut(path, capacity), _PIECE_DDL)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """No packing needs fewer sequences: the best of the volume and two families of dual-feasible functions.

    u(k): lengths as shares of k + 1 steps, whole multiples kept and others rounded down to k steps.
    f(e): lengths over capacity - e count as the capacity, those below e as nothing.
    """
    if not len(lengths):
        return 0
    values, counts = np.unique(lengths, return_counts=True)
    best = -(-int((values * counts).sum()) // capacity)
    for k in range(1, 21):
        scaled = values * (k + 1)
        exact = scaled % capacity == 0
        total = int((counts * np.where(exact, values * k, scaled // capacity * capacity)).sum())
        best = max(best, -(-total // (capacity * k)))
    # Thresholds that matter are the lengths up to one half; prefix sums give each bound at once.
    volume, number = np.r_[0, np.cumsum(values * counts)], np.r_[0, np.cumsum(counts)]
    steps = values[values * 2 <= capacity]
    low = np.searchsorted(values, steps, "left")
    high = np.searchsorted(values, capacity - steps, "right")
    total = volume[high] - volume[low] + (number[-1] - number[high]) * capacity
    return max([best, *(-(-total // capacity)).tolist()])


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece: longest first, each into the fullest sequence with room.

    Open sequences are kept by the room they have, and the next room in use is found in a bit mask, so a
    piece costs the same however many sequences are open.
    """
    order = np.argsort(-lengths, kind="stable")
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    in_use, opened = 0, 0
    for at, length in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fits = in_use >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            here = by_room[room].pop()
            if not by_room[room]:
                in_use ^= 1 << room
        else:
            room, here, opened = capacity, opened, opened + 1
        sequence[at], offset[at] = here, capacity - room
        left = room - length
        if left:
            by_room[left].append(here)
            in_use |= 1 << left
    return sequence, offset


def _pack(capacity: int, last: bool):
    """Pack one partition; ``final`` marks the rows whose sequences stay as they are."""

    def run(table: pa.Table) -> pa.Table:
        # Repeated rows are alike, so any order among them gives the same sequences.
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        lengths = table.column("length").to_numpy()
        sequence, offset = best_fit_decreasing(lengths, capacity)
        n = int(sequence.max()) + 1
        filled = np.bincount(sequence, lengths, n).astype(np.int64)
        if last:
            final = np.ones(n, bool)
        else:
            certified = n == lower_bound(lengths, capacity)
            gaps = filled < capacity
            if certified:  # what is missing to a whole number of sequences sits in few of them
                emptiest = np.argsort(filled, kind="stable")
                gaps = np.zeros(n, bool)
                gaps[emptiest[: max(2, n // 50)]] = True
                gaps &= filled < capacity
            final = ~gaps
        columns = {"seq": sequence, "offset": offset, "final": final[sequence]}
        for name, values in columns.items():
            table = table.append_column(name, pa.array(values))
        return table

    return run


def pack(
    piece_rows: DataFrame, capacity: int = CAPACITY, partition_pieces: int = PARTITION_PIECES, max_rounds: int = MAX_ROUNDS
) -> DataFrame:
    """sequence_id and offset for every row of ``piece_rows`` (doc_id, piece, start, length, ids_crc32).

    ``piece_rows`` must be a stored table: pieces are dealt at random with a fixed seed, which repeats when
    a task does only if the rows come in the same order. Sequence ids hold the round, the partition and the
    number within it.
    """
    names = piece_rows.columns
    ddl = ", ".join(f"{n} {t}" for n, t in piece_rows.dtypes)
    waiting, done, n = piece_rows, [], piece_rows.count()
    for round_no in range(max_rounds + 1):
        parts = max(1, -(-n // partition_pieces))
        last = parts == 1 or round_no == max_rounds
        dealt = waiting.withColumn("bin", (F.rand(round_no) * parts).cast("int"))
        packed = dealt.groupBy("bin").applyInArrow(
            _pack(capacity, last), f"{ddl}, bin int, seq long, offset long, final boolean"
        )
        packed = materialise(packed, f"packed-{round_no}")
        number = F.lit(round_no).cast("long") * (1 << 58) + F.col("bin").cast("long") * (1 << 26) + F.col("seq")
        done.append(packed.where("final").select(*names, number.alias("sequence_id"), "offset"))
        if last:
            break
        waiting = packed.where(~F.col("final")).select(*names)
        n = waiting.count()
        if not n:
            break
    return reduce(DataFrame.unionByName, done)


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Tokenise, cut and pack whole documents."""
    return pack(materialise(pieces(docs, path, capacity), "pieces"), capacity)
