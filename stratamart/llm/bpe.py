"""Byte-level BPE by overlapping chunks.

Every text is cut into chunks that overlap, and chunks are pre-tokenised by themselves. In each overlap the
first boundary that both neighbours have is where they resynchronise: the pattern looks at nothing before a
match, so from there on both agree. The left chunk owns the pieces before it, the right one those after it.
Where an overlap has no common boundary (one run without a break), the two chunks are joined and read again,
so the result is always that of the whole text. Then the pieces are encoded one by one, and the ids decoded by
joining their bytes. Chunks of one text are read in one task while they are few; those of a long text are spread
over tasks for reading and for encoding, and meet only to be stitched and put in order.

Defined results: NULL is the empty text, which has no ids. Repeated rows give repeated results. Extra columns
are not read, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.llm.common import slices, texts_of

RANKS = "byte_bpe_50k.tiktoken"
CHUNK_CHARS = 4_096
OVERLAP_CHARS = 256
#: Chunks of texts with more characters are spread over tasks.
SPREAD_CHARS = 65_536
#: Pieces kept with their ids in a task, and the length of the longest that are.
_CACHED_PIECES, _CACHED_LENGTH = 200_000, 64

_KEY = ["doc_id", "text_key"]
_DIGEST = pa.schema(
    [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
)
_DIGEST_DDL = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


@lru_cache(4)
def _encoding(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(4)
def _bytes_of(path: str) -> list[bytes]:
    encoding = _encoding(path)
    return [encoding.decode_single_token_bytes(i) for i in range(encoding.n_vocab)]


@lru_cache(1)
def _pattern() -> regex.Pattern:
    return regex.compile(public_tokenizers.PATTERN)


class PieceIds(dict):
    """The ids of a pre-token as bytes (unsigned 32-bit, little-endian)."""

    def __init__(self, path: str) -> None:
        super().__init__()
        self._encode = _encoding(path).encode_ordinary

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(self._encode(piece), "<u4").tobytes()
        if len(piece) <= _CACHED_LENGTH:
            if len(self) >= _CACHED_PIECES:
                self.clear()
            self[piece] = ids
        return ids


def decode(ids: list[int], path: str) -> bytes:
    return b"".join(map(_bytes_of(path).__getitem__, ids))


def piece_ends(text: str) -> list[int]:
    """Where the pre-tokens of a text end."""
    return [m.end() for m in _pattern().finditer(text)]


def split_text(text: str, chunk: int, overlap: int) -> list[tuple[int, str]]:
    """Chunks with their starts; each but the last reaches ``overlap`` characters into the next."""
    return [(start, text[start : start + chunk + overlap]) for start in range(0, max(len(text), 1), chunk)]


def stitch(chunks: list[tuple[int, str, list[int]]]) -> list[tuple[str, list[int]]]:
    """From (start, text, piece ends within it) in order: what each chunk owns, and its piece ends.

    Owned texts concatenate to the whole text; piece ends are relative to the owned text.
    """
    owned: list[tuple[str, list[int]]] = []
    start, text, ends = chunks[0]
    begin = 0  # in the whole text, from where the current chunk is known to be right
    for next_start, next_text, next_ends in chunks[1:]:
        stop = start + len(text)
        theirs = {next_start, *(next_start + e for e in next_ends)}
        sure = [start + e for e in ends if start + e < stop]  # one that touches the end may go on
        at = next((e for e in sure if e >= next_start and e in theirs), None)
        if at is None:  # no common boundary: go on reading from the last sure one
            last = max([begin, *sure])
            text += next_text[stop - next_start :]
            tail = text[last - start :]
            ends = [e - start for e in sure] + [last - start + e for e in piece_ends(tail)]
            continue
        owned.append((text[begin - start : at - start], [start + e - begin for e in ends if begin < start + e <= at]))
        start, text, ends, begin = next_start, next_text, next_ends, at
    owned.append((text[begin - start :], [start + e - begin for e in ends if start + e > begin]))
    return owned


def _cut_up(text: str, ends: list[int]) -> list[str]:
    return [text[start:end] for start, end in zip([0, *ends[:-1]], ends, strict=True)] if ends else []


def pieces(text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> list[str]:
    """The pre-tokens of a text, by way of its chunks."""
    chunks = split_text(text, chunk, overlap)
    if len(chunks) == 1:
        return _pattern().findall(text)
    owned = stitch([(start, part, piece_ends(part)) for start, part in chunks])
    return [piece for part, ends in owned for piece in _cut_up(part, ends)]


def _digest_columns(ids: bytes, path: str) -> tuple[int, str, str]:
    decoded = decode(np.frombuffer(ids, "<u4").tolist(), path)
    return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()


def _in_one_task(path: str, chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = PieceIds(path)
        for batch in slices(batches):
            coded = [b"".join([ids_of[p] for p in pieces(t, chunk, overlap)]) for t in batch.column("text").to_pylist()]
            rows = [_digest_columns(ids, path) for ids in coded]
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), list(_DIGEST)[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], schema=_DIGEST)

    return run


_CHUNK = pa.schema(
    [
        ("doc_id", pa.int64()), ("text_key", pa.string()), ("copies", pa.int64()), ("chunk_no", pa.int32()),
        ("start", pa.int64()), ("chunk", pa.string()), ("ends", pa.list_(pa.int32())),
    ]
)
_CHUNK_DDL = "doc_id long, text_key string, copies long, chunk_no int, start long, chunk string, ends array<int>"
_CODE_DDL = "doc_id long, text_key string, copies long, chunk_no int, ids binary"


def _cut(chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            row = batch.to_pylist()[0]
            for no, (start, part) in enumerate(split_text(row["text"], chunk, overlap)):
                made = {"doc_id": row["doc_id"], "text_key": row["text_key"], "copies": row["copies"]}
                yield pa.RecordBatch.from_pylist([made | {"chunk_no": no, "start": start, "chunk": part, "ends": []}], _CHUNK)

    return run


def _pretokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 16):
        ends = pa.array([piece_ends(t) for t in batch.column("chunk").to_pylist()], _CHUNK.field("ends").type)
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], ends], schema=_CHUNK)


def _stitch_group(chunks: pa.Table) -> pa.Table:
    rows = sorted(chunks.to_pylist(), key=lambda r: r["chunk_no"])
    owned = stitch([(r["start"], r["chunk"], r["ends"]) for r in rows])
    first = rows[0]
    return pa.Table.from_pylist(
        [first | {"chunk_no": no, "start": 0, "chunk": text, "ends": ends} for no, (text, ends) in enumerate(owned)], _CHUNK
    )


def _encode_pieces(path: str):
    schema = pa.schema([*list(_CHUNK)[:4], ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = PieceIds(path)
        for batch in slices(batches, 16):
            rows = batch.select(["chunk", "ends"]).to_pylist()
            codes = [b"".join([ids_of[p] for p in _cut_up(row["chunk"], row["ends"])]) for row in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(codes, pa.binary())], schema=schema)

    return run


def _digest_group(path: str):
    def run(codes: pa.Table) -> pa.Table:
        rows = sorted(codes.to_pylist(), key=lambda r: r["chunk_no"])
        values = (rows[0]["doc_id"], *_digest_columns(b"".join(r["ids"] for r in rows), path))
        copies = rows[0]["copies"]
        return pa.table([pa.array([v] * copies, f.type) for v, f in zip(values, _DIGEST, strict=True)], schema=_DIGEST)

    return run


def encode_digest(
    docs: DataFrame,
    ranks_path: str,
    chunk_chars: int = CHUNK_CHARS,
    overlap_chars: int = OVERLAP_CHARS,
    spread_chars: int = SPREAD_CHARS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Per document: number of ids, SHA-256 of the ids (unsigned 32-bit, little-endian) and of the decoded bytes."""
    if not 0 < overlap_chars < chunk_chars:
        raise ValueError("the overlap must be shorter than a chunk")
    texts = texts_of(docs, id_column, text_column)
    is_long = F.char_length("text") > spread_chars
    short = texts.where(~is_long).mapInArrow(_in_one_task(ranks_path, chunk_chars, overlap_chars), _DIGEST_DDL)
    once = texts.where(is_long).groupBy("doc_id", "text").agg(F.count("*").alias("copies"))
    once = once.withColumn("text_key", F.sha2(F.col("text").cast("binary"), 256))
    chunks = once.mapInArrow(_cut(chunk_chars, overlap_chars), _CHUNK_DDL).repartition(*_KEY, "chunk_no")
    owned = chunks.mapInArrow(_pretokenise, _CHUNK_DDL).groupBy(*_KEY).applyInArrow(_stitch_group, _CHUNK_DDL)
    codes = owned.repartition(*_KEY, "chunk_no").mapInArrow(_encode_pieces(ranks_path), _CODE_DDL)
    return short.unionByName(codes.groupBy(*_KEY).applyInArrow(_digest_group(ranks_path), _DIGEST_DDL))
