"""Byte-level BPE in chunks against the library on whole texts."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stratamart.llm import bpe

PATH = public_tokenizers.path(bpe.RANKS)


def expected(pairs):
    encoding = bpe._encoding(PATH)
    out = []
    for doc, text in pairs:
        ids = encoding.encode_ordinary(text or "")
        out.append(
            (doc, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
        )
    return sorted(out, key=repr)


PIECES = [" ", "  ", "\n", "\n\n ", "a", "bc", "é", "漢", "\U0001f600", "12", "!?", "'s", "'", "\t", " word", "<|endoftext|>", " "]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=60), st.integers(3, 20), st.integers(1, 2))
def test_stitched_boundaries_are_those_of_the_whole_text(parts, chunk, overlap):
    text = "".join(parts)
    chunks = [(s, t, bpe.piece_ends(t)) for s, t in bpe.split_text(text, chunk, overlap)]
    at, ends = 0, []
    for owned, own_ends in bpe.stitch(chunks):
        ends += [at + e for e in own_ends]
        at += len(owned)
    assert at == len(text)
    assert ends == bpe.piece_ends(text)


@pytest.mark.parametrize("sizes", [(64, 8, 1_000), (64, 8, 10**9), (4096, 256, 0), (bpe.CHUNK_CHARS, bpe.OVERLAP_CHARS)])
def test_documents(make_docs, odd_texts, sizes):
    pairs = [*odd_texts, (30, "x" * 9_000), (31, " " * 3_000 + "y" + "\n" * 2_000), (31, " " * 3_000 + "y" + "\n" * 2_000), (None, "né " * 5_000)]
    got = bpe.encode_digest(make_docs(pairs), PATH, *sizes)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected(pairs)


def test_usual_documents_are_stitched(spark):
    """A good part of the given documents has several chunks; all give what the library does."""
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    stitched = 0
    for r in rows:
        chunks = bpe.split_text(r.text, bpe.CHUNK_CHARS, bpe.OVERLAP_CHARS)
        stitched += len(chunks) > 1
        assert bpe.pieces(r.text) == bpe._pattern().findall(r.text)
    assert stitched > len(rows) / 10
    got = bpe.encode_digest(spark.createDataFrame(rows), PATH).collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected([(r.doc_id, r.text) for r in rows])


def test_decoding_is_the_text():
    text = "".join(PIECES) * 3
    assert bpe.decode(bpe._encoding(PATH).encode_ordinary(text), PATH) == text.encode()


def test_empty_table_and_bad_sizes(make_docs):
    assert bpe.encode_digest(make_docs([]), PATH).count() == 0
    with pytest.raises(ValueError, match="overlap"):
        bpe.encode_digest(make_docs([]), PATH, 10, 10)
