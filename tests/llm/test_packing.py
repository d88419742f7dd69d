"""Packing against the tokenizer itself, and its bounds against exhaustive search."""

import itertools
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stratamart.llm import packing
from stratamart.llm.common import materialise

PATH = public_tokenizers.path(packing.VOCABULARY)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def word_ids():
    return packing.WordIds(PATH)


ODD = ["", "It's  DON'T\n\n we'll!!", "á e b\tc\r\nd", "ÀÉß Ωσς 漢字 ½ ²³ x², (ok)…", "<|endoftext|> a<|startoftext|>b", "İI ǅ ﬁ", "a.b,c###%%% | || ´ ª º µ"]


@pytest.mark.parametrize("text", ODD)
def test_ids_of_odd_texts(tokenizer, word_ids, text):
    assert np.frombuffer(word_ids.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\t'’ABcdéÖß.,!#|<>0٣́")), max_size=60))
def test_ids_are_the_tokenizers(text):
    whole = packing._tokenizer(PATH).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(packing.WordIds(PATH).encode(text), "<u4").tolist() == whole


def fewest(lengths, capacity):
    best = len(lengths)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for r in sorted(set(rooms)):
            if r >= lengths[i]:
                left = list(rooms)
                left.remove(r)
                place(i + 1, [*left, r - lengths[i]])
        place(i + 1, [*rooms, capacity - lengths[i]])

    place(0, [])
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=8))
def test_bound_and_packing(lengths):
    values = np.array(lengths)
    sequence, offset = packing.best_fit_decreasing(values, 20)
    used = int(sequence.max()) + 1
    assert packing.lower_bound(values, 20) <= fewest(sorted(lengths, reverse=True), 20) <= used
    for s in range(used):
        inside = sorted((o, n) for o, n, q in zip(offset, values, sequence, strict=True) if q == s)
        assert [o for o, _ in inside] == [0, *itertools.accumulate(n for _, n in inside)][:-1]
        assert sum(n for _, n in inside) <= 20


def _expected(pairs, tokenizer, capacity):
    out = []
    for doc, text in pairs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            out.append((doc, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return sorted(out, key=repr)


def _is_gapless(packed, capacity):
    by_sequence = {}
    for r in packed:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for inside in by_sequence.values():
        at = 0
        for offset, length in sorted(inside):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_documents(make_docs, odd_texts, tokenizer):
    packed = packing.pack_documents(make_docs(odd_texts), PATH, 512).collect()
    got = sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed), key=repr)
    assert got == _expected(odd_texts, tokenizer, 512)
    _is_gapless(packed, 512)


def test_rounds_of_exchange_near_the_bound(spark):
    rng = np.random.default_rng(2)
    lengths = np.minimum(rng.geometric(1 / 300, 6000), 1000).tolist()
    rows = materialise(
        spark.createDataFrame([(i, 0, 0, n, 0) for i, n in enumerate(lengths)], packing._PIECE_DDL), "test-pieces"
    )
    packed = packing.pack(rows, 1000, partition_pieces=400).collect()
    assert sorted(r.doc_id for r in packed) == list(range(6000))
    assert _is_gapless(packed, 1000) <= 1.002 * packing.lower_bound(np.array(lengths), 1000)


def test_large_pieces_stop_after_the_last_round(spark):
    rows = materialise(spark.createDataFrame([(i % 3, 0, 0, 340, 7) for i in range(900)], packing._PIECE_DDL), "test-pieces")
    packed = packing.pack(rows, 1000, partition_pieces=50, max_rounds=3).collect()
    assert len(packed) == 900
    assert _is_gapless(packed, 1000) <= 450 + 18


def test_empty_table(make_docs):
    assert packing.pack_documents(make_docs([]), PATH).count() == 0
