"""Periodic runs against brute force over all periods, whole and at every appended word."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stratamart.llm.common import importable, table
from stratamart.llm.periodicity import Catchers, collapse, find_runs, periodic_runs, words_of
from stratamart.llm.queries import QUERIES

SPACE = " \t\n\x0b\x0c\r"


def plain_runs(words, least=24):
    """Every stretch in which words one period apart agree, for every period."""
    found, n = {}, len(words)
    for period in range(1, n // 3 + 1):
        at = 0
        while at + period < n:
            if words[at] != words[at + period]:
                at += 1
                continue
            start = at
            while at + period < n and words[at] == words[at + period]:
                at += 1
            if at + period - start >= max(least, 3 * period):
                found.setdefault((start, at + period), period)
    return sorted(((s, e - s, p) for (s, e), p in found.items()), key=lambda r: (r[0], r[2]))


def planted(seed, letters):
    """Words of a small alphabet with repeated stretches put in."""
    rng = random.Random(seed)
    words = [rng.randrange(letters) for _ in range(rng.randrange(200))]
    for _ in range(rng.randrange(5)):
        period = rng.randint(1, 40)
        unit = words[:period] if rng.random() < 0.5 else [rng.randrange(letters) for _ in range(period)]
        at = rng.randint(0, len(words))
        words[at:at] = unit * rng.randint(1, 6) + unit[: rng.randint(0, 9)]
    return words


@pytest.mark.parametrize("letters", [1, 2, 3])
def test_runs_are_those_of_brute_force(letters):
    for seed in range(120):
        words = planted(seed, letters)
        for least in (24, 5):
            assert find_runs(words, least) == plain_runs(words, least)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 1), max_size=90), st.integers(3, 30), st.integers(1, 20))
def test_any_pace_of_appending_gives_the_same(words, least, step):
    assert find_runs(words, least, step) == plain_runs(words, least)


def test_runs_are_known_at_every_appended_word():
    words = [1, 2, 3] * 20 + [5] + [1] * 30 + [2, 1] * 30 + [1, 2, 3] * 9
    catchers = Catchers()
    for n, word in enumerate(words, 1):
        catchers.append(np.array([word]))
        assert catchers.runs() == plain_runs(words[:n])


def test_memory_stays_in_proportion():
    catchers = Catchers()
    for start in range(0, 400_000, 50_000):
        catchers.append(np.arange(start, start + 50_000))
        assert sum(len(level.prints) for level in catchers._levels) <= 4 * catchers._size
    assert catchers.runs() == []


def test_long_and_hostile_texts():
    n = 60_000
    assert find_runs([0] * n) == [(0, n, 1)]
    runs = find_runs(([0] * 24 + [1]) * (n // 25))
    assert (0, n, 25) in runs and len(runs) == n // 25 + 1
    assert find_runs(list(range(n))) == []


def test_collapse_keeps_the_first_period():
    words = list("abc") * 9 + list("xyz")
    assert "".join(collapse(words, find_runs(words))) == "abcxyz"


def test_words_are_split_at_ascii_space_only():
    assert words_of(f"a{SPACE}b c d \x1c") == ["a".encode(), "b c d".encode(), b"\x1c"]


def digest_of(doc_id, text):
    """The query's row, plainly."""
    words = words_of(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None, None, None)
    listed = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
    dropped = {i for s, length, p in runs for i in range(s + p, s + length)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    milli = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, milli, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_query_is_brute_force_on_the_given_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = [r for r in table(spark, folder, "documents").select("doc_id", "text").collect()]
    got = {tuple(r) for r in QUERIES["op12_periodic_runs"](spark, folder).collect()}
    short = {digest_of(r["doc_id"], r["text"]) for r in docs if len((r["text"] or "").split()) < 1500}
    assert len(got) == len(docs) and short <= got and len(short) > 150
    assert sum(1 for row in got if row[1]) > 5


def test_odd_rows(spark, odd_texts, make_docs):
    importable(spark)
    looped = "one two three " * 12
    found = periodic_runs(make_docs([*odd_texts, (10, looped), (10, looped)]))
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) == len(odd_texts) + 2
    by_id = {}
    for doc_id, n, runs, text in rows:
        by_id.setdefault(doc_id, []).append((n, [tuple(r) for r in runs], text))
    assert by_id[1] == by_id[2] == by_id[3] == [(0, [], "")]
    assert by_id[10] == [(36, [(0, 36, 3)], "one two three")] * 2
    assert by_id[6][0] == by_id[6][1] and len(by_id[None]) == 1
    assert periodic_runs(make_docs([])).collect() == []
