"""SimHash groups against brute force."""

import random

import numpy as np
import pytest
import xxhash

from stratamart.llm import simhash
from stratamart.llm.components import connected_components


def plain_fingerprint(text):
    words, current = [], bytearray()
    for byte in (text or "").encode():
        if byte == 0x20 or 9 <= byte <= 13:
            if current:
                words.append(bytes(current))
            current = bytearray()
        else:
            current.append(byte + 32 if 65 <= byte <= 90 else byte)
    if current:
        words.append(bytes(current))
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(pairs, radius=2):
    prints = [plain_fingerprint(t) for _, t in pairs]
    owner = list(range(len(pairs)))
    for i in range(len(pairs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius and owner[i] != owner[j]:
                old, new = owner[i], owner[j]
                owner = [new if o == old else o for o in owner]
    least = {}
    for (doc, _), o in zip(pairs, owner, strict=True):
        if doc is not None:
            least[o] = min(doc, least.get(o, doc))
    return sorted(
        ((d, f"{p:016x}", least.get(o)) for (d, _), p, o in zip(pairs, prints, owner, strict=True)), key=repr
    )


def test_odd_rows(make_docs, odd_texts, rows):
    assert rows(simhash.near_duplicates(make_docs(odd_texts))) == plain_components(odd_texts)


def test_near_copies(make_docs, rows):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    pairs = []
    for base in range(25):
        text = rng.choices(vocabulary, k=rng.choice([5, 40, 200]))
        for copy in range(rng.choice([1, 1, 4, 12])):
            changed = list(text)
            for _ in range(copy % 3):
                changed[rng.randrange(len(changed))] = rng.choice(vocabulary)
            pairs.append((len(pairs) * 3 + base % 2, " ".join(changed)))
    assert rows(simhash.near_duplicates(make_docs(pairs))) == plain_components(pairs)


def test_empty_table(make_docs):
    assert simhash.near_duplicates(make_docs([])).count() == 0


def _components_of(values, radius):
    owner = {v: v for v in values}
    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= radius and owner[a] != owner[b]:
                old, new = owner[a], owner[b]
                owner = {k: new if o == old else o for k, o in owner.items()}
    groups = {}
    for v, o in owner.items():
        groups.setdefault(o, set()).add(v)
    return sorted(map(sorted, groups.values()))


@pytest.mark.parametrize("block", [4, 4096])
def test_links_connect_exactly_what_is_near(spark, block):
    """Fingerprints crowded around few centres, so that part values are shared and blocks are cut."""
    rng = random.Random(3)
    centres = [rng.getrandbits(64) for _ in range(6)]
    values = set(centres)
    for _ in range(220):
        value = rng.choice(centres)
        for _ in range(rng.randrange(7)):
            value ^= 1 << rng.randrange(64)
        values.add(value)
    values = sorted(values)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    table = spark.createDataFrame([(v,) for v in signed], "fp long")
    found = simhash.fingerprint_links(table, block=block).collect()
    unsigned = lambda v: v % (1 << 64)
    assert all((unsigned(r.a) ^ unsigned(r.b)).bit_count() <= 64 for r in found)
    groups = {v: {v} for v in values}
    for r in found:
        a, b = groups[unsigned(r.a)], groups[unsigned(r.b)]
        if a is not b:
            a |= b
            for v in b:
                groups[v] = a
    assert sorted(map(sorted, {id(g): g for g in groups.values()}.values())) == _components_of(values, 2)


def test_thresholds_obey_the_pigeonhole():
    rng = np.random.default_rng(1)
    sample = rng.integers(0, 2**63, 500, dtype=np.uint64)
    for n_rows in (500, 10**9):
        parts = simhash.fit_parts(sample, n_rows)
        assert sorted(np.concatenate(parts.bits).tolist()) == list(range(64))
        thresholds, _ = parts.allocate(sample)
        assert (thresholds >= -1).all()
        assert ((thresholds + 1).sum(1) == 3).all()


def test_components_of_long_chains(spark, rows):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (200, 200)]
    got = dict(rows(connected_components(spark.createDataFrame(chain, "a long, b long"))))
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 103: 100}
