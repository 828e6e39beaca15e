import random
import re

import numpy as np
import pytest

from gleanery.llm import minhash

from .helpers import Sets, clashing, documents

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def plain_set(text, width):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(LOWER))
    if 0 < len(words) < width:
        return {tuple(words)}
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set()


def plain(rows, width, per_cent):
    found, sets = [(i, plain_set(t, width)) for i, t in rows], Sets()
    for i, a in found:
        for j, b in found:
            if a and b and i is not None and j is not None and 100 * len(a & b) >= per_cent * len(a | b):
                sets.join(i, j)
    out = [(i, len(s), i if i is None else sets.root(i)) for i, s in found]
    return sorted([(i, n, c, i == c) for i, n, c in out], key=str)


def near_copies(seed, n=60):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, i = [], 0
    for _ in range(6):
        base = r.choices(vocabulary, k=r.choice([8, 60, 150]))
        for _ in range(n // 6):
            copy = list(base)
            for _ in range(r.choice([0, 1, 2, 4, 8])):
                copy[r.randrange(len(copy))] = r.choice(vocabulary)
            rows.append((i, " ".join(copy)))
            i += 1
    r.shuffle(rows)
    return rows


def found(spark, rows, width, per_cent):
    out = minhash.near_duplicates(clashing(documents(spark, rows)), width, per_cent)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted((tuple(r) for r in out.collect()), key=str)


@pytest.mark.parametrize("width, per_cent, block", [(3, 85, minhash.BLOCK), (5, 80, minhash.BLOCK), (3, 85, 300)])
def test_against_all_pairs(spark, monkeypatch, width, per_cent, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rows = near_copies(width)
    assert found(spark, rows, width, per_cent) == plain(rows, width, per_cent)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "One  TWO"), (6, "one"), (7, "É two three"), (8, "é two three"),
            (9, "a b c d"), (10, "a b c d"), (10, "a b c d"), (None, "a b c d"), (11, "x " * 50_000), (12, "x x x x"), (13, "a\x1cb c d"),
            (14, "a\xa0b c d")]
    assert found(spark, rows, 3, 85) == plain(rows, 3, 85)
    assert found(spark, [], 3, 85) == []


def test_rows_that_share_a_doc_id_keep_their_own_classes(spark):
    a, b, c = ("".join(f"{x}{i} " for i in range(40)) for x in "abc")
    rows = [(1, a), (1, b), (2, c), (3, b), (4, b.upper()), (5, a + "more"), (1, a)]
    expected = [(1, 38, 1, True)] * 3 + [(2, 38, 2, True), (3, 38, 1, False), (4, 38, 1, False), (5, 39, 1, False)]
    for _ in range(2):
        assert found(spark, rows, 3, 85) == sorted(expected, key=str)


@pytest.mark.parametrize("similarity", [0.8, 0.85, 0.95])
def test_every_pair_within_the_distance_shares_a_key(similarity):
    signer = minhash.Signer(similarity)
    rng = np.random.default_rng(1)
    n = signer.size * signer.chunks
    a = rng.integers(0, 2**16, (500, n)).astype(np.uint16)
    b = a.copy()
    for row in b:
        row[rng.choice(n, 2 * signer.chunks - 1, replace=False)] ^= np.uint16(1)
    assert (signer.keys(a) == signer.keys(b)).any(axis=1).all()


def test_symbols_agree_as_often_as_the_sets_do():
    signer = minhash.Signer(0.85)
    rng = np.random.default_rng(3)
    agree = []
    for _ in range(150):
        common = rng.integers(0, 2**64, 85, dtype=np.uint64)
        more = rng.integers(0, 2**64, (2, 15), dtype=np.uint64)
        agree.append((signer.signature(np.r_[common, more[0, :8]]) == signer.signature(np.r_[common, more[1, :7]])).mean())
    assert abs(np.mean(agree) - 0.85) < 0.02
