import hashlib
import random
import re
import time
import zlib
from fractions import Fraction

import numpy as np
import pytest

from gleanery.llm import runs

from .helpers import clashing, documents


def plain_runs(words, least=24, exponent=3):
    """Every maximal stretch of every period, the smallest period of each kept."""
    n, found = len(words), {}
    for p in range(1, n // exponent + 1):
        i = p
        while i < n:
            if words[i] != words[i - p]:
                i += 1
                continue
            j = i
            while j < n and words[j] == words[j - p]:
                j += 1
            if j - i + p >= max(least, exponent * p):
                found.setdefault((i - p, j), p)
            i = j
    return sorted((a, b - a, p) for (a, b), p in found.items())


def some_words(r):
    kind = r.randrange(6)
    if kind == 0:
        return [r.randrange(r.choice([1, 2, 3])) for _ in range(r.randrange(200))]
    if kind == 1:  # Fibonacci words hold many cubes
        a, b = [0], [0, 1]
        while len(b) < 400:
            a, b = b, b + a
        return b[: r.randrange(400)]
    if kind == 2:
        return [bin(i).count("1") % 2 for i in range(r.randrange(400))]
    out = []
    while len(out) < 400:
        unit = [r.randrange(r.choice([2, 50])) for _ in range(r.randrange(1, 60))]
        out += (unit * r.randrange(1, 9))[: r.randrange(1, 300)]
    return out


@pytest.mark.parametrize("seed", range(60))
def test_against_all_periods(seed):
    r = random.Random(seed)
    words = some_words(r)
    least, exponent = r.choice([(24, 3), (6, 3), (1, 3), (30, 4)])
    assert runs.find_runs(np.array(words, np.int64), least, exponent) == plain_runs(words, least, exponent)


@pytest.mark.parametrize("seed", range(20))
def test_word_by_word_equals_all_at_once(seed):
    r = random.Random(seed)
    words = some_words(r)
    catchers = runs.SquareCatchers(6, 3, 2)
    while words:
        n = r.choice([1, 1, 2, 30])
        catchers.append(np.array(words[:n], np.int64))
        words = words[n:]
    assert catchers.finish() == plain_runs(catchers.words[: catchers.n].tolist(), 6, 3)


def test_squares_are_reported_while_words_come():
    catchers = runs.SquareCatchers()
    catchers.append(np.arange(100))
    catchers.append(np.tile(np.arange(8), 3))
    assert catchers.runs == {(100, 8): 124}
    catchers.append(np.arange(5))
    assert catchers.runs == {(100, 8): 129}


@pytest.mark.parametrize("make", [lambda n: np.zeros(n), lambda n: np.arange(n) % 2, lambda n: np.arange(n) % (n // 3), lambda n: np.arange(n)])
def test_long_sequences_take_little_time(make):
    n = 600_000
    start = time.time()
    found = runs.find_runs(make(n).astype(np.int64))
    assert time.time() - start < 20 and len(found) == (make is not None and int(len(np.unique(make(n))) < n))


def planted(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is None or n == 0:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def plain_row(doc_id, text):
    words = planted(doc_id, text)
    found = plain_runs(words)
    gone = {i for a, n, p in found for i in range(a + p, a + n)}
    best = min(found, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        sha("".join(f"{a},{n},{p}\n" for a, n, p in found)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def test_report_against_plain_rows(spark):
    r = random.Random(3)
    rows = [(i, " ".join(f"w{x}" for x in some_words(r))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, " \t\n "), (203, "é\xa0x\x85 " * 30), (204, "a b\x0bc\n" * 9), (None, "a " * 24), (205, "a " * 23)]
    rows += [(206, "x " * 3000), (5, rows[5][1]), (5, "other " * 40), (-7, "b c " * 20)]
    out = runs.runs_report(runs.periodic_runs(runs.with_planted_runs(clashing(documents(spark, rows)))))
    assert out.columns == "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()
    assert sorted(map(tuple, out.collect()), key=str) == sorted((plain_row(*x) for x in rows), key=str)
    assert runs.runs_report(runs.periodic_runs(documents(spark, rows).limit(0))).collect() == []


def test_real_output(spark):
    text = "start " + "one two three " * 9 + "end"
    row = runs.periodic_runs(documents(spark, [(1, text)])).first()
    assert [tuple(x) for x in row.runs] == [(1, 27, 3)] and row.collapsed == "start one two three end" and row.n_words == 29
