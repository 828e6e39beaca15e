import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from gleanery.llm import trie

from .helpers import clashing

DDL = "conv_id long, turn long, role string, text string"
FIELDS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def plain_conversations(rows, tie):
    out = {}
    for c, turn, role, text in sorted((x for x in rows if x[0] is not None), key=lambda x: (x[1] is not None, x[1] or 0, tie(x))):
        out.setdefault(c, []).append((role or "", text or ""))
    return out


def plain_rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - c % 20, [])[:h] + turns[h:]
    return out


def plain_trie(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    rows = []
    for node, inside in members.items():
        below = [x for x in members if x[: len(node)] == node]
        leaves = [x for x in below if not any(y[:-1] == x for y in members if y)]
        saved = sum((len(members[x]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", x[-1][1])) for x in below if x)
        ends = sorted(c for c in inside if len(convs[c]) == len(node))
        children = sum(1 for x in below if len(x) == len(node) + 1)
        parent = min(members[node[:-1]]) if node else None
        sha = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        rows.append((min(inside), len(node), parent, len(inside), children, len(leaves), saved, sha))
    return sorted(rows, key=str)


def some_rows(r, n, longest=7):
    rows = []
    for c in r.sample(range(-5 if n < 40 else 0, 3 * n), n):
        for turn in range(r.randrange(1, longest)):
            rows.append((c, turn, r.choice(["user", "assistant"]) if r.random() < 0.1 else "user", "w " * r.randrange(1, 3)))
    r.shuffle(rows)
    return rows


def found(df):
    rows = df.collect()
    assert df.columns == [*FIELDS, "enter_at", "leave_at"]
    places = sorted(x for r in rows for x in (r.enter_at, r.leave_at))
    assert places == list(range(2 * len(rows)))
    return sorted((tuple(r[c] for c in FIELDS) for r in rows), key=str)


def small_blocks(monkeypatch, block=16, shrinks=0.7):
    monkeypatch.setattr(trie, "BLOCK", block)
    monkeypatch.setattr(trie, "BLOCK_BITS", 3)
    monkeypatch.setattr(trie, "SHRINKS", shrinks)
    for name in ("TURN_BITS", "SIBLING_BITS", "ID_BITS"):
        monkeypatch.setattr(trie, name, 1)


@pytest.mark.parametrize("small", [False, True])
def test_rebuilt_against_plain_trie(spark, monkeypatch, small):
    if small:
        small_blocks(monkeypatch)
    rows = [x for x in some_rows(random.Random(small), 60) if x[0] >= 0]
    out = trie.rebuilt_trie(clashing(spark.createDataFrame(rows, DDL)))
    assert found(out) == plain_trie(plain_rebuilt(plain_conversations(rows, lambda x: 0)))


@pytest.mark.parametrize("shrinks", [0.7, 0.0])
def test_odd_rows(spark, monkeypatch, shrinks):
    """Also with the list ranked by pointer jumping."""
    small_blocks(monkeypatch, 8, shrinks)
    rows = some_rows(random.Random(5), 12)
    rows += [(500, None, "user", "first"), (500, -3, None, None), (501, 0, "us", "er x"), (502, 0, "user", " x"), (None, 0, "user", "x")]
    rows += [(600, 7, "user", "same")] * 9 + [(601, 1, "user", "long " * 30_000), (602, 1, "user", "long " * 30_000)]
    out = trie.conversation_trie(spark.createDataFrame(rows, DDL))
    assert found(out) == plain_trie(plain_conversations(rows, lambda x: 0))


def test_turns_of_one_number_have_one_order(spark):
    rows = [(c, 1, "user", t) for c in (1, 2) for t in ("a", "b", "c")]
    out = trie.conversation_trie(spark.createDataFrame(rows[:3] + rows[:2:-1], DDL)).where("depth = 3")
    assert [r.n_convs for r in out.collect()] == [2]


def test_empty_table(spark):
    assert trie.rebuilt_trie(spark.createDataFrame([], DDL)).collect() == []


@pytest.mark.parametrize("shrinks", [0.7, 0.0])
def test_ranks_of_shuffled_lists(spark, monkeypatch, shrinks):
    small_blocks(monkeypatch, 32, shrinks)
    ids = list(range(300))
    random.Random(2).shuffle(ids)
    chains = [ids[:170], ids[170:299], ids[299:]]
    rows = [(a, b, a) for chain in chains for a, b in zip(chain, [*chain[1:], None])]
    out = trie.suffix_sums(spark.createDataFrame(rows, "id long, next long, v long").withColumn("one", F.lit(1).cast("long")), ["v", "one"])
    expected = [(x, sum(chain[i:]), len(chain) - i) for chain in chains for i, x in enumerate(chain)]
    assert sorted(map(tuple, out.collect())) == sorted(expected)
