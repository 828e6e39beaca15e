import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from gleanery.llm import repeats

from .helpers import clashing, documents


def plain_starts(texts, copies, length):
    counts = Counter()
    for text, n in zip(texts, copies):
        for i in range(len(text) - length + 1):
            counts[text[i : i + length]] += n
    return [[i for i in range(len(t) - length + 1) if counts[t[i : i + length]] > 1] for t in texts]


def plain_removal(texts, length):
    out = []
    for text, starts in zip(texts, plain_starts(texts, [1] * len(texts), length)):
        gone = np.zeros(len(text) + 1, bool)
        for i in starts:
            gone[i : i + length] = True
        kept = bytes(b for b, g in zip(text, gone) if not g)
        spans = int((np.diff(np.r_[0, gone[: len(text)].astype(int)]) == 1).sum())
        out.append((len(text), int(gone.sum()), spans, kept))
    return out


def some_texts(r, alphabet, n):
    base = [bytes(r.choices(alphabet, k=r.randint(1, 60))) for _ in range(3)]
    cut = lambda: r.choice(base)[r.randint(0, 5) : r.randint(5, 60)]
    return [b"".join(cut() for _ in range(r.randint(1, 3))) for _ in range(n)]


@pytest.mark.parametrize("seed", range(60))
def test_index_finds_what_counting_finds(seed):
    r = random.Random(seed)
    length = r.choice([2, 3, 5, 8, 17])
    alphabet = r.sample([0, 1, 97, 98, 254, 255], r.choice([1, 2, 3]))
    texts = list({t for t in some_texts(r, alphabet, r.randint(1, 9)) if len(t) >= length})
    if texts:
        copies = [r.choice([1, 1, 1, 2]) for _ in texts]
        found = repeats.repeated_starts(texts, copies, length)
        assert [[i for a, b in x.tolist() for i in range(a, b)] for x in found] == plain_starts(texts, copies, length)


def test_runs_are_compressed():
    index = repeats.RunIndex([b"abcdefgh" * 20 + bytes([i]) for i in range(20)])
    assert len(index.chars) < len(index.words) / 4


@pytest.mark.parametrize("seed", range(30))
def test_contexts_cover_every_string_once_and_equal_strings_share_keys(seed):
    r = random.Random(seed)
    texts = some_texts(r, b"ab" if seed % 2 else b"abcdefgh", 6)
    text, at, count, key, own = repeats.contexts_of(texts, 16)
    strings = [(t, i, k) for t, a, n, k in zip(text, at, count, key) for i in range(a, a + n)]
    assert sorted((t, i) for t, i, _ in strings) == [(t, i) for t, x in enumerate(texts) for i in range(len(x) - 15)]
    by_content = {}
    for t, i, k in strings:
        assert by_content.setdefault(texts[t][i : i + 16], k) == k
    for t, a, n, repeat in zip(text, at, count, own):
        inside = [texts[t][i : i + 16] for i in range(a, a + n)]
        assert repeat or len(set(inside)) == len(inside)


def rows_of(df):
    return sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in df.collect())


def cases():
    r = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz é"
    passage = "".join(r.choices(letters, k=40))
    other = lambda n: "".join(r.choices(letters, k=n))
    texts = [other(90) + passage + other(50) for _ in range(25)]
    texts += [None, "", "short", "xy" * 3000, other(400), texts[0], texts[0], "é" * 30, passage]
    return [(i, t) for i, t in enumerate(texts)] + [(3, texts[3])]


@pytest.mark.parametrize("index_bytes", [repeats.INDEX_BYTES, 300, 0])
def test_removal_against_counting(spark, monkeypatch, index_bytes):
    """Also where keys have too many contexts for an index and are settled string by string."""
    monkeypatch.setattr(repeats, "INDEX_BYTES", index_bytes)
    rows = cases()
    expected = plain_removal([(t or "").encode() for _, t in rows], 20)
    found = repeats.remove_repeats(clashing(documents(spark, rows)), 20)
    assert rows_of(found) == sorted((i, *x) for (i, _), x in zip(rows, expected))


def test_whole_characters(spark):
    rows = [(1, "x" + "é" * 15), (2, "y" + "é" * 15), (3, "é" * 10 + "aê" * 20), (4, "ê" + "é" * 10 + "bê" * 20)]
    found = repeats.remove_repeats(documents(spark, rows), 11, keep=("source",), whole_characters=True).collect()
    for row in found:
        bytes(row.kept).decode()
        assert row.source == "s" and row.n_removed + len(row.kept) == row.n_bytes


def test_empty_table_and_null_id(spark):
    docs = documents(spark, [(None, "abcdefghijklmnop" * 2), (1, None)])
    assert repeats.remove_repeats(docs.limit(0), 8).collect() == []
    out = {r.doc_id: r for r in repeats.repeats_report(docs, 16).collect()}
    assert out[None].n_removed == 32 and out[1].n_bytes == 0
    assert out[1].kept_sha256 == hashlib.sha256(b"").hexdigest()


def test_indexes_stay_small(monkeypatch):
    """Keys are gathered up to an index's size and never beyond it; only a key that has more makes a larger index."""
    sizes = []
    monkeypatch.setattr(repeats, "repeated_starts", lambda texts, copies, length: sizes.append(sum(map(len, texts))) or [()] * len(texts))
    monkeypatch.setattr(repeats, "INDEX_BYTES", 100_000)
    keys = [key for key, n in enumerate((3, 3, 3, 12, 1, 3)) for _ in range(n)]
    columns = [keys, range(len(keys)), range(len(keys)), [1] * len(keys), [bytes(20_000)] * len(keys)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "c1", "c2", "copies", "context"])
    list(repeats._index_batches(iter([batch.slice(i, 4) for i in range(0, len(keys), 4)]), 240))
    assert sizes == [60_000, 60_000, 60_000, 240_000, 80_000]


def test_report_shows_what_remains(spark):
    """A passage of 60 words goes from both texts, the rest stays; a character of which a string covers a part becomes U+FFFD."""
    r = random.Random(4)
    other = lambda n: " ".join("".join(r.choices("abcdefghij", k=8)) for _ in range(n))
    passage = other(60)
    around = [(f"{other(20)}{i}", f"{i}{other(20)}") for i in range(2)]
    rows = [(i, f"{a}{passage}{b}") for i, (a, b) in enumerate(around)] + [(2, other(100)), (3, None)]
    rows += [(4, "é" + "x" * 399 + "y"), (5, "ĩ" + "x" * 399 + "z")]  # é and ĩ end with the same byte
    out = {x.doc_id: x for x in repeats.repeats_report(documents(spark, rows)).collect()}
    for i, (a, b) in enumerate(around):
        assert out[i].text == f"{a}{b}" and out[i].n_bytes == len(rows[i][1]) and out[i].n_removed == len(passage)
    assert out[2].text == rows[2][1] and out[3].text == ""
    assert out[4].text == "�y" and out[4].kept_sha256 == hashlib.sha256(b"\xc3y").hexdigest()
    assert out[5].text == "�z" and out[5].kept_sha256 == hashlib.sha256(b"\xc4z").hexdigest()
