import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from gleanery.llm import bpe

from .helpers import clashing, documents

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
RANKS = bpe.load_ranks(PATH)
CODEC = bpe.Codec(RANKS, PATTERN)
LIBRARY = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})


def ids(data):
    return np.frombuffer(data, "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    assert ids(CODEC.encode([text])[0]) == LIBRARY.encode_ordinary(text)
    assert CODEC.decode(CODEC.encode([text])[0]) == text.encode()


@settings(max_examples=200, deadline=None)
@given(st.text(" \n\t'sdabé1. 　", max_size=40))
def test_white_space_and_contractions(text):
    assert ids(CODEC.encode([text])[0]) == LIBRARY.encode_ordinary(text)


def test_every_kind_of_character():
    for start in range(0, 0x30000, 97):
        if not 0xD800 <= start < 0xE000:
            c = chr(start)
            text = f"a{c}b {c}{c} 1{c}2  {c}x{c}"
            assert ids(CODEC.encode([text])[0]) == LIBRARY.encode_ordinary(text)


@pytest.mark.parametrize("letters", ["a", "ab", "abcdefgé", "the and ing".replace(" ", "")])
def test_long_pre_tokens(letters):
    r = random.Random(1)
    word = "".join(r.choices(letters, k=1500))
    assert CODEC.merge(word.encode()) == LIBRARY.encode_ordinary(word)
    assert len(CODEC.merge((word * 100).encode())) > 1000


def test_many_words_through_one_queue_equal_each_alone():
    r = random.Random(2)
    words = ["".join(r.choices("aabbcdeinrst", k=r.randint(1, 30))).encode() for _ in range(3000)] + [b"aaaa" * 10]
    single = [CODEC.merge(w) for w in words]
    assert [ids(x) for x in CODEC.merge_many(words)] == single


def test_the_queue_gives_ranks_in_order():
    queue, r = bpe.RankQueue(50_256), random.Random(3)
    held = set()
    for _ in range(3000):
        rank = r.randrange(50_256)
        queue.bucket(rank).append(1)
        held.add(rank)
        if r.random() < 0.6:
            assert queue.first() == min(held)
            queue.remove(min(held))
            held.discard(min(held))
    while held:
        queue.remove(queue.first())
        held.discard(min(held))
    assert queue.first() == -1


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    own = bpe.Codec(RANKS, PATTERN)
    texts = ["one two three four", "four five six", "one two " + "x" * 500, "six seven one"]
    for _ in range(3):
        assert [ids(x) for x in own.encode(texts)] == [LIBRARY.encode_ordinary(t) for t in texts]


def test_documents(spark):
    rows = [(1, "Hello there, world!"), (2, None), (3, ""), (3, ""), (None, "x" * 30_000), (5, "<|endoftext|> é 日本")]
    out = [tuple(r) for r in bpe.encode_report(clashing(documents(spark, rows)), PATH, PATTERN).collect()]
    expected = []
    for i, text in rows:
        own = LIBRARY.encode_ordinary(text or "")
        expected.append((i, len(own), _sha(np.array(own, "<u4").tobytes()), _sha((text or "").encode())))
    assert sorted(out, key=str) == sorted(expected, key=str)
    assert bpe.encode_report(documents(spark, rows).limit(0), PATH, PATTERN).collect() == []


def _sha(data):
    return hashlib.sha256(data).hexdigest()
