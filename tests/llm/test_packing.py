import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from gleanery.llm import packing

from .helpers import clashing, documents

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
TOKENS = packing.Tokens(PATH)


def library(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=50) | st.text(" \n\x0b\x1c'sltdaÀÉ1.,!́İª² <|endoftext|>", max_size=40))
def test_ids_are_those_of_the_library(text):
    assert np.frombuffer(TOKENS.encode(text), "<u4").tolist() == library(text)


def test_characters_and_special_tokens():
    for c in map(chr, [*range(0x300), *range(0x300, 0x30000, 61)]):
        if not 0xD800 <= ord(c) < 0xE000:
            text = f"A{c}b {c}{c} 1{c}2  {c}'s x{c} 's{c}'ll."
            assert np.frombuffer(TOKENS.encode(text), "<u4").tolist() == library(text)
    text = "one <|endoftext|> two<|startoftext|>"
    assert np.frombuffer(TOKENS.encode(text), "<u4").tolist() == library(text)


def fewest(sizes, capacity):
    """Bins of the best packing, by trying all ways."""
    best = len(sizes)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(sizes):
            best = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= sizes[i]:
                place(i + 1, [*rooms[:k], rooms[k] - sizes[i], *rooms[k + 1 :]])
        place(i + 1, [*rooms, capacity - sizes[i]])

    place(0, [])
    return best


@pytest.mark.parametrize("seed", range(80))
def test_bound_never_exceeds_the_best_packing(seed):
    r = random.Random(seed)
    capacity = r.choice([10, 24, 100])
    sizes = np.array([r.randint(1, capacity) for _ in range(r.randint(1, 8))])
    best = fewest(sorted(sizes.tolist(), reverse=True), capacity)
    bound = packing.lower_bound(sizes, capacity)
    _, _, fill = packing.best_fit_decreasing(sizes, capacity)
    assert -(-sizes.sum() // capacity) <= bound <= best <= len(fill)


def test_bound_beats_the_sum():
    assert packing.lower_bound(np.array([51] * 10), 100) == 10
    assert packing.lower_bound(np.array([34] * 9), 100) == 5
    assert packing.lower_bound(np.array([], int), 100) == 0


@pytest.mark.parametrize("seed", range(20))
def test_best_fit(seed):
    r = random.Random(seed)
    sizes = np.array([r.randint(1, 60) for _ in range(200)])
    bins, offsets, fill = packing.best_fit_decreasing(sizes, 64)
    # The plain way: the fullest bin that takes the item.
    rooms = []
    for size in sorted(sizes.tolist(), reverse=True):
        fitting = [k for k in range(len(rooms)) if rooms[k] >= size]
        if fitting:
            rooms[min(fitting, key=lambda k: rooms[k])] -= size
        else:
            rooms.append(64 - size)
    assert len(fill) == len(rooms) and fill.max() <= 64
    check_places(zip(bins.tolist(), offsets.tolist(), sizes.tolist()), 64)


def check_places(rows, capacity):
    by = defaultdict(list)
    for bin_, offset, size in rows:
        by[bin_].append((offset, size))
    for places in by.values():
        places.sort()
        ends = [0, *itertools.accumulate(s for _, s in places)]
        assert [o for o, _ in places] == ends[:-1] and ends[-1] <= capacity


@pytest.mark.parametrize("group", [packing.GROUP, 15])
def test_documents(spark, group):
    r = random.Random(7)
    words = "the of and token sequence packing words".split()
    rows = [(i, " ".join(r.choices(words, k=r.randint(1, 90)))) for i in range(150)]
    rows += [(150, None), (151, ""), (None, "one"), (3, rows[3][1]), (152, "word " * 5000)]
    out = packing.best_fit_packing(clashing(documents(spark, rows)), PATH, capacity=64, group=group).collect()
    expected = []
    for i, text in rows:
        ids = library(text or "") + [0]
        for k, at in enumerate(range(0, len(ids), 64)):
            piece = ids[at : at + 64]
            expected.append((i, k, at, len(piece), zlib.crc32(np.array(piece, "<u4").tobytes())))
    assert sorted([tuple(x)[:5] for x in out], key=str) == sorted(expected, key=str)
    check_places([(x.sequence_id, x.offset, x.length) for x in out], 64)
    bound = packing.lower_bound(np.array([x.length for x in out]), 64)
    assert len({x.sequence_id for x in out}) <= (1.03 if group == packing.GROUP else 1.2) * bound + 1


def test_gaps_are_repacked(spark):
    """Packed apart, the halves leave room that only the other partition's pieces fill."""
    rows = [(i, "a " * 32) for i in range(40)] + [(100 + i, "a " * 30) for i in range(40)]
    out = packing.best_fit_packing(documents(spark, rows), PATH, capacity=64, group=8, rounds=6).collect()
    check_places([(x.sequence_id, x.offset, x.length) for x in out], 64)
    assert len(out) == 80 and len({x.sequence_id for x in out}) <= 48


def test_empty_table(spark):
    assert packing.best_fit_packing(documents(spark, [(1, "x")]).limit(0), PATH).collect() == []
