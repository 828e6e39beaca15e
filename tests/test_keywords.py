"""Keyword tables against plain search."""

import random
import re

import pytest

from gleanery.operators import keywords, search

from .test_scale import plan


def plain(texts, listed, whole_word=False):
    """Hits in list order, the plain way."""
    wanted = {}
    for place, k in sorted((p, (k or "").strip().lower()) for p, k in listed if k and k.strip()):
        wanted.setdefault(k, place)
    out = {}
    for i, text in texts:
        low = (text or "").lower()
        has = lambda k: re.search(rf"(?<!\w){re.escape(k)}(?!\w)", low) if whole_word else k in low
        hits = [k.upper() for k, _ in sorted(wanted.items(), key=lambda x: (x[1], x[0])) if has(k)]
        if hits:
            out[i] = hits
    return out


def cases():
    r = random.Random(4)
    words = ["ab", "abc", "b", "bca", "data", "data lake", "é", "café", "c++", "x_y", "9", "ai"]
    texts = [(i, " ".join(r.choices(words + ["zz", "Mail", "AIR", "a.b"], k=r.randrange(1, 12)))) for i in range(60)]
    texts += [(100, None), (101, ""), (102, "ab" * 5000), (103, "CAFÉ_ ab,abc")]
    listed = [(i % 5, w) for i, w in enumerate(words)] + [(0, " AB "), (9, None), (9, "  "), (3, "not there")]
    return texts, listed


@pytest.mark.parametrize("whole_word", [False, True])
@pytest.mark.parametrize("size", [keywords.AUTOMATON_CHARS, 60])
def test_against_plain_search(spark, monkeypatch, size, whole_word):
    """Also with keywords that need several automata."""
    monkeypatch.setattr(keywords, "AUTOMATON_CHARS", size)
    texts, listed = cases()
    df = spark.createDataFrame(texts, "i int, text string")
    table = spark.createDataFrame(listed, "place bigint, keyword string")
    found = keywords.match_keyword_table(df, "text", table, order="place", whole_word=whole_word)
    assert found.columns == ["i", "text", "matched_keywords"]
    assert {r.i: r.matched_keywords for r in found.collect()} == plain(texts, listed, whole_word)


def test_a_table_finds_what_a_list_finds(spark):
    texts, listed = cases()
    df = spark.createDataFrame(texts, "i int, text string")
    wanted = sorted({k.strip().lower() for _, k in listed if k and k.strip()})
    by_list = search.match_keywords(df, "text", wanted)
    by_table = keywords.match_keyword_table(df, "text", spark.createDataFrame([(k,) for k in wanted], "keyword string"))
    assert sorted(map(str, by_list.collect())) == sorted(map(str, by_table.collect()))


def test_many_keywords_without_a_join(spark):
    table = spark.range(50_000).selectExpr("id as place", "concat('w', id, 'x') as keyword")
    df = spark.createDataFrame([(1, "w7x and W49999X, w50000x"), (2, "none")], "i int, text string")
    found = keywords.match_keyword_table(df, "text", table, order="place")
    assert [(r.i, r.matched_keywords) for r in found.collect()] == [(1, ["W7X", "W49999X"])]
    text = plan(found)
    assert "Join" not in text and "Exchange" not in text


def test_no_keywords(spark):
    df = spark.createDataFrame([(1, "text")], "i int, text string")
    empty = spark.createDataFrame([], "keyword string")
    assert keywords.match_keyword_table(df, "text", empty).collect() == []


@pytest.mark.parametrize("whole_word", [False, True])
def test_a_large_table_is_neither_collected_nor_held_by_a_worker(spark, monkeypatch, whole_word):
    """Phrases, quotes of patterns and signs at word ends, by joins alone."""
    monkeypatch.setattr(keywords, "AUTOMATON_CHARS", 10)
    texts = [(1, "Big DATA\nlake, big data"), (2, r"a\E.b c"), (3, "xbig data"), (4, "c++ and c+"), (5, None), (6, "a  b\ta b"), (7, "é_é é")]
    listed = [(3, "big data"), (2, "data\nlake"), (1, r"a\e.b"), (1, r"\e.b c"), (0, "c++"), (0, "+"), (4, "a b"), (4, "b\ta"), (None, "é"), (7, "not here")]
    df = spark.createDataFrame(texts, "i int, text string")
    found = keywords.match_keyword_table(df, "text", spark.createDataFrame(listed, "place bigint, keyword string"), order="place", whole_word=whole_word)
    known = [(-1 if p is None else p, k) for p, k in listed]
    assert {r.i: r.matched_keywords for r in found.collect()} == plain(texts, known, whole_word)
    assert "Python" not in plan(found)
