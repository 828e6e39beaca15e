"""Searches over the trigram index against the scan."""

import random

import pytest

from gleanery.operators import search, trigrams

from .test_scale import plan

FIELDS = ("title", "article_text")
DDL = "ord bigint, title string, article_text string, language string"


def rows():
    r = random.Random(8)
    words = ["Data", "lake", "datalake", "café", "c++", "a", "x_y", "ÉTÉ", "😀😁", "line\nbreak", "100%", "aaa", "aaaa"]
    out = [(i * 1000 - 5000, " ".join(r.choices(words, k=2)), " ".join(r.choices(words, k=r.randrange(9))), "en") for i in range(150)]
    out += [(1 << 40, None, None, "en"), (1 << 41, "", "data", None), (65535, "ab", "cd", "fr"), (65536, "x", "the end" * 4000, "fr")]
    return out + [(None, "data lake", "data lake", "en")]


NEEDLES = ["data", "DATA LAKE", "lake da", "été", "😀😁", "e\nb", "0% a", "aaaa", "nothing", "c+", "a", "", "endthe end", "the end" * 40]


def plain(needles):
    for n in needles:
        for ord, title, text, _ in rows():
            if ord is not None and any(n.lower() in (x or "").lower() for x in (title, text)):
                yield n, ord


@pytest.fixture
def indexed(spark, tmp_path):
    """The table, and its index, written in two parts of which one comes twice."""
    df = spark.createDataFrame(rows(), DDL)
    folder = str(tmp_path / "index")
    trigrams.write_index(df.where("ord < 20000"), folder, FIELDS)
    for _ in range(2):
        trigrams.write_index(df.where("not ord < 20000"), folder, FIELDS, append=True)
    return df, trigrams.read_index(spark, folder)


def test_against_a_plain_search(indexed):
    df, index = indexed
    found = trigrams.find_texts(df, index, NEEDLES, FIELDS)
    assert found.columns == ["needle", *df.columns]
    assert sorted((r.needle, r.ord) for r in found.collect()) == sorted(plain(NEEDLES))


def test_no_needles_and_no_rows(spark, indexed):
    df, index = indexed
    assert trigrams.find_texts(df, index, [], FIELDS).collect() == []
    none = trigrams.postings(df.limit(0), FIELDS)
    assert none.collect() == []
    assert trigrams.find_texts(df, none, ["data"], FIELDS).collect() == []


@pytest.mark.parametrize("text", ["data", "C+", "été"])
@pytest.mark.parametrize("scope", ["ALL", "TITLE"])
def test_the_same_rows_as_the_article_search(indexed, text, scope):
    df, index = indexed
    df = df.where("ord is not null")
    scan = search.search_articles(df, text=text, search_in=scope, languages="en")
    found = trigrams.search_indexed(df, index, text=text, search_in=scope, languages="en")
    assert sorted(map(str, found.collect())) == sorted(map(str, scan.collect()))


def test_lists_are_bounded(spark):
    df = spark.range(100_000).selectExpr("id as ord", "'every' as title", "null as article_text")
    lists = trigrams.postings(df, FIELDS).where("gram = 'eve'").selectExpr("block", "size(rows) as n").orderBy("block")
    assert [tuple(r) for r in lists.collect()] == [(0, 65536), (1, 100_000 - 65536)]


def test_the_pieces_reach_the_scan_of_the_index(indexed):
    df, index = indexed
    text = plan(trigrams.find_texts(df, index, ["data"], FIELDS))
    assert "PushedFilters: [In(gram, [ata,dat])" in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text
