"""Scalar and array functions on hand-made values."""

from pyspark.sql import functions as F

from gleanery.functions import arrays, dates, numbers, text, urls


def test_collapse_and_csv_safe(each):
    raw = ["  a \t b\r\nc ", "x  y z", "﻿a﻿ b", None, "a\x1cb"]
    assert each(text.collapse, raw)[:2] == ["a b c", "x y z"]
    assert each(text.csv_safe, raw) == ["a b c", "x y z", "a b", "", "a b"]


def test_content_lines(each):
    got = each(lambda c: text.content_lines(c, " -*•\t"), ["a\r\n - b *\rc\n\n• ", ""], "string")
    assert got == [["a", "b", "c", "", ""], [""]]


def test_plain_text_decodes_after_tags(each):
    raw = ["<p>a&nbsp;b</p>&eacute;", "&lt;b&gt; kept", "a &amp;amp; b", None, "1 < 2 > 1"]
    assert each(text.plain_text, raw) == ["a b é", "<b> kept", "a &amp; b", "", "1 < 2 > 1"]
    signs = ["p < 5 for ai and x > 3", "<p>a</p><script>if (a<b) c()</script>b<!-- c --><style>d</style>", "x <b"]
    assert each(text.plain_text, signs) == ["p < 5 for ai and x > 3", "a b", "x <b"]


def test_plain_text_basic_entities(each):
    assert each(lambda c: text.plain_text(c, False), ["<i>a</i>&amp;lt;&#39;"]) == ["a &lt;'"]


def test_article_clean(each):
    raw = ["a  \n\n\n\nb  c", "x Ây", "<p>one</p><p>two</p>", "a < b", None]
    assert each(text.article_clean, raw) == ["a\n\nb c", "x y", "one\ntwo", "a < b", ""]
    assert each(lambda c: text.article_clean(c, fix_mojibake=False), ["Âge"]) == ["Âge"]


def test_press_text(each):
    assert each(text.press_text, [" so­ft word ", None]) == ["soft word", None]


def test_iso_date(each):
    raw = ["1/2/2024", " 12/31/99 ", "1/2/68", "1/2/69", "2024-3-4", "13/1/2024", "x"]
    want = ["2024-01-02", "1999-12-31", "2068-01-02", "1969-01-02", "2024-03-04", "13/1/2024", "x"]
    assert each(dates.iso_date, raw) == want


def test_first_short_date(each):
    assert each(dates.first_short_date, ["on 3/4/2024, 5/6/2024", "3/4/20245", "none"]) == [
        "2024-03-04",
        None,
        None,
    ]


def test_parse_year_formats_and_fallback(each):
    raw = [
        "2024-05-06",
        "2024/05/06",
        "6 May 2024",
        "6 December 2024",
        "Mon, 06 May 2024 10:00:00 +0200",
        "Mon, 06 May 2024 10:00:00 GMT",
        "2024-05-06T10:00:00Z",
        "2024-12-31T23:59:59-0500",
        "06/05/2024",
        "Published 2024 May 1999",
        "1899 then 2101 then 2000",
        "32 May 2024",
        "12 May 1850",
        "2024-13-01",
        "soon",
        "",
    ]
    want = [2024] * 10 + [2000, 2024, 1850, None, None, None]
    assert each(dates.parse_year, raw) == want


def test_parse_year_strict_formats_drop_scanner_dates(each):
    assert each(lambda c: dates.parse_year(c, strict_formats=True), ["06/05/2024", "2024-05-06"]) == [None, 2024]


def test_feed_date(each):
    raw = [
        "Mon, 06 May 2024 10:00:00 GMT",
        "Mon, 06 May 2024 23:30:00 -0500",
        "6 May 24 10:00 EST",
        "2024-05-06T23:30:00-05:00",
        "2024-05-06T10:00:00.5Z",
        "2024-05-06 10:00:00",
        "2024-05-06",
        "May 6",
        None,
    ]
    want = ["06/05/2024", "07/05/2024", "06/05/2024", "07/05/2024", "06/05/2024", "06/05/2024", "06/05/2024", "", ""]
    assert each(dates.feed_date, raw) == want


def test_feed_days_are_utc_in_any_session(spark, each):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Pacific/Auckland")
    try:
        raw = ["Mon, 06 May 2024 23:30:00 GMT", "2024-05-06T23:30:00-05:00", "2024-05-06 23:30:00", "2024-05-06"]
        assert each(dates.feed_date, raw) == ["06/05/2024", "07/05/2024", "06/05/2024", "06/05/2024"]
        assert each(dates.parse_year, ["2024-01-01T00:00:00Z", "31 Dec 2023"]) == [2024, 2023]
        assert each(dates.iso_date, ["1/1/2024"]) == ["2024-01-01"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_feed_date_takes_first_parsable(one):
    assert one(dates.feed_date("a", "b"), "a string, b string", "junk", "2024-01-02") == "02/01/2024"


def test_abbreviated_numbers(each):
    raw = ["1K", "2.01k", "1.5M", "1,234", "42", " 7 ", "", "Kx", "many", "+5", "NANK"]
    assert each(numbers.abbreviated_number, raw) == [1000, 2009, 1500000, 0, 42, 7, 0, 0, 0, 5, 0]


def test_post_id(spark):
    rows = [
        ("/feed/update/urn:li:activity:12/", None),
        ("https://x/urn:li:activity:1/urn:li:activity:2/", "urn:li:activity:9"),
        ("/other", "urn:li:activity:34"),
        (None, "urn:li:share:5"),
        ("urn:li:activity:/", "urn:li:activity:7"),
    ]
    got = spark.createDataFrame(rows, "link string, urn string").select(urls.post_id("link", "urn").alias("v"))
    assert [r.v for r in got.collect()] == ["12", "2", "34", None, "7"]


def test_candidate_urls(each):
    raw = ["https://cdn.x.com/a?b#c", "http://www.x.com/p?", "x.com/p", "https://x.com"]
    assert each(urls.candidate_urls, raw) == [
        ["https://cdn.x.com/a?b#c", "https://x.com/a?b#c", "https://www.cdn.x.com/a?b#c"],
        ["http://www.x.com/p", "http://x.com/p"],
        [],
        ["https://x.com", "https://www.x.com"],
    ]


def test_article_id(spark):
    rows = [(" 5 ", "x"), ("", "http://a/article/77/b"), (None, "http://a/b/77"), (None, None)]
    got = spark.createDataFrame(rows, "r string, u string").select(urls.article_id("r", "u").alias("v"))
    assert [r.v for r in got.collect()] == ["5", "77", None, None]


def test_distinct_ignoring_case_keeps_first_spelling_and_order(each):
    raw = [["b", "A", "a", "B", "c", "A"], [], None, ["x"]]
    assert each(arrays.distinct_ci, raw, "array<string>") == [["b", "A", "c"], [], None, ["x"]]


def test_join_list_and_blocks(each):
    assert each(arrays.join_list, [[" a­", None, " ", "b"], None], "array<string>") == ["a; b", ""]
    blocks = [[("text", " a "), ("image", "b"), ("text", "­"), ("text", None), ("text", "c")], None]
    assert each(arrays.blocks_text, blocks, "array<struct<Role:string,Text:string>>") == ["a\n\nc", ""]


def test_entry_text_keeps_repeats(one):
    parts = arrays.entry_text(F.array("a", "b"), F.lit(None).cast("array<string>"), F.array("b"))
    assert one(parts, "a string, b string", "", "s") == "s\n\ns"


def test_entry_author_link_categories(one):
    author = arrays.entry_author("n", "a")
    assert one(author, "n array<string>, a string", [" x ", "", None, "y"], "z") == "x, y"
    assert one(author, "n array<string>, a string", [" "], " z ") == "z"
    assert one(author, "n array<string>, a string", None, None) == ""
    link = arrays.entry_link("l", "h")
    assert one(link, "l string, h array<string>", " ", [None, " ", " u "]) == "u"
    assert one(arrays.entry_categories("c"), "c array<string>", [" a", "b", "a ", ""]) == ["a", "b"]


def test_string_list(each):
    raw = ['"  a "', '["a", " ", null, 5]', "null", '" "']
    assert each(lambda c: arrays.string_list(F.parse_json(c)), raw) == [["a"], ["a", "5"], [], [""]]


def test_preview_list(each):
    raw = [["aa", "bb", "cc"], ["a"], [], None]
    assert each(lambda c: arrays.preview_list(c, 2, 5), raw, "array<string>") == ["aa; …", "a", "-", "-"]


def test_counted_items(each):
    got = each(arrays.counted, [["b", "a", "b", None, "b", None], [], None, ["a"]], "array<string>")
    assert [v and [tuple(e) for e in v] for v in got] == [[(None, 2), ("a", 1), ("b", 3)], [], None, [("a", 1)]]
