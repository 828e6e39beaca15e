"""Readers on small documents of our own."""

import gc

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
from gleanery import fixed_values as fv
from gleanery.functions import html
from gleanery.sources import feeds, jobs, pages, press, tables_csv

OPML = """<?xml version="1.0"?><opml><head><title>t</title></head><body>
<outline text="Group" title="Group">
 <outline type="rss" text="A" title="" xmlUrl="u1 " htmlUrl="h1"/>
 <!-- <outline title="gone" xmlUrl="u0"/> -->
 <outline text="Deep"><outline text=" B &amp; C " xmlUrl="u2"/>
   <outline title="x > y" text="no" xmlUrl='u3'></outline></outline>
 <outline title="again" xmlUrl="u1 "/>
 <outline xmlUrl="u4"/><outline title="none" xmlUrl=""/>
</outline></body></opml>"""


def test_opml(spark, tmp_path):
    (tmp_path / "f.opml").write_text(OPML, encoding="utf-8")
    rows = feeds.read_opml(spark, str(tmp_path / "f.opml")).orderBy("ord").collect()
    assert [(r.title, r.xml_url, r.html_url) for r in rows] == [
        ("A", "u1", "h1"),
        ("B & C", "u2", None),
        ("x > y", "u3", None),
        ("u4", "u4", None),
    ]


RSS = """<rss version="2.0" xmlns:content="http://c" xmlns:dc="http://d" xmlns:media="http://m"><channel><title>c</title>
<item><title>One &amp; 1</title><link> http://l1 </link><description><![CDATA[<p>sum</p>]]></description>
<media:title>no</media:title><content:encoded><![CDATA[<b>full</b> text]]></content:encoded><dc:creator>Ann</dc:creator>
<category>x</category><category domain="d">y</category><pubDate>Mon, 06 May 2024 10:00:00 GMT</pubDate></item>
<item><title>Two</title></item></channel></rss>"""
RDF = """<rdf:RDF xmlns:rdf="http://r" xmlns="http://purl.org/rss/1.0/" xmlns:dc="http://d"><channel><title>c</title></channel>
<item><title>R</title><link>http://r</link><dc:date>2024-05-06</dc:date></item></rdf:RDF>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><title>f</title><entry><title type="html">T</title>
<link rel="self" href="s"/><link href="h"/><summary>s</summary><content type="html">&lt;i&gt;c&lt;/i&gt;</content>
<author><name>N1</name></author><author><name>N2</name></author><category term="k" label="l"/><category label="m"/>
<updated>2024-05-06T10:00:00Z</updated></entry></feed>"""
PREFIXED = ATOM.replace("</", "</a:").replace("<", "<a:").replace("<a:/a:", "</a:").replace("xmlns=", "xmlns:a=")


def entries(spark, raw, **options):
    frame = spark.createDataFrame([("f", raw)], "xml_url string, raw string")
    return feeds.parse_feeds(frame, **options).orderBy("entry_pos").collect()


def test_rss(spark):
    one, two = [r.entry for r in entries(spark, RSS)]
    assert (one.title, one.summary, one.contents, one.summary_detail) == (
        "One & 1", "<p>sum</p>", ["<b>full</b> text"], "<p>sum</p>")
    assert (one.link, one.author, list(one.terms)) == ("http://l1", "Ann", ["x", "y"])
    assert (two.title, two.summary, two.link, two.terms) == ("Two", None, "", None)


def test_rss_1_and_atom(spark):
    (rdf,) = [r.entry for r in entries(spark, RDF)]
    assert (rdf.title, rdf.link, rdf.dates) == ("R", "http://r", [None, "2024-05-06", None])
    for raw in (ATOM, PREFIXED):
        (e,) = [r.entry for r in entries(spark, raw)]
        assert (e.title, e.summary, e.contents, e.link) == ("T", "s", ["<i>c</i>"], "h")
        assert (e.author_names, e.terms) == (["N1", "N2"], ["k", "m"])


def test_feed_limits_and_broken_documents(spark):
    many = "<rss><channel>" + "".join(f"<item><title>{i}</title></item>" for i in range(51)) + "</channel></rss>"
    assert len(entries(spark, many)) == 51
    assert len(entries(spark, many, max_items=50)) == 50
    assert [r.entry.title for r in entries(spark, many, max_items=2)] == ["0", "1"]
    for raw in ("<rss><channel><item>", "", "not xml", "<rss><channel></channel></rss>"):
        assert entries(spark, raw) == []


def test_job_items_from_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"title": "t", "company": "c", "other": 1}\n{"jobUrl": "u"}\n')
    rows = jobs.read_jobs(spark, str(tmp_path)).collect()
    assert [(r.title, r.company, r.jobUrl) for r in rows] == [("t", "c", None), (None, None, "u")]


def test_terms(spark, tmp_path):
    path = tmp_path / "terms.txt"
    path.write_text("# note\n AI lead \n\nai LEAD\r\nother\n", encoding="utf-8")
    assert [r.term for r in jobs.read_terms(spark, str(path)).orderBy("ord").collect()] == ["AI lead", "other"]
    path.write_text("# only\n\n")
    assert [r.term for r in jobs.read_terms(spark, str(path)).collect()] == [fv.DEFAULT_TITLE_QUERY]


def test_quoted_phrases(one):
    assert one(jobs.quoted_phrases('("Data  Lead" OR "x")'), "d int", 1) == ["data  lead", "x"]
    assert one(jobs.quoted_phrases(" Plain "), "d int", 1) == ["plain"]


def test_press_records(spark):
    page = '{"Items": [{"RegionId": "1", "Rank": 2}, {"RegionId": null}], "Highlights": ["a"]}'
    frame = spark.createDataFrame([(3, page)], "page int, raw string")
    hits = press.parse_hits(frame).orderBy("pos").collect()
    assert [(h.page, h.pos, h.hit.RegionId) for h in hits] == [(3, 0, "1"), (3, 1, None)]
    assert press.parse_highlights(frame).first().highlights == ["a"]


LISTING = """<main><a target="_blank" href="/a"><div class="x flex"><span> Acme  Co </span><img alt="Logo"></div>
<h3>T<b>1</b></h3><p>Sum <i>mary</i><p>more</p><span>on 1/2/2024</span></a>
<a target="_blank" href="https://x/b"><div class="flex"><span>1/3/2024</span><img alt=" Lo  go "></div><h3>T2</h3><p>s</p></a>
<a target="_blank" href="c"><span>4/5/2024</span><span>Third</span><h3>T3</h3><p>s</p></a>
<a target="_blank" href="/d"><h3>T4</h3><p>no date</p><span>P</span></a>
<a href="/e"><h3>T5</h3><p>same tab</p><span>P 1/1/2024</span></a></main>
<a target="_blank" href="/f"><h3>outside</h3><p>s</p><span>P</span><span>1/1/2024</span></a>"""


def test_listing(spark):
    frame = spark.createDataFrame([(1, LISTING), (2, None), (3, "<main></main>")], "page int, html string")
    rows = pages.parse_listing(frame, base_url="https://b/").orderBy("card_pos").collect()
    assert [(r.title, r.publisher, r.publish_date, r.summary, r.url) for r in rows] == [
        ("T1", "Acme Co", "2024-01-02", "Sum mary", "https://b/a"),
        ("T2", "Lo go", "2024-01-03", "s", "https://x/b"),
        ("T3", "Third", "2024-04-05", "s", "https://b/c"),
    ]


POSTS = f"""<div class="{fv.POST_CARD_CLASS} z"><a class="{fv.POST_LINK_CLASS}" href=" /feed/update/urn:li:activity:1/ "></a>
<div class="{fv.POST_ACTOR_CLASS}"><a class="{fv.POST_ACTOR_LINK_CLASS}" href="/in/ann"></a>
<span class="{fv.POST_ACTOR_TITLE_CLASS}"><span dir="ltr"> Ann <b>B</b> </span></span>
<span class="{fv.POST_ACTOR_JOB_CLASS}"> Job </span><span class="{fv.POST_ACTOR_TIME_CLASS}">2d</span></div>
<div class="{fv.POST_TEXT_CLASS}"> Hello <b>world</b><br> bye</div>
<div class="{fv.POST_COUNTS_CLASS}"><ul><li class="{fv.POST_REACTIONS_CLASS}"><button aria-label="2.01K reactions"></button></li>
<li class="{fv.POST_COMMENTS_CLASS}"><button aria-label="1,234 comments"></button></li></ul></div>
<span class="{fv.POST_IMPRESSIONS_CLASS}"> 5M impressions</span></div>
<div class="{fv.POST_CARD_CLASS}" data-urn="urn:li:activity:2"></div><div class="{fv.POST_CARD_CLASS}"></div>"""


def test_posts(spark):
    frame = spark.createDataFrame([(1, POSTS)], "snapshot_pass int, html string")
    full, bare = pages.parse_posts(frame).orderBy("card_pos").collect()
    assert full.asDict() == {
        "snapshot_pass": 1, "card_pos": 0, "post_id": "1",
        "post_url": fv.POST_SITE + "/feed/update/urn:li:activity:1/",
        "author_name": "AnnB", "author_profile": fv.POST_SITE + "/in/ann", "author_job": "Job", "post_time": "2d",
        "content": "Hello\nworld\nbye", "reactions": 2009, "comments": 0, "impressions": 5_000_000,
    }
    assert (bare.post_id, bare.post_url, bare.content, bare.reactions, bare.impressions) == ("2", "", "", 0, 0)


ARTICLE = """<html><head><style>p {}</style><script>var a = "<p>not this one here</p>";</script></head><body>
<p>two words<p>three plain words<div><p>in a &amp; <code>x = 1</code> div&nbsp;here</p></div>
<pre><p>code is not text</p><code>nested <pre>deep</pre></code></pre><noscript><p>no script text here</p></noscript>
<p>last   one &amp;lt; kept</p></body></html>"""


def test_page_bodies_and_dropped_blocks(spark):
    frame = spark.createDataFrame([("u", ARTICLE), ("v", None), ("w", "")], "url string, html string")
    got = {r.url: r.body for r in pages.page_bodies(frame).collect()}
    assert got["u"] == "three plain words\n\nin a & div here\n\nlast one < kept"
    assert got["v"] == got["w"] == ""
    stripped = {r.url: r.s for r in frame.select("url", html.strip_blocks("html").alias("s")).collect()}
    assert "not this" not in stripped["u"] and "x = 1" not in stripped["u"] and "deep" not in stripped["u"]
    assert "&nbsp;here" in stripped["u"] and "three plain words" in stripped["u"]


def test_deep_and_unclosed_markup(spark):
    page = "<div>" * 3000 + "<p>deep inside this page" + "<b>" * 50 + " end"
    frame = spark.createDataFrame([("u", page)], "url string, html string")
    assert pages.page_bodies(frame).first().body == "deep inside this page end"


def test_csv(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('a,b\n"x ""q""\ny",\n1,2,3\n4\n,z\n', encoding="utf-8")
    rows = tables_csv.read_csv_tolerant(spark, str(path), ["a", "b"], max_chars=100)
    good = {(r.a, r.b) for r in tables_csv.good_rows(rows).collect()}
    assert ('x "q"\ny', "") in good and ("", "z") in good
    assert any(r.a == "1" for r in tables_csv.bad_rows(rows).collect())
    short = tables_csv.read_csv_tolerant(spark, str(path), ["a", "b"], max_chars=3)
    assert any("q" in r.a for r in tables_csv.bad_rows(short).collect())
    plain = tmp_path / "b.csv"
    plain.write_text('a,b\n"1\n2",\n')
    assert [tuple(r) for r in tables_csv.read_csv(spark, str(plain)).collect()] == [("1\n2", "")]


def test_parse_html_of_text_only(one):
    assert one(F.size(html.paragraphs("h")), "h string", "no markup") == 0


def test_the_size_limit_of_one_column_spares_the_others(spark, tmp_path):
    rows = [(1, "src1", "en"), (123456, "src1", "en"), (123457, "src12", "en"), (123458, "src1", "fr")]
    spark.createDataFrame(rows, "doc_id long, source string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = registered.queries()["s8_csv_files"](spark, str(tmp_path)).collect()
    assert {r.doc_id: r.bad_row for r in got} == {"1": False, "123456": False, "123457": True, "123458": True}


@pytest.mark.parametrize("reader", [html._posts, lambda page: html._cards(page, "https://b.c")])
def test_the_collector_rests_while_a_page_is_read(reader):
    page = "<main>" + "<div class='feed-shared-update-v2'><a target=_blank href=/x><h3>t</h3><p>s</p></a></div>" * 2000 + "</main>"
    gc.collect()
    before = sum(g["collections"] for g in gc.get_stats())
    inside = html.uncollected(lambda p: (reader(p), sum(g["collections"] for g in gc.get_stats()))[1], page)
    assert inside == before and gc.isenabled()


def test_classes_are_read_whole():
    page = html.parse_html("<p class='ab c'></p><p id='a'></p><p class='&#97; b'></p><p>")
    assert [n.has_class("a") for n in page.walk()] == [False, False, True, False]
    assert [n.has_class("c") for n in page.walk()] == [True, False, False, False]
    assert {tag: len(nodes) for tag, nodes in page.by_tag().items()} == {"p": 4}
