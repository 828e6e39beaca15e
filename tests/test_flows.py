"""Whole flows on small fixtures, in batch and as streams."""

from pyspark.sql import functions as F

import __spark_entry__ as registered
import bench
from gleanery import fixed_values as fv
from gleanery.operators.tables import read_table, upsert_table
from gleanery.plans import blogs, feeds, jobs, posts, press
from gleanery.sources.press import DETAIL, HIT, META
from gleanery.streaming import streams

from .test_sources import ATOM, LISTING, POSTS, RSS


def test_job_flow(spark):
    ddl = "ord int, search_query string, title string, companyName string, company string, location string, companyLocation string, publishedAt string, listedAt string, jobUrl string, url string, link string, description string, jobDescription string, jobDescriptionText string"

    def item(order, query, url, text):
        return (order, query, "T", "C", None, "L", None, None, None, url, None, None, text, None, None)

    items = spark.createDataFrame(
        [item(1, "q1", "U", "Skills\nknowledge of Git"), item(2, "q2", "u", "other"), item(3, "q2", "v", "We use SQL")], ddl
    )
    heuristic = {r.ord: r.skills for r in jobs.job_table(items).collect()}
    assert heuristic == {1: ["Git"], 3: []}
    local = {r.ord: r.skills for r in jobs.job_table(items, "local").collect()}
    assert local == {1: ["Git"], 3: ["SQL"]}


FEEDS = [(0, "One\n feed", "f1", "h1"), (1, "Two", "f2", None), (2, "Gone", "f3", None)]


def feed_frames(spark):
    long = RSS.replace("full</b> text", "full</b> text about AI " + "and more " * 20)
    docs = spark.createDataFrame([("f1", long), ("f2", ATOM), ("f3", "<rss"), ("f4", long)], "xml_url string, raw string")
    return spark.createDataFrame(FEEDS, "ord int, title string, xml_url string, html_url string"), docs


def test_feed_flow(spark):
    feed_list, docs = feed_frames(spark)
    (row,) = feeds.scan_feeds(feed_list, docs).collect()
    assert (row.feed_title, row.feed_xml_url, row.feed_html_url, row.entry_title) == ("One feed", "f1", "h1", "One & 1")
    assert (row.entry_author, row.entry_url, row.published) == ("Ann", "http://l1", "06/05/2024")
    assert (row.categories, row.matched_keywords) == (["x", "y"], ["AI"])
    assert row.article_text.startswith("One & 1 sum full text about AI and more") and row.article_text.endswith("more sum")
    assert feeds.scan_and_clean(feed_list, docs).count() == 1
    assert feeds.scan_and_clean(feed_list, docs, min_year=2025).count() == 0
    # Broken and unlisted feeds give nothing; other keywords find the other feed.
    assert [r.feed_xml_url for r in feeds.scan_feeds(feed_list, docs, ["c\n\ns"]).collect()] == ["f2"]


def documents_at(spark, folder, first, last):
    """A folder with documents of these ids, of two lines each."""
    text = F.concat(F.lit("one "), F.col("id").cast("string"), F.lit("\ntwo"))
    docs = spark.range(first, last + 1).select(F.col("id").alias("doc_id"), text.alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"))
    docs.write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def test_timed_blog_flow_reads_all_pages(spark, tmp_path):
    (name,) = [n for n in bench.HEADLINE if n.startswith("flow_blog")]
    rows = registered.queries()[name](spark, documents_at(spark, tmp_path, 397, 402)).collect()
    assert {r.engblogs_page for r in rows} == set(range(397, 403))


def test_post_flow_makes_all_passes(spark, tmp_path):
    """Of the post flows over whole tables one goes on where the fixture of flow_posts stops."""
    rows = registered.queries()["flow_posts_all_passes"](spark, documents_at(spark, tmp_path, 286, 402)).collect()
    shown = {int(r.Post_ID[:3]) for r in rows if r.Post_ID != "100"}
    assert shown == {i for i in range(286, 403) if i % 10 not in (7, 8)}


def test_blog_flow(spark):
    later = LISTING.replace('href="/a"', 'href="/late"')
    listing = spark.createDataFrame(
        [(1, LISTING), (2, None), (3, LISTING), (4, "<main></main>"), (5, later)], "page int, html string"
    )
    stored = spark.createDataFrame(
        [("https://www.x/b", "<p>found by host name</p>"), ("https://b/a", "<p>a b</p>")], "url string, html string"
    )
    rows = blogs.blog_table(listing, stored, base_url="https://b").orderBy("engblogs_page", "card_pos").collect()
    assert [(r.source_url, r.detail_content, r.engblogs_page) for r in rows] == [
        ("https://b/a", "", 1), ("https://x/b", "found by host name", 1), ("https://b/c", "", 1)]


def test_post_flow(spark):
    other = POSTS.replace("activity:1/", "activity:7/").replace("activity:2", "activity:8")
    snaps = [(0, POSTS), (1, POSTS), (2, other), (3, POSTS), (4, ""), (5, other), (6, POSTS.replace("activity:1/", "activity:9/"))]
    frame = spark.createDataFrame(snaps, "snapshot_pass int, html string")
    at = F.lit("2024-01-02 03:04:05.6").cast("timestamp")
    rows = posts.post_table(frame, mode="local", at=at).orderBy("snapshot_pass", "card_pos").collect()
    assert [(r.Post_ID, r.snapshot_pass) for r in rows] == [("1", 0), ("2", 0), ("7", 2), ("8", 2)]
    assert str(rows[0].Date_Collected) == "2024-01-02 03:04:05" and rows[0].Job_Titles == []
    assert posts.post_table(frame, max_posts=3).count() == 3
    assert posts.post_table(frame, max_idle=5).count() == 5
    assert posts.post_table(frame, max_passes=1).count() == 2
    assert set(fv.POST_COLUMNS) <= set(rows[0].asDict())


def press_frames(spark):
    def hit(order, region, **more):
        return (order, {"RegionId": region, "ProfileId": "p", "IsTopArticle": True, "Rank": 1.0, **more})

    hits = spark.createDataFrame(
        [hit(0, "1"), hit(1, None), hit(2, "2", Url=" http://hit "), hit(3, "1"), hit(4, "3"), hit(5, "done"), hit(6, "4")], f"ord int, hit {HIT}"
    )

    def meta(order, region, **more):
        return (order, {"Id": region, "Title": "old", **more})

    issue = {"Id": "i", "ShortDateString": "", "Date": "d", "Url": "", "ShareUrl": "http://issue/"}
    metas = spark.createDataFrame(
        [
            meta(0, "1"),
            meta(1, "1", Title="new", Issue=issue, TotalTextLength=0, Bylines=[{"Text": " a­"}, {"Text": ""}, {"Text": "b"}]),
            meta(2, "2", TotalTextLength=9, Classification={"Tags": [{"DisplayName": "x"}, {"DisplayName": None}]}),
            meta(3, "4"),
            meta(4, "done"),
        ],
        f"ord int, meta {META}",
    )
    details = spark.createDataFrame(
        [({"Id": "1", "Blocks": [{"Role": "text", "Text": "body"}]},), ({"Id": "2", "Blocks": [], "TotalTextLength": 0},)], f"detail {DETAIL}"
    )
    stored = spark.createDataFrame([(0, "done", "text"), (1, "4", "")], "ord int, region_id string, article_text string")
    return hits, metas, details, stored


def test_press_flow(spark):
    hits, metas, details, stored = press_frames(spark)
    got = {r.region_id: r for r in press.article_rows(hits, metas, details, stored, search_text="s").collect()}
    assert set(got) == {"1", "2", "4"}
    one, two, four = got["1"], got["2"], got["4"]
    assert (one.title, one.issue_date, one.authors, one.article_text, one.ord) == ("new", "d", ["a", "b"], "body", 0)
    assert (one.article_url, one.total_text_length) == ("http://issue/1", None)
    assert (two.article_url, two.total_text_length, two.classification_tags) == ("http://hit", None, ["x"])
    assert (four.article_url, four.article_text, four.search_text) == (fv.PRESS_ARTICLE_BASE + "4", "", "s")
    assert [c for c in four.asDict() if c != "ord"] == fv.PRESS_COLUMNS
    few = press.article_rows(hits, metas, details, stored, search_text="s", max_results=3).collect()
    assert {r.region_id for r in few} == {"1", "2"}


def test_highlights(spark):
    ddl = "page int, highlights array<string>"
    pages = spark.createDataFrame([(2, ["c"]), (1, ["a­", None, " b"]), (0, ["", None]), (-1, None)], ddl)
    assert spark.range(1).select(press.first_highlights(pages).alias("h")).first().h == "a|b"
    none = spark.createDataFrame([(0, [])], ddl)
    assert spark.range(1).select(press.first_highlights(none).alias("h")).first().h == ""


def test_stream_of_unseen_ids(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "post_id string, seen timestamp"

    def arrive(*ids):
        spark.createDataFrame([(i,) for i in ids], "post_id string").withColumn(
            "seen", F.lit("2024-01-01").cast("timestamp")
        ).coalesce(1).write.mode("append").parquet(source)
        stream = streams.unseen_ids(spark.readStream.schema(schema).parquet(source), "post_id")
        streams.append_stream(stream, out, state).awaitTermination()
        return sorted(r.post_id for r in spark.read.parquet(out).collect())

    assert arrive("a", "b", "a") == ["a", "b"]
    assert arrive("b", "c") == ["a", "b", "c"]


def test_stream_ingest_resumes(spark, tmp_path):
    source, root, state = (str(tmp_path / n) for n in ("in", "table", "state"))
    schema = "ord bigint, region_id string, article_text string"

    def arrive(*new):
        spark.createDataFrame(list(new), schema).coalesce(1).write.mode("append").parquet(source)
        streams.ingest(
            spark.readStream.schema(schema).parquet(source),
            lambda batch, existing: batch,
            lambda: read_table(spark, root, schema),
            root=root, schema=schema, checkpoint=state,
        ).awaitTermination()
        return {r.region_id: r.article_text for r in read_table(spark, root, schema).collect()}

    assert arrive((0, "1", ""), (1, "2", "b")) == {"1": "", "2": "b"}
    assert arrive((0, "1", "a"), (1, "3", "c")) == {"1": "a", "2": "b", "3": "c"}
    # The same batch again changes nothing but the version.
    again = spark.createDataFrame([(0, "1", "a"), (1, "3", "c")], schema)
    assert upsert_table(spark, root, again, schema) == {"changed": 2, "added": 0}
    assert read_table(spark, root, schema).count() == 3


def test_stream_feed_scan(spark, tmp_path):
    feed_list, docs = feed_frames(spark)
    docs.write.parquet(str(tmp_path / "docs"))
    arriving = streams.feed_documents(spark, str(tmp_path / "docs"))
    streams.append_stream(
        streams.scan_feed_stream(arriving, feed_list), str(tmp_path / "out"), str(tmp_path / "state")
    ).awaitTermination()
    batch = feeds.scan_feeds(feed_list, docs)
    assert spark.read.parquet(str(tmp_path / "out")).select(*batch.columns).collect() == batch.collect()
