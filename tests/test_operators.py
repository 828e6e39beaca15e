"""Row operators: de-duplication, limits, stop rules, joins, tables, enrichment."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
from gleanery import fixed_values as fv
from gleanery.operators import dedupe, enrich, joins, limits, rows, search, tables


def frame(spark, ddl, *values):
    return spark.createDataFrame(list(values), ddl)


def collected(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_first_and_last_wins(spark):
    df = frame(spark, "k string, o int", ("a", 2), ("a", 1), ("b", 3), (None, 4), (None, 5))
    assert set(collected(dedupe.first_wins(df, "k", "o"))) == {("a", 1), ("b", 3), (None, 4)}
    assert set(collected(dedupe.last_wins(df, "k", "o"))) == {("a", 2), ("b", 3), (None, 5)}


def test_dedupe_jobs_ignores_case_and_null(spark):
    ddl = "url string, title string, company string, location string, ord int"
    df = frame(spark, ddl, ("U", "T", None, "l", 2), ("u", "t", "", "L", 1), ("u", "t", "x", "l", 3))
    assert sorted(r.ord for r in dedupe.dedupe_jobs(df).collect()) == [1, 3]


def test_row_index_matches_sorting(spark):
    rng = random.Random(3)
    values = [rng.randrange(-(2**62), 2**62) for _ in range(300)] + [-1, 0, 1, 2**20 - 1, 2**20, 2**42, 2**42 - 1, 2**63 - 1, -(2**63)]
    df = frame(spark, "ord bigint", *[(v,) for v in values]).repartition(5)
    got = {r.ord: r.row_idx for r in limits.row_index(df, "ord").collect()}
    assert got == {v: i for i, v in enumerate(sorted(values))}


def test_row_index_per_key_with_null_key(spark):
    data = [(k, o) for k in ("a", "b", None) for o in range(0, 2**24, 2**20)]
    df = frame(spark, "k string, ord bigint", *data)
    got = collected(limits.row_index(df, "ord", "i", ["k"]))
    assert sorted(got, key=repr) == sorted([(k, o, o >> 20) for k, o in data], key=repr)


@pytest.mark.parametrize("n", [0, 3, 99_999, 100_000, 100_001, 250_000])
def test_first_rows(spark, n):
    df = spark.range(200_000).selectExpr("concat('t', id div 7) as title", "id % 5 as k", "id")
    expected = sorted((f"t{i // 7}", i % 5, i) for i in range(200_000))[:n]
    got = limits.first_rows(df, n, "title", "k", "id")
    assert sorted(collected(got)) == expected
    # Repeated order values: any rows of the last value, but the right number of each value.
    titles = Counter(r.title for r in limits.first_rows(df, n, "title").select("title").collect())
    assert titles == Counter(t for t, _, _ in expected)


def test_first_rows_that_repeat_and_nulls(spark):
    df = frame(spark, "a string, b int", *[("x", 1)] * 30, (None, 2), ("a", None), ("y", 3))
    assert sorted(collected(limits.first_rows(df, 12, "a")), key=repr) == sorted([(None, 2), ("a", None)] + [("x", 1)] * 10, key=repr)


def test_batches(spark):
    df = frame(spark, "ord bigint", *[(i * 10,) for i in range(12)])
    got = collected(limits.batch_ids(df, 5), "ord")
    assert got == [(i * 10, i // 5, i % 5) for i in range(12)]


def test_stop_at_empty_page_skips_missing_pages(spark):
    cards = frame(spark, "page int, c string", (1, "a"), (2, "b"), (5, "c"), (7, "d"))
    fetched = frame(spark, "page int", (1,), (2,), (5,), (6,), (7,))
    assert collected(limits.stop_at_empty_page(cards, fetched), "page") == [(1, "a"), (2, "b"), (5, "c")]
    full = frame(spark, "page int", (1,), (2,), (5,), (7,))
    assert len(limits.stop_at_empty_page(cards, full).collect()) == 4


def brute_passes(new_by_pass, max_idle, max_passes):
    done, idle = [], 0
    for p, new in new_by_pass:
        if len(done) >= max_passes or idle >= max_idle:
            break
        idle = 0 if new else idle + 1
        done.append((p, new, idle))
    return done


def test_passes_until_idle_against_brute_force(spark):
    rng = random.Random(5)
    for _ in range(6):
        passes = list(range(25))
        seen = [(p, f"k{rng.randint(0, 12)}") for p in passes for _ in range(rng.choice([0, 0, 1, 2]))]
        known, news = set(), []
        for p in passes:
            fresh = {k for q, k in seen if q == p} - known
            known |= fresh
            news.append((p, len(fresh)))
        got = limits.passes_until_idle(
            frame(spark, "p int, k string", *(seen or [(0, "k")])), frame(spark, "p int", *[(p,) for p in passes]),
            key="k", pass_col="p", max_idle=3, max_passes=20,
        )
        assert collected(got, "p") == brute_passes(news, 3, 20)


@pytest.mark.parametrize("row_bits, bucket_bits", [(3, 1), (20, 22)])
def test_passes_until_idle_over_many_buckets(spark, monkeypatch, row_bits, bucket_bits):
    monkeypatch.setattr(limits, "_ROW_BITS", row_bits)
    monkeypatch.setattr(limits, "_BUCKET_BITS", bucket_bits)
    rng = random.Random(row_bits)
    passes = sorted(rng.sample(range(-50, 400), 200))
    seen = [(p, f"k{p if rng.random() < 0.15 else 0}") for p in passes]
    known, news = set(), []
    for p, k in seen:
        news.append((p, int(k not in known)))
        known.add(k)
    for max_idle in (5, 20, 500):
        got = limits.passes_until_idle(
            frame(spark, "p bigint, k string", *seen), frame(spark, "p bigint", *[(p,) for p in passes]), key="k", pass_col="p", max_idle=max_idle
        )
        assert collected(got, "p") == brute_passes(news, max_idle, 10**6)


def test_two_million_passes(spark):
    passes = spark.range(2_000_000).withColumnRenamed("id", "p")
    seen = passes.where("p < 1900000").withColumn("k", F.col("p"))
    made = limits.passes_until_idle(seen, passes, key="k", pass_col="p", max_idle=50_000)
    assert made.agg(F.count("*"), F.max("p"), F.max("idle_run")).first()[:] == (1_950_000, 1_949_999, 50_000)


def test_preview(spark):
    ddl = "ord int, search_query string, title string, company string, location string, published_at string, responsibilities array<string>, skills array<string>"
    df = frame(spark, ddl, (2, "q", "", None, "l", "2024-01-01T00:00:00.000Z", ["a"] * 5, []), (1, "q", "t" * 50, "c", "l", "", ["x" * 70], ["s"]))
    first, second = limits.preview(df, 5).collect()
    assert first.Title == "t" * 40 and first.Responsibilities == "x" * 59 + "…" and first.Published == "-"
    assert (second.Title, second.Company, second.Published) == ("-", "-", "2024-01-01T00:00:00")
    assert (second.Responsibilities, second.Skills) == ("a; a; a", "-")
    assert limits.hidden_rows(df, 1).first().more_rows == 1


def test_keywords(spark):
    df = frame(spark, "t string", ("He SAID so",), ("future of AI",), ("",), (None,), ("none",))
    got = search.match_keywords(df, "t", [" Future", "ai", ""])
    assert set((r.t, tuple(r.matched_keywords)) for r in got.collect()) == {("He SAID so", ("AI",)), ("future of AI", ("FUTURE", "AI"))}
    assert [r.t for r in search.match_keywords(df, "t", whole_word=True).collect()] == ["future of AI"]
    assert search.normalize_keywords([" "]) == ["ai"]


def test_search_jobs_checks_codes_and_never_clamps(spark):
    df = spark.range(1200).select(F.col("id").alias("ord"), F.lit("AI lead").alias("title"), F.lit("1").alias("work_type"))
    assert search.search_jobs(df, title='("ai" OR "b")', work_type="1", rows=1100).count() == 1100
    assert search.search_jobs(df, work_type="1").count() == 1200
    assert search.search_jobs(df, title='("zz")', rows=0).count() == 0
    with pytest.raises(ValueError):
        search.search_jobs(df, work_type="9")


def test_past_window_codes():
    assert search.past_window("r604800") == 604800
    with pytest.raises(ValueError):
        search.past_window("week")


def test_not_completed_looks_at_last_row(spark):
    hits = frame(spark, "region_id string", ("1",), ("2",), ("3",))
    stored = frame(spark, "ord int, region_id string, article_text string", (1, "1", "x"), (2, " 1 ", " "), (3, "2", "y"), (4, "", "z"))
    assert collected(joins.not_completed(hits, stored), "region_id") == [("1",), ("3",)]


def test_candidate_url_lowest_index_wins(spark):
    articles = frame(spark, "url string, n int", ("https://www.x.com/a", 1), ("https://cdn.y.com/b", 2), ("https://z.com", 3))
    stored = frame(spark, "url string, body string", ("https://x.com/a", "two"), ("https://www.x.com/a", "one"), ("https://y.com/b", "b"), ("https://www.cdn.y.com/b", "c"))
    got = {r.n: (r.stored_url, r.body) for r in joins.by_candidate_url(articles, stored).collect()}
    assert got == {1: ("https://www.x.com/a", "one"), 2: ("https://y.com/b", "b"), 3: ("", "")}


def test_job_rows_choose_first_nonempty(spark):
    names = ["title", "companyName", "company", "location", "companyLocation", "publishedAt", "listedAt", "jobUrl", "url", "link", "description", "jobDescription", "jobDescriptionText"]
    ddl = "ord int, search_query string, " + ", ".join(f"{n} string" for n in names)
    df = frame(spark, ddl,
        (1, "q", " T ", "", " c ", "  ", "there", None, "l", "", None, "k ", "", " Skills\nSQL ", "x"),
        (2, None, *[None] * 13))
    full, empty = rows.normalize_jobs(df).orderBy("ord").collect()
    assert (full.title, full.company, full.location, full.published_at, full.url) == ("T", "c", "", "l", "k ")
    assert (full.description, full.skills) == ("Skills\nSQL", ["SQL"])
    assert (empty.title, empty.url, empty.description, empty.skills) == ("", "", "", [])


def test_clean_matches(spark):
    columns = [c for c in fv.FEED_COLUMNS]
    long = "x " * 60

    def row(published, text):
        return tuple({"published": published, "article_text": text, "feed_title": " a\nb "}.get(c, f" {c}\t") for c in columns)

    df = frame(spark, ", ".join(f"{c} string" for c in columns),
        row("2024-01-01", long), row("06/05/2024", long + "﻿"), row("2023-12-31", long), row("2024-01-01", "y" * 99 + " \n "), row("2024-01-01", "y" * 100), row("", long))
    got = rows.clean_matches(df).collect()
    assert sorted(r.published for r in got) == ["06/05/2024", "2024-01-01", "2024-01-01"]
    assert {r.feed_title for r in got} == {"a b"} and {r.categories for r in got} == {"categories"}
    assert {r.entry_url for r in got} == {" entry_url\t"} and all(len(r.article_text) in (100, 119) for r in got)
    assert len(rows.clean_matches(df, strict_formats=True).collect()) == 2


def test_counted(spark):
    seen, counters = rows.counted(spark.range(10), "n", even=F.col("id") % 2 == 0)
    assert seen.count() == 10
    assert counters.get == {"rows": 10, "even": 5}


STORED = "ord bigint, region_id string, article_text string, note string"
NEW = "ord bigint, region_id string, article_text string"


def test_upsert(spark):
    stored = frame(spark, STORED, (0, "1", "a", "n0"), (1, " 1", "b", "n1"), (2, None, "c", "n2"), (3, "2", "", "n3"), (4, "", "d", "n4"))
    new = frame(spark, NEW, (0, "1", "A"), (1, "3", "C"), (2, "1", "ignored"), (3, None, "no id"))
    want = [(0, "1", "a", "n0"), (1, "1", "A", "n1"), (2, None, "c", "n2"), (3, "2", "", "n3"), (4, "", "d", "n4"), (6, "3", "C", None)]
    once = tables.upsert(stored, new)
    assert collected(once, "ord") == want
    assert collected(tables.upsert(once, new), "ord") == want


def test_versioned_table(spark, tmp_path):
    root = str(tmp_path / "t")
    assert tables.committed_version(spark, root) is None
    assert tables.read_table(spark, root, STORED).count() == 0
    first = tables.upsert_table(spark, root, frame(spark, NEW, (0, "1", ""), (1, "2", "b")), STORED)
    assert first == {"changed": 0, "added": 2} and tables.committed_version(spark, root) == 1
    more = tables.upsert_table(spark, root, frame(spark, NEW, (0, "3", "c")), STORED)
    assert more == {"changed": 0, "added": 1} and tables.committed_version(spark, root) == 1
    files = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    changed = tables.upsert_table(spark, root, frame(spark, NEW, (0, " 1", "a"), (1, "4", "")), STORED)
    assert changed == {"changed": 1, "added": 1} and tables.committed_version(spark, root) == 1
    want = {"1": "a", "2": "b", "3": "c", "4": ""}
    assert stored_texts(spark, root) == want
    # What was there stays as it is: a change is a folder of its own.
    assert all(p.stat().st_mtime_ns == t for p, t in files.items())
    # A version or a change without its success marker does not count: no reader sees half of one.
    (tmp_path / "t" / "version-00000009").mkdir()
    assert tables.committed_version(spark, root) == 1
    half = tmp_path / "t" / "delta-00000001-000003"
    frame(spark, STORED, (0, "1", "half", "")).write.parquet(str(half))
    (half / "_SUCCESS").unlink()
    assert stored_texts(spark, root) == want


def stored_texts(spark, root):
    rows = tables.read_table(spark, root, STORED).collect()
    assert len({r.ord for r in rows}) == len(rows)
    return {r.region_id: r.article_text for r in rows}


def test_changes_are_merged_and_old_versions_dropped(spark, tmp_path):
    root, want = str(tmp_path / "t"), {}
    for i in range(9):
        new = frame(spark, NEW, (0, str(i), f"new {i}"), (1, str(i // 2), f"again {i}"))
        tables.upsert_table(spark, root, new, STORED, max_deltas=2)
        want |= {str(i // 2): f"again {i}"} | ({str(i): f"new {i}"})
        assert stored_texts(spark, root) == want
    assert tables.committed_version(spark, root) == 3
    assert sorted(p.name for p in (tmp_path / "t").glob("version-*")) == ["version-00000002", "version-00000003"]


def test_an_unchanged_table_is_not_written(spark, tmp_path):
    root = str(tmp_path / "t")
    tables.upsert_table(spark, root, frame(spark, NEW, (0, "1", "a")), STORED)
    files = sorted(tmp_path.rglob("*.parquet"))
    tables.upsert_table(spark, root, frame(spark, NEW), STORED)
    ddl = "Id string, Blocks array<struct<Role:string,Text:string>>"
    schema = "ord bigint, region_id string, article_url string, article_text string"
    empty = frame(spark, schema, (0, "1", "u", "have"))
    tables.write_next_version(spark, empty, f"{root}2")
    assert tables.backfill_table(spark, f"{root}2", frame(spark, ddl), schema) == {"filled": 0, "missing": 0}
    assert sorted(tmp_path.glob("t/**/*.parquet")) == files
    assert not list(tmp_path.glob("t2/delta-*"))


def test_backfill_table(spark, tmp_path):
    root, ddl = str(tmp_path / "t"), "ord bigint, region_id string, article_url string, article_text string"
    tables.write_next_version(spark, frame(spark, ddl,
        (0, "1", "u", "have"), (1, "2", "u", " "), (2, "", "http://x/article/3", ""), (3, "", "http://x/4", ""), (4, "5", "", ""), (5, "6", "u", ""), (6, "7", "u", "")), root)
    details = frame(spark, "Id string, Blocks array<struct<Role:string,Text:string>>",
        ("1", [("text", "no")]), ("2", [("text", "two")]), ("3", [("text", "three")]), ("6", [("image", "x")]))
    assert tables.backfill_table(spark, root, details, ddl) == {"filled": 2, "missing": 3}
    got = {r.ord: r.article_text for r in tables.read_table(spark, root, ddl).collect()}
    assert got == {0: "have", 1: "two", 2: "three", 3: "", 4: "", 5: "", 6: ""}


def test_csv_round_trip(spark, tmp_path):
    from gleanery.sources.tables_csv import read_csv

    df = frame(spark, "a array<string>, b string, c boolean, d timestamp, e bigint", (["x", "y"], 'q "1"\nnext, line', True, None, None), (None, None, False, None, 7))
    path = str(tmp_path / "out")
    tables.write_csv(df, path)
    assert set(collected(read_csv(spark, path))) == {("x; y", 'q "1"\nnext, line', "True", "", ""), ("", "", "False", "", "7")}


def test_append(spark, tmp_path):
    path = str(tmp_path / "p")
    for _ in range(2):
        tables.append_rows(spark.range(3), path)
    assert spark.read.parquet(path).count() == 6


def test_requests(spark):
    df = frame(spark, "id string, ord bigint, text string", ("a", 1, " one "), ("b", 2, None), ("c", 3, "z" * 4001))
    whole = enrich.build_requests(df, kind="skills").first()
    assert whole.prompt.endswith("3. " + "z" * 4001)
    first, second = enrich.build_requests(df, kind="skills", size=2, max_chars=4000).orderBy("batch_id").collect()
    assert first.member_ids == ["a", "b"]
    assert first.prompt == f"{fv.SKILL_REQUEST_TEXT}\n\n1. one\n\n2. {fv.NO_DESCRIPTION}"
    assert second.prompt.endswith("1. " + "z" * 4000 + "...")
    insight = enrich.build_requests(df, kind="insights", max_chars=4000).first()
    assert insight.prompt.startswith(fv.INSIGHT_REQUEST_LINES[0] + "\n")
    assert insight.prompt.endswith("\n\nCONTENT 1:\none\nCONTENT 2:\n\nCONTENT 3:\n" + "z" * 4000)
    with pytest.raises(ValueError):
        enrich.build_requests(df, kind="other")


def test_skill_answers(each):
    raw = ['[["a ", "", null, true, 5], " b "]', 'Sure [["a"], {}] ok', '[["a"]]', '{"a": 1}', "no", "", None, "null"]
    got = each(lambda c: enrich.skill_answer(c, F.lit(2)), raw)
    assert got == [[["a", "None", "True", "5"], ["b"]], [["a"], []], None, None, None, None, None, None]


def test_insight_answers(each):
    raw = ['[{"job_titles": " t ", "skills": ["a", " "]}, {}]', '{"skills": "x"}', '[{"skills": ["y"]}]', "[1, {}]", "[{}, {}, {}]", "[1]", "so: [{}, {}]", "oops", None]
    got = each(lambda c: enrich.insight_answer(c, F.lit(2)), raw)
    shown = [None if g is None else [(i.job_titles, i.skills) for i in g] for g in got]
    empty = ([], [])
    assert shown == [[(["t"], ["a"]), empty], [([], ["x"]), empty], [([], ["y"]), empty], None, None, None, [empty, empty], None, None]
    (single,) = each(lambda c: enrich.insight_answer(c, F.lit(1)), ['{"requirements": ["r"]}'])
    assert single[0].requirements == ["r"]


def test_fallbacks(one):
    ddl = "a struct<job_titles:array<string>,responsibilities:array<string>,skills:array<string>,requirements:array<string>>, t string"
    use = enrich.insight_or_fallback("a", "t")
    assert one(use, ddl, ([], [], ["x"], []), "hiring").skills == ["x"]
    assert one(use, ddl, ([], [], [], []), "hiring").job_titles == ["hiring"]
    assert one(use, ddl, None, "hiring").job_titles == ["hiring"]
    assert one(enrich.keep_nonempty("a", "b"), "a array<string>, b array<string>", [], ["k"]) == ["k"]
    assert one(enrich.skills_for_mode("local", "d", "s"), "d string, s array<string>", "SQL", ["a"]) == ["a", "SQL"]
    with pytest.raises(ValueError):
        enrich.skills_for_mode("other", "d", "s")


def test_lenient_skill_list(each):
    raw = ['["a", "A", " - b"]', '{"skills": ["x"], "list": ["y"]}', 'I say ["p"] now', "one, two; - Two\n• three", "", None, '{"other": 1}']
    assert each(enrich.parse_skill_list, raw) == [["a", "b"], ["x", "y"], ["p"], ["one", "two", "three"], [], [], ['{"other": 1}']]


def test_answer_function_failures_become_null(spark):
    requests = frame(spark, "batch_id bigint, prompt string", (0, "ok"), (1, "bad"))

    def answer(prompt):
        if prompt == "bad":
            raise RuntimeError
        return prompt.upper()

    assert collected(enrich.answer_requests(requests, answer), "batch_id") == [(0, "OK", None), (1, None, "RuntimeError: ")]


def test_copies_of_a_link_on_both_sides_do_not_multiply(spark):
    """Thirty thousand articles and as many stored pages of one link: pairs of them would not end."""
    articles = spark.range(30_000).select("id", F.lit("http://a.com/x").alias("url"))
    stored = spark.range(30_000).select(F.lit("http://www.a.com/x").alias("url"), F.format_string("b%05d", "id").alias("body"), "id")
    got = joins.by_candidate_url(articles, stored, order="id").groupBy("stored_url", "body").count().collect()
    assert [tuple(r) for r in got] == [("http://www.a.com/x", "b29999", 30_000)]


def test_backfills_are_merged_now_and_then(spark, tmp_path):
    ddl = "ord bigint, region_id string, article_url string, article_text string"
    root = str(tmp_path / "t")
    rows = frame(spark, ddl, *[(i, str(i), "u", "") for i in range(4)])
    tables.write_next_version(spark, rows, root)
    for i in range(3):
        blocks = "Id string, Blocks array<struct<Role: string, Text: string>>"
        details = frame(spark, blocks, (str(i), [("text", f"body {i}")]))
        assert tables.backfill_table(spark, root, details, ddl, max_deltas=1) == {"filled": 1, "missing": 3 - i}
    assert tables.committed_version(spark, root) == 2
    assert [r.article_text for r in tables.read_table(spark, root, ddl).orderBy("ord").collect()] == ["body 0", "body 1", "body 2", ""]


def test_first_wins_with_nulls_in_the_order(spark):
    df = frame(spark, "k string, o int", ("a", None), ("a", 2), ("a", 3), ("b", None))
    assert set(collected(dedupe.first_wins(df, "k", "o"))) == {("a", 2), ("b", None)}


def test_lines_that_share_a_number_keep_the_same_one(spark, tmp_path):
    lines = [(1, 5, 1, float(q)) for q in (9, 3, 7)] + [(2, None, 1, 4.0), (2, 8, None, 5.0), (2, 8, 2, 6.0)]
    df = frame(spark, "l_partkey long, l_orderkey long, l_linenumber int, l_quantity double", *lines)
    for i, rows in enumerate((df, df.orderBy("l_quantity"), df.orderBy(F.desc("l_quantity")))):
        rows.coalesce(1).write.parquet(f"{tmp_path}/{i}/lineitem.parquet")
        got = registered.queries()["d4_first_per_key"](spark, f"{tmp_path}/{i}")
        assert set(collected(got)) == {(1, 5, 1, 3.0), (2, 8, 2, 6.0)}


@pytest.mark.parametrize("name", ["j7_candidate_urls", "j7_repeated_pages"])
def test_pages_that_share_a_link_give_the_last_body(spark, tmp_path, name):
    pages = frame(spark, "page_id long, url string", (9, "http://a.b/x"), (10, "http://a.b/x"), (2, "http://a.b/x"), (4, "http://c.d/"))
    pages.coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    got = registered.queries()[name](spark, str(tmp_path))
    assert {r.page_id: r.body for r in got.collect()} == {2: "body 10", 9: "body 10", 10: "body 10", 4: "body 4"}


def test_job_search_gives_the_first_thousand(spark, tmp_path):
    rows = spark.range(1500).selectExpr("1500 - id as p_partkey", "'small ring' as p_name", "'Brand#1' as p_brand", "'T' as p_type", "7 as p_size")
    rows.write.parquet(f"{tmp_path}/part.parquet")
    got = registered.queries()["p12_job_search"](spark, str(tmp_path))
    assert sorted(r.p_partkey for r in got.collect()) == list(range(1, 1001))
