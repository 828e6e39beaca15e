"""Predicates, row de-duplication, limits, joins, unions, table maintenance."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanery import fixed_values as fv
from gleanery.functions.arrays import preview_list
from gleanery.functions.boolean import matches_stored_expression
from gleanery.functions.text import csv_safe
from gleanery.operators import dedupe, joins, keywords, limits, rows, search, tables, trigrams
from gleanery.sources.jobs import clean_terms, read_terms, tag_query

from .base import JOB_TEXT_SQL, big, collapse_sql, job_text, joined, query, quote, strip_sql, table, work_folder

KEYWORDS = ["ai", " The ", "tion", "%%%", "nothere"]


def docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


# ---- predicates ----


@query(
    "p8_keyword_hits",
    f"""with c as (select doc_id, {collapse_sql('text')} as body from documents),
    h as (select *, list_filter(['ai', 'the', 'tion', '%%%', 'nothere'],
                                lambda k: contains(lower(body), k)) as hits from c)
    select doc_id, array_to_string(hits, ',') as hits, length(body)::bigint as n_chars
    from h where len(hits) > 0 and length(body) >= 100""",
)
def p8_keyword_hits(spark, sf_dir):
    cleaned = docs(spark, sf_dir).select("doc_id", csv_safe("text").alias("body"))
    found = search.match_keywords(cleaned, "body", KEYWORDS)
    long_enough = rows.keep_computed(found, {"n_chars": big(F.length("body"))}, lambda r: r["n_chars"] >= 100)
    return long_enough.select("doc_id", F.lower(joined("matched_keywords", ",")).alias("hits"), "n_chars")


@query(
    "p8_whole_word_hits",
    """select doc_id, 'THE' as matched_keywords from documents
    where regexp_matches(regexp_replace(lower(text), '[à-öø-ÿ]', '_', 'g'), '\\bthe\\b')""",
)
def p8_whole_word_hits(spark, sf_dir):
    found = search.match_keywords(docs(spark, sf_dir), "text", ["the"], whole_word=True)
    return found.select("doc_id", joined("matched_keywords").alias("matched_keywords"))


TERM = "[a-zà-ÿ]{8,}"


@query(
    "p8_keyword_table",
    f"""with terms as (
        select distinct unnest(regexp_extract_all(lower(text), '{TERM}')) as term from documents
    ),
    hits as (select doc_id, term from documents join terms on contains(lower(text), term))
    select doc_id, count(*) as n_hits, md5(string_agg(upper(term), ',' order by length(term) desc, term)) as hits
    from hits group by doc_id""",
)
def p8_keyword_table(spark, sf_dir):
    """All longer words of the corpus (tens of thousands) as the keyword table, the longest first."""
    texts = docs(spark, sf_dir).select("doc_id", "text")
    terms = texts.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(TERM), F.lit(0)))).alias("keyword"))
    terms = terms.distinct().withColumn("place", -F.length("keyword").cast("bigint"))
    found = keywords.match_keyword_table(texts, "text", terms, order="place")
    return found.select("doc_id", big(F.size("matched_keywords")).alias("n_hits"), F.md5(F.array_join("matched_keywords", ",")).alias("hits"))


@query(
    "p9_default_keyword_match",
    "select doc_id, 'AI' as matched_keywords from documents where text <> '' and contains(lower(text), 'ai')",
)
def p9_default_keyword_match(spark, sf_dir):
    found = search.match_keywords(docs(spark, sf_dir), "text")
    return found.select("doc_id", joined("matched_keywords").alias("matched_keywords"))


@query(
    "p7_length_filter",
    f"select doc_id, length({collapse_sql('text')})::bigint as n from documents where length({collapse_sql('text')}) >= 100",
)
def p7_length_filter(spark, sf_dir):
    text = {"n": big(F.length(csv_safe("text")))}
    return rows.keep_computed(docs(spark, sf_dir), text, lambda row: row["n"] >= 100).select("doc_id", "n")


@query(
    "p2_tag_by_term",
    """select l_orderkey, l_linenumber, 'term ' || l_returnflag as search_query from lineitem
    union all select l_orderkey, l_linenumber, 'any' from lineitem""",
)
def p2_tag_by_term(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    flagged = tag_query(items, F.concat(F.lit("term "), F.col("l_returnflag"))).drop("l_returnflag")
    return rows.union_all(flagged, tag_query(items, "any").drop("l_returnflag"))


@query(
    "p10_body_missing",
    """select page_id, (page_id % 4 in (0, 1)) as missing from pages""",
)
def p10_body_missing(spark, sf_dir):
    key = F.col("page_id") % 4
    pages = table(spark, sf_dir, "pages").select(
        "page_id",
        F.when(key == 0, F.lit(" \n")).when(key == 2, F.lit("x")).when(key == 3, F.lit("")).alias("article_text"),
        F.when(key == 3, F.lit(" ")).otherwise(F.col("url")).alias("article_url"),
    )
    return pages.select("page_id", rows.body_missing().alias("missing"))


@query(
    "p11_article_id",
    """select o_orderkey, case o_orderkey % 3 when 0 then o_orderkey::varchar
        when 1 then o_custkey::varchar end as article_id from orders""",
)
def p11_article_id(spark, sf_dir):
    from gleanery.functions.urls import article_id

    key = F.col("o_orderkey") % 3
    region = F.when(key == 0, F.concat(F.lit(" "), F.col("o_orderkey").cast("string"))).otherwise(F.lit(" "))
    url = F.concat(
        F.when(key == 1, F.lit("https://x.example/article/")).otherwise(F.lit("https://x.example/other/")),
        F.col("o_custkey").cast("string"),
        F.lit("/view"),
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", article_id(region, url).alias("article_id"))


JOB_SEARCH = '("small ring" OR "BOX" OR "red widget")'


@query(
    "p12_job_search",
    """select p_partkey, p_name, p_brand from part
    where (contains(lower(p_name), 'small ring') or contains(lower(p_name), 'box') or contains(lower(p_name), 'red widget'))
      and (contains(lower(p_brand), 'brand#1') or contains(lower(p_brand), 'brand#2'))
      and p_type <> 'NONE' and p_size > 5 and p_size % 3 + 1 = 2
    order by p_partkey limit 1000""",
)
def p12_job_search(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(
        "p_partkey",
        "p_name",
        "p_brand",
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("company"),
        F.col("p_type").alias("location"),
        F.lpad(F.col("p_size").cast("string"), 4, "0").alias("published_at"),
        (F.col("p_size") % 3 + 1).cast("string").alias("work_type"),
        F.col("p_partkey").alias("ord"),
    )
    found = search.search_jobs(
        parts,
        title=JOB_SEARCH,
        companies=["Brand#1", "BRAND#2"],
        published_after="0005",
        work_type="2",
        rows=1000,
    )
    return found.select("p_partkey", "p_name", "p_brand")


_EXPRESSION = '("small ring" OR box OR (red AND NOT "red widget")) AND NOT (large NOT bolt)'


@query(
    "p12_title_expression",
    """select p_partkey, p_name from part where
    (contains(lower(p_name), 'small ring') or contains(lower(p_name), 'box')
        or (contains(lower(p_name), 'red') and not contains(lower(p_name), 'red widget')))
    and not (contains(lower(p_name), 'large') and not contains(lower(p_name), 'bolt'))""",
)
def p12_title_expression(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", F.col("p_name").alias("title"))
    return search.search_jobs(parts, title=_EXPRESSION).select("p_partkey", "p_name")


@query(
    "p12_stored_expressions",
    """select p_partkey, case p_partkey % 4
        when 0 then contains(lower(p_name), lower(split_part(p_name, ' ', 1))) and not contains(lower(p_name), 'box')
        when 1 then contains(lower(p_name), 'red') or contains(lower(p_name), 'ring') and contains(lower(p_name), 'small')
        when 2 then true end as matches
    from part""",
)
def p12_stored_expressions(spark, sf_dir):
    """A search expression in each row; one in four cannot be read."""
    kind = F.col("p_partkey") % 4
    first = F.concat(F.lit('"'), F.split("p_name", " ")[0], F.lit('" NOT box'))
    own = F.when(kind == 0, first).when(kind == 1, "red OR ring AND small").when(kind == 2, " ").otherwise("(red OR")
    return table(spark, sf_dir, "part").select("p_partkey", matches_stored_expression("p_name", own).alias("matches"))


def articles(spark, sf_dir):
    """Documents as press articles."""
    return docs(spark, sf_dir).select(
        "doc_id",
        F.col("doc_id").alias("ord"),
        F.col("source").alias("title"),
        F.col("text").alias("article_text"),
        F.col("lang").alias("language"),
        F.concat(F.lit("by "), "source").alias("authors"),
        F.col("source").alias("issue_cid"),
        F.upper("lang").alias("issue_country"),
        F.col("source").alias("section"),
        F.concat(F.lit("2024-01-"), F.lpad((F.col("doc_id") % 28 + 1).cast("string"), 2, "0")).alias("issue_date"),
    )


@query(
    "p13_article_search",
    f"""with f as (
        select doc_id, lower({collapse_sql('text')}) as body from documents
        where contains(lower(text), 'the') and contains('by ' || source, 'src1') and lang in ('en', 'fr')
          and doc_id % 28 + 1 between 5 and 20)
    select min(doc_id) as doc_id from f group by body""",
)
def p13_article_search(spark, sf_dir):
    found = search.search_articles(
        articles(spark, sf_dir),
        text="THE",
        author="Src1",
        languages="en, FR",
        countries="en,fr",
        start_date="2024-01-05",
        stop_date="2024-01-20",
        hide_same=True,
    )
    return found.select("doc_id")


@query(
    "p13_article_count",
    "select count(*)::bigint as n from documents where contains(lower(text), 'the') and lang = 'en'",
)
def p13_article_count(spark, sf_dir):
    found = search.search_articles(articles(spark, sf_dir), text="the", languages="en")
    return found.agg(F.count(F.lit(1)).cast("bigint").alias("n"))


NEEDLES = ("the", "The ", "src1", "licensed under", ". a", "a b", "in", "zzzz")
_NEEDLES = ", ".join(f"({quote(n)})" for n in NEEDLES)


def article_index(spark, sf_dir):
    """The articles, and a stored index of their titles and texts."""
    rows, folder = articles(spark, sf_dir), work_folder(spark)
    trigrams.write_index(rows, folder, ["title", "article_text"])
    return rows, trigrams.read_index(spark, folder)


@query(
    "p13_indexed_needles",
    f"""select needle, doc_id from documents, (values {_NEEDLES}) n(needle)
    where contains(lower(text), lower(needle)) or contains(lower(source), lower(needle))""",
)
def p13_indexed_needles(spark, sf_dir):
    rows, index = article_index(spark, sf_dir)
    return trigrams.find_texts(rows, index, NEEDLES, ["title", "article_text"]).select("needle", "doc_id")


@query(
    "p13_indexed_search",
    f"""with f as (
        select doc_id, lower({collapse_sql('text')}) as body from documents
        where contains(lower(text), 'licensed') and contains('by ' || source, 'src') and lang in ('en', 'fr'))
    select min(doc_id) as doc_id from f group by body""",
)
def p13_indexed_search(spark, sf_dir):
    rows, index = article_index(spark, sf_dir)
    criteria = {"author": "Src", "languages": "en, FR", "hide_same": True}
    return trigrams.search_indexed(rows, index, text="Licensed", **criteria).select("doc_id")


@query(
    "p14_past_day",
    """select event_id from events, (select max(ts) as as_of from events)
    where ts >= as_of - interval 86400 second and ts <= as_of""",
)
def p14_past_day(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    recent = search.within_last(events, "ts", "r86400", events.agg(F.max("ts")).scalar())
    return search.sort_posts(recent, "recent", time_col="ts", tie="event_id").select("event_id")


# ---- de-duplication ----


@query(
    "d3_job_dedupe",
    """with j as (select doc_id, source, lang, text from documents)
    select doc_id, source, lang from j
    qualify row_number() over (partition by lower(source), lower(lang), lower(text) order by doc_id) = 1""",
)
def d3_job_dedupe(spark, sf_dir):
    shout = F.col("doc_id") % 2 == 0
    jobs = docs(spark, sf_dir).select(
        F.col("doc_id").alias("ord"),
        F.col("source").alias("url"),
        F.when(shout, F.upper("lang")).otherwise(F.col("lang")).alias("title"),
        F.lit(None).cast("string").alias("company"),
        F.col("text").alias("location"),
    )
    return dedupe.dedupe_jobs(jobs).select(
        F.col("ord").alias("doc_id"), F.col("url").alias("source"), F.lower("title").alias("lang")
    )


@query(
    "d4_first_per_key",
    """select l_partkey, l_orderkey, l_linenumber, l_quantity from lineitem
    qualify row_number() over (partition by l_partkey order by l_orderkey, l_linenumber) = 1""",
)
def d4_first_per_key(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_quantity")
    # Lines of an order may share a number: the quantity decides, so that every run keeps the same one.
    return dedupe.first_wins(items, "l_partkey", ["l_orderkey", "l_linenumber", "l_quantity"])


@query(
    "d5_last_per_key",
    """select user_id, event_id, event_type from events
    qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""",
)
def d5_last_per_key(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts")
    return joins.latest_by_id(
        events.withColumn("user_key", F.col("user_id").cast("string")), "user_key", ["ts", "event_id"]
    ).select("user_id", "event_id", "event_type")


@query(
    "d6_run_counters",
    """select count(*)::bigint as raw, count(distinct lower(text))::bigint as unique_rows,
        count(*) filter (contains(lower(text), 'ai'))::bigint as matched from documents""",
)
def d6_run_counters(spark, sf_dir):
    source = docs(spark, sf_dir).select("doc_id", F.lower("text").alias("k"))
    unique = dedupe.first_wins(source.withColumn("digest", F.sha2("k", 256)), "digest", "doc_id")
    counts = source.agg(
        F.count("*").alias("raw"), F.count(F.when(F.contains("k", F.lit("ai")), 1)).alias("matched")
    )
    both = counts.unionByName(unique.agg(F.count("*").alias("unique_rows")), allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in ("raw", "unique_rows", "matched")])


# ---- limits and stop rules ----


@query("l1_first_rows", "select event_id from events order by ts, event_id limit 500")
def l1_first_rows(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("ts", "event_id")
    return limits.first_rows(events, 500, "ts", "event_id").select("event_id")


@query(
    "l1_text_order",
    "select event_id, event_type from events order by event_type, props, event_id limit 3000",
)
def l1_text_order(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "props")
    return limits.first_rows(events, 3000, "event_type", "props", "event_id").select("event_id", "event_type")


@query(
    "l1_large_limit",
    """select l_orderkey, l_linenumber from lineitem
    qualify row_number() over (order by l_orderkey, l_linenumber) <= 150000""",
)
def l1_large_limit(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return limits.first_rows(items, 150_000, "l_orderkey", "l_linenumber")


@query(
    "l2_first_per_user",
    """select user_id, event_id from events
    qualify row_number() over (partition by user_id order by ts, event_id) <= 50""",
)
def l2_first_per_user(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts")
    return limits.first_per_key(events, "user_id", 50, "ts", "event_id").select("user_id", "event_id")


@query(
    "l3_preview",
    f"""with p as (select doc_id, {JOB_TEXT_SQL} as d, string_split(text, chr(10)) as ls, source, lang from documents order by doc_id limit 20),
    j as (select *, array_to_string(ls[1:3], '; ') as r from p)
    select substr(lang || ' query', 1, 36) as Query, substr(source || d, 1, 40) as Title, '-' as Company,
        substr(d, 1, 24) as Location, substr(d, 1, 19) as Published,
        case when length(r) > 60 then substr(r, 1, 59) || '…' else r end as Responsibilities, '-' as Skills from j""",
)
def l3_preview(spark, sf_dir):
    jobs = docs(spark, sf_dir).select(
        F.col("doc_id").alias("ord"),
        F.concat("lang", F.lit(" query")).alias("search_query"),
        F.concat("source", job_text()).alias("title"),
        F.lit("").alias("company"),
        job_text().alias("location"),
        job_text().alias("published_at"),
        F.split("text", "\n").alias("responsibilities"),
        F.array().cast("array<string>").alias("skills"),
    )
    return limits.preview(jobs)


@query("l3_hidden_rows", "select count(*) - 20 as more_rows from documents")
def l3_hidden_rows(spark, sf_dir):
    return limits.hidden_rows(docs(spark, sf_dir))


@query(
    "l3_preview_lists",
    """with p as (select doc_id, string_split(text, ' ') as ws from documents),
    j as (select doc_id, array_to_string(ws[1:5], '; ') as r from p)
    select doc_id, case when length(r) > 24 then substr(r, 1, 23) || '…' else r end as cell from j""",
)
def l3_preview_lists(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", preview_list(F.split("text", " "), 5, 24).alias("cell"))


@query(
    "l4_batches",
    """with n as (select doc_id, row_number() over (order by doc_id * 7919 % 1000003, doc_id) - 1 as i from documents)
    select doc_id, i // 20 as batch_id, i % 20 as batch_pos from n""",
)
def l4_batches(spark, sf_dir):
    # Sparse, shuffled order values exercise the bucket arithmetic.
    ordered = docs(spark, sf_dir).select(
        "doc_id", ((F.col("doc_id") * 7919 % 1000003) * 4294967296 + F.col("doc_id")).alias("ord")
    )
    return limits.batch_ids(ordered, 20).select("doc_id", "batch_id", "batch_pos")


@query(
    "l4_batches_per_key",
    """with n as (select event_id, event_type,
        row_number() over (partition by event_type order by event_id) - 1 as i from events)
    select event_id, event_type, i // 5 as batch_id, i % 5 as batch_pos from n""",
)
def l4_batches_per_key(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return limits.batch_ids(events, 5, "event_id", ["event_type"])


@query(
    "l5_stop_at_empty_page",
    """with c as (select event_id // 25 as page, event_id, event_type from events),
    n as (select page, count(*) filter (event_type = 'purchase') as k from c group by page),
    s as (select coalesce(min(page) filter (k = 0), 1e12::bigint) as stop from n)
    select page, event_id from c, s where event_type = 'purchase' and page < stop""",
)
def l5_stop_at_empty_page(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        F.floor(F.col("event_id") / 25).cast("bigint").alias("page"), "event_id", "event_type"
    )
    cards = events.where(F.col("event_type") == "purchase").select("page", "event_id")
    return limits.stop_at_empty_page(cards, events.select("page").distinct())


@query(
    "l6_passes_until_idle",
    """with p as (select dayofyear(ts) * 24 + hour(ts) as pass, user_id from events),
    f as (select user_id, min(pass) as pass from p group by user_id),
    k as (select pass, count(*) as new_keys from f group by pass),
    a as (select a.pass, coalesce(new_keys, 0) as new_keys, row_number() over (order by a.pass) as turn
          from (select distinct pass from p) a left join k on a.pass = k.pass),
    i as (select *, turn - coalesce(max(case when new_keys > 0 then turn end) over (order by turn), 0) as idle_run from a),
    s as (select min(turn) filter (idle_run >= 3) as stop from i)
    select pass::bigint as pass, new_keys::bigint as new_keys, idle_run::bigint as idle_run
    from i, s where stop is null or turn <= stop""",
)
def l6_passes_until_idle(spark, sf_dir):
    seen = table(spark, sf_dir, "events").select(
        (F.dayofyear("ts") * 24 + F.hour("ts")).cast("bigint").alias("pass"), "user_id"
    )
    return limits.passes_until_idle(seen, seen.select("pass").distinct(), key="user_id", pass_col="pass")


# ---- joins ----


@query(
    "j1_hits_with_metadata",
    """with m as (select o_custkey, o_orderkey, o_totalprice from orders
        qualify row_number() over (partition by o_custkey order by o_orderkey desc) = 1)
    select c_custkey, o_orderkey, o_totalprice from customer join m on c_custkey = o_custkey""",
)
def j1_hits_with_metadata(spark, sf_dir):
    hits = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_custkey").cast("string").alias("id"))
    meta = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("id"), "o_orderkey", "o_totalprice"
    )
    latest = joins.latest_by_id(meta, "id", "o_orderkey")
    return joins.inner_by_id(hits, latest, "id").select("c_custkey", "o_orderkey", "o_totalprice")


@query(
    "j2_optional_detail",
    """select d.doc_id, coalesce(l.quality, -1)::bigint as quality from documents d
    left join labels l on d.doc_id = l.doc_id""",
)
def j2_optional_detail(spark, sf_dir):
    left = docs(spark, sf_dir).select("doc_id")
    right = table(spark, sf_dir, "labels").select("doc_id", "quality")
    found = joins.left_by_id(left, right, "doc_id")
    return found.select("doc_id", big(F.coalesce("quality", F.lit(-1))).alias("quality"))


@query(
    "j2_repeated_details",
    """select d.doc_id, coalesce(l.quality, -1)::bigint as quality from documents d
    left join labels l on d.doc_id = l.doc_id""",
)
def j2_repeated_details(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    older = labels.select("doc_id", (F.col("quality") + 7).alias("quality"), F.lit(0).alias("turn"))
    right = older.unionByName(labels.withColumn("turn", F.lit(1)))
    found = joins.left_by_id(docs(spark, sf_dir).select("doc_id"), right, "doc_id", "turn")
    return found.select("doc_id", big(F.coalesce("quality", F.lit(-1))).alias("quality"))


@query(
    "j3_not_completed",
    """select doc_id from documents where doc_id not in (select doc_id from labels where quality = 1)""",
)
def j3_not_completed(spark, sf_dir):
    hits = docs(spark, sf_dir).select("doc_id", F.col("doc_id").cast("string").alias("region_id"))
    stored = table(spark, sf_dir, "labels").select(
        F.concat(F.lit(" "), F.col("doc_id").cast("string")).alias("region_id"),
        F.when(F.col("quality") == 1, F.lit("body")).otherwise(F.lit(" ")).alias("article_text"),
        F.col("doc_id").alias("ord"),
    )
    return joins.not_completed(hits, stored).select("doc_id")


@query(
    "j5_results_by_row_id",
    "select d.doc_id, coalesce(l.toxic::varchar, 'none') as verdict from documents d left join labels l using (doc_id)",
)
def j5_results_by_row_id(spark, sf_dir):
    results = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").cast("string").alias("verdict"))
    return joins.by_row_id(docs(spark, sf_dir).select("doc_id"), results, "doc_id", "verdict", F.lit("none"))


_URL_SQL = """with a as (select page_id, case when page_id % 2 = 0 then url
            when starts_with(url, 'https://www.') then replace(url, '://www.', '://cdn.')
            else replace(url, '://', '://www.') end as link from pages),
    v as (select page_id, link, 1 as i, link as cand from a
        union all select page_id, link, 2, regexp_replace(link, '://cdn\\.', '://') from a where contains(link, '://cdn.')
        union all select page_id, link, 3, case when contains(link, '://www.') then replace(link, '://www.', '://')
            else replace(link, '://', '://www.') end from a),
    b as (select v.page_id, v.link, p.url, p.page_id as stored from v join pages p on p.url = v.cand
        qualify row_number() over (partition by v.page_id order by i) = 1)
    select a.page_id, a.link, coalesce(b.url, '') as stored_url, coalesce('body ' || b.stored, '') as body
    from a left join b on a.page_id = b.page_id"""


@query("j7_candidate_urls", _URL_SQL)
def j7_candidate_urls(spark, sf_dir):
    return candidate_urls(spark, sf_dir, 1)


@query("j7_repeated_pages", _URL_SQL)
def j7_repeated_pages(spark, sf_dir):
    return candidate_urls(spark, sf_dir, 3)


def candidate_urls(spark, sf_dir, copies):
    """Links to pages that are stored several times; the last copy has the body, of pages with one link that of the last page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    link = (
        F.when(F.col("page_id") % 2 == 0, F.col("url"))
        .when(F.col("url").startswith("https://www."), F.replace("url", F.lit("://www."), F.lit("://cdn.")))
        .otherwise(F.replace("url", F.lit("://"), F.lit("://www.")))
    )
    stored = pages.withColumn("turn", F.explode(F.sequence(F.lit(1), F.lit(copies)))).select(
        "url", "turn", "page_id", F.concat(F.when(F.col("turn") == copies, "body ").otherwise("old "), F.col("page_id").cast("string")).alias("body")
    )
    found = joins.by_candidate_url(pages.select("page_id", link.alias("url")), stored, order=["turn", "page_id"])
    return found.select("page_id", F.col("url").alias("link"), "stored_url", "body")


@query(
    "u1_union_of_terms",
    """select 'customer' as term, c_custkey as id, c_name as name, null as extra from customer
    union all select 'supplier', s_suppkey, s_name, null from supplier
    union all select 'part', p_partkey, p_name, p_brand from part""",
)
def u1_union_of_terms(spark, sf_dir):
    def part(name, key, label, *more):
        return tag_query(
            table(spark, sf_dir, name).select(F.col(key).alias("id"), F.col(label).alias("name"), *more), name
        ).withColumnRenamed("search_query", "term")

    return rows.union_all(
        part("customer", "c_custkey", "c_name"),
        part("supplier", "s_suppkey", "s_name"),
        part("part", "p_partkey", "p_name", F.col("p_brand").alias("extra")),
    )


@query(
    "s9_search_terms",
    f"""with w as (select doc_id, unnest(string_split(text, '. ')) as w,
        generate_subscripts(string_split(text, '. '), 1) - 1 as i from documents),
    t as (select doc_id, i, {strip_sql("case when i % 4 = 1 then '# ' || w else w end")} as term from w)
    select doc_id, i::bigint as ord, term from t where term <> '' and not starts_with(term, '#')
    qualify row_number() over (partition by doc_id, lower(term) order by i) = 1""",
)
def s9_search_terms(spark, sf_dir):
    lines = docs(spark, sf_dir).select("doc_id", F.posexplode(F.split("text", r"\. ", -1)).alias("ord", "w"))
    value = F.when(F.col("ord") % 4 == 1, F.concat(F.lit("# "), "w")).otherwise(F.concat(F.lit(" "), "w"))
    terms = clean_terms(lines.withColumn("value", value), keys=("doc_id",))
    return terms.select("doc_id", big("ord").alias("ord"), "term")


@query(
    "s10_state_rows",
    """select o_custkey::varchar as region_id, o_orderkey as ord, o_orderstatus as article_text from orders
    qualify row_number() over (partition by o_custkey order by o_orderkey desc) = 1""",
)
def s10_state_rows(spark, sf_dir):
    stored = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("region_id"),
        F.col("o_orderkey").alias("ord"),
        F.col("o_orderstatus").alias("article_text"),
    )
    return joins.latest_by_id(stored, "region_id", "ord")


@query("s9_default_term", f"select 0::bigint as ord, {quote(fv.DEFAULT_TITLE_QUERY)} as term")
def s9_default_term(spark, sf_dir):
    """A file of comments and blank lines, one line for each document, has no term."""
    path = f"{work_folder(spark)}/terms"
    lines = docs(spark, sf_dir).select(F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("# "), "source")).otherwise(F.lit("  ")).alias("value"))
    lines.write.text(path)
    return read_terms(spark, path).select(big("ord").alias("ord"), "term")


@query("s10_stored_table", "select o_orderkey as ord, o_custkey::varchar as region_id from orders")
def s10_stored_table(spark, sf_dir):
    """A table that is not there yet is empty; a stored one is read as of its last version."""
    root, schema = work_folder(spark), "ord bigint, region_id string"
    missing = tables.read_table(spark, f"{root}/none", schema)
    stored = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("ord"), F.col("o_custkey").cast("string").alias("region_id"))
    tables.write_next_version(spark, stored.limit(0), root)
    tables.write_next_version(spark, stored, root)
    return tables.read_table(spark, root, schema).unionByName(missing)


# ---- sinks and maintenance ----


@query(
    "k1_csv_edge",
    """select doc_id::varchar as doc_id, array_to_string(string_split(text, chr(10)), '; ') as lines,
        case when lang = 'en' then source else '' end as source,
        case when lang = 'en' then 'True' else 'False' end as english from documents""",
)
def k1_csv_edge(spark, sf_dir):
    frame = docs(spark, sf_dir).select(
        "doc_id",
        F.split("text", "\n").alias("lines"),
        F.when(F.col("lang") == "en", F.col("source")).alias("source"),
        (F.col("lang") == "en").alias("english"),
    )
    return tables.csv_edge(frame)


def order_versions(spark, sf_dir):
    """Orders as stored rows (repeated ids, some without id) and newer rows from customers."""
    stored = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ord"),
        F.when(F.col("o_custkey") % 11 != 0, F.col("o_custkey").cast("string")).alias("region_id"),
        F.col("o_orderstatus").alias("article_text"),
        F.col("o_orderpriority").alias("note"),
    )
    new = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("ord"),
        F.col("c_custkey").cast("string").alias("region_id"),
        F.col("c_name").alias("article_text"),
    )
    return stored, new


_UPSERT_CTES = """
    old as (select o_orderkey as ord, case when o_custkey % 11 <> 0 then o_custkey::varchar end as region_id,
        o_orderstatus as article_text, o_orderpriority as note from orders),
    fresh as (select c_custkey as ord, c_custkey::varchar as region_id, c_name as article_text from customer),
    last_old as (select region_id, max(ord) as target from old where region_id is not null group by region_id)"""


_UPSERT_SQL = f"""with {_UPSERT_CTES}
    select o.ord, o.region_id, case when l.target is not null then f.article_text else o.article_text end as article_text, o.note
    from old o left join (last_old l join fresh f using (region_id)) on o.ord = l.target
    union all
    select f.ord + (select max(ord) + 1 from old), f.region_id, f.article_text, null from fresh f
    where f.region_id not in (select region_id from last_old)"""


@query("m2_upsert", _UPSERT_SQL)
def m2_upsert(spark, sf_dir):
    return tables.upsert(*order_versions(spark, sf_dir))


@query("m2_versioned_table", _UPSERT_SQL)
def m2_versioned_table(spark, sf_dir):
    stored, new = order_versions(spark, sf_dir)
    root = work_folder(spark)
    tables.write_next_version(spark, stored, root)
    tables.upsert_table(spark, root, new, stored.schema)
    return tables.read_table(spark, root, stored.schema)


@query("k2_append_runs", "select doc_id, lang from documents union all select doc_id, lang from documents where lang = 'en'")
def k2_append_runs(spark, sf_dir):
    # A later run appends what it finds; nothing is de-duplicated.
    found = docs(spark, sf_dir).select("doc_id", "lang")
    path = work_folder(spark)
    tables.append_rows(found, path)
    tables.append_rows(found.where(F.col("lang") == "en"), path)
    return spark.read.schema(found.schema).parquet(path)


@query("u3_except_by_key", "select c_custkey from customer where c_custkey not in (select o_custkey from orders where o_orderstatus = 'P')")
def u3_except_by_key(spark, sf_dir):
    pending = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "P")
    ordered = pending.select(F.col("o_custkey").alias("c_custkey"))
    return joins.except_by_id(table(spark, sf_dir, "customer").select("c_custkey"), ordered, "c_custkey")


@query(
    "j4_changes_and_additions",
    f"""with {_UPSERT_CTES}
    select f.region_id, coalesce(l.target, -1) as target from fresh f left join last_old l using (region_id)""",
)
def j4_changes_and_additions(spark, sf_dir):
    marked = tables.mark_new(*order_versions(spark, sf_dir))
    return marked.select("region_id", F.coalesce("_target", F.lit(-1)).cast("bigint").alias("target"))


@query(
    "m1_incremental_rows",
    """with done as (select o_custkey from orders qualify row_number() over (partition by o_custkey order by o_orderkey desc) = 1 and o_orderstatus <> 'P')
    select c_custkey from customer where c_custkey not in (select o_custkey from done)""",
)
def m1_incremental_rows(spark, sf_dir):
    stored = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ord"),
        F.col("o_custkey").cast("string").alias("region_id"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).otherwise(F.lit("")).alias("article_text"),
    )
    hits = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_custkey").cast("string").alias("region_id"))
    return joins.not_completed(hits, stored).select("c_custkey")


_BACKFILL_SQL = """
    r as (select doc_id as ord, case when lang = 'en' then doc_id::varchar else '' end as region_id,
        case when lang = 'de' then '' else 'https://x.example/article/' || doc_id end as article_url,
        case when quality = 1 then 'old' else ' ' end as article_text
        from documents left join labels using (doc_id)),
    b as (select d.doc_id::varchar as id, text as body from documents d where lang in ('en', 'fr') and text <> ''),
    k as (select r.*, (trim(article_text) = '' and article_url <> '') as missing,
        case when region_id <> '' then region_id when article_url <> '' then ord::varchar end as id from r)"""


_FILLED_SQL = f"""with {_BACKFILL_SQL}
    select ord, region_id, article_url,
        case when missing and body is not null then body else article_text end as article_text,
        case when not missing then 'kept' when body is not null then 'filled' else 'missing' end as fill_state
    from k left join b on k.missing and k.id = b.id"""


@query("m3_backfill", _FILLED_SQL)
def m3_backfill(spark, sf_dir):
    return tables.backfill(*backfill_inputs(spark, sf_dir))


@query("m3_backfill_repeated_details", _FILLED_SQL)
def m3_backfill_repeated_details(spark, sf_dir):
    stored, details = backfill_inputs(spark, sf_dir)
    older = details.withColumn("Blocks", F.array(F.struct(F.lit("text").alias("Role"), F.lit("older").alias("Text"))))
    blank = details.withColumn("Blocks", F.array(F.struct(F.lit("text").alias("Role"), F.lit(" ").alias("Text"))))
    bodies = details.where(F.col("Blocks")[0]["Text"] != "")
    turns = [older.join(bodies.select("Id"), "Id", "left_semi"), details, blank]
    repeated = [d.select("Id", "Blocks", F.lit(i).alias("turn")) for i, d in enumerate(turns)]
    return tables.backfill(stored, repeated[0].unionByName(repeated[1]).unionByName(repeated[2]), "turn")


@query("m3_backfill_table", f"select * exclude (fill_state) from ({_FILLED_SQL})")
def m3_backfill_table(spark, sf_dir):
    stored, details = backfill_inputs(spark, sf_dir)
    root = work_folder(spark)
    tables.write_next_version(spark, stored, root)
    tables.backfill_table(spark, root, details, stored.schema)
    return tables.read_table(spark, root, stored.schema)


def backfill_inputs(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    source = docs(spark, sf_dir)
    key, lang = F.col("doc_id").cast("string"), F.col("lang")
    stored = source.join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("ord"),
        F.when(lang == "en", key).otherwise(F.lit("")).alias("region_id"),
        F.when(lang == "de", F.lit("")).otherwise(F.concat(F.lit("https://x.example/article/"), key)).alias("article_url"),
        F.when(F.col("quality") == 1, F.lit("old")).otherwise(F.lit(" ")).alias("article_text"),
    )
    details = source.where(lang.isin("en", "fr")).select(
        key.alias("Id"), F.array(F.struct(F.lit("text").alias("Role"), F.col("text").alias("Text"))).alias("Blocks")
    )
    return stored, details


@query(
    "j6_backfill_counts",
    f"""with {_BACKFILL_SQL}
    select case when not missing then 'kept' when body is not null then 'filled' else 'missing' end as fill_state,
        count(*)::bigint as n
    from k left join b on k.missing and k.id = b.id group by 1""",
)
def j6_backfill_counts(spark, sf_dir):
    done = tables.backfill(*backfill_inputs(spark, sf_dir))
    return done.groupBy("fill_state").agg(F.count(F.lit(1)).cast("bigint").alias("n"))
