"""Text, number, link, date and array functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanery import fixed_values as fv
from gleanery.functions import arrays as a
from gleanery.functions import dates as d
from gleanery.functions import html as h
from gleanery.functions import numbers as n
from gleanery.functions import text as t
from gleanery.functions import urls as u
from gleanery.operators.rows import with_collection_time
from gleanery.plans.press import first_highlights
from gleanery.sources.pages import page_bodies

from .base import WS_CLASS, big, collapse_sql, joined, query, strip_sql, table


def docs(spark, sf_dir, *columns):
    return table(spark, sf_dir, "documents").select("doc_id", *columns)


@query(
    "x1_content_lines",
    f"""with r as (
        select doc_id, replace(replace(replace(text, '. ', '.' || chr(13) || chr(10) || ' ' || chr(9) || '• '),
            chr(13) || chr(10), chr(10)), chr(13), chr(10)) as raw from documents),
    l as (select doc_id, unnest(string_split(raw, chr(10))) as line0,
                 generate_subscripts(string_split(raw, chr(10)), 1) - 1 as pos from r)
    select doc_id, pos::bigint as pos, trim({strip_sql('line0')}, ' -*•' || chr(9)) as line from l""",
)
def x1_content_lines(spark, sf_dir):
    raw = F.replace("text", F.lit(". "), F.lit(".\r\n \t• "))
    rows = docs(spark, sf_dir, F.posexplode(t.content_lines(raw, fv.LINE_STRIP_CHARS)).alias("pos", "line"))
    return rows.select("doc_id", big("pos").alias("pos"), "line")


def _page_text_sql(sep: str = " ") -> str:
    """Tags to ``sep`` and the references of the test pages decoded."""
    out = "regexp_replace(html, '<!--.*?-->|<(script|style)[^>]*>.*?</(script|style)>', ' ', 'gs')"
    out = f"regexp_replace({out}, '<[^>]+>', '{sep}', 'g')"
    for ref, char in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">")):
        out = f"replace({out}, '{ref}', '{char}')"
    return f"regexp_replace({out}, '&amp;?', '&', 'g')"


@query("x8_plain_text", f"select page_id, {collapse_sql(_page_text_sql())} as plain from pages")
def x8_plain_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", t.plain_text("html").alias("plain"))


@query(
    "x8_text_with_signs",
    """select doc_id, 'p < 5 for ai & x > 3 ' || source || case when lang = 'en' then ' é' else '' end as plain from documents""",
)
def x8_text_with_signs(spark, sf_dir):
    """Signs that begin no tag are text; comments, scripts, styles and templates are not shown."""
    accent = F.when(F.col("lang") == "en", F.lit("&eacute;")).otherwise(F.lit(""))
    raw = F.concat(
        F.lit("<!-- no <b> --><p>p < 5 for ai &amp; x > 3</p>\n<script>if (a<b) {}</script><style>p{}</style> <b>"),
        "source", F.lit("</b><template>none</template> "), accent,
    )
    return docs(spark, sf_dir, t.plain_text(raw).alias("plain"))


@query(
    "x9_entry_text",
    """select doc_id, source || chr(10) || chr(10) || text ||
        (case when lang = 'en' then chr(10) || chr(10) || text else '' end) as body from documents
    where text <> ''""",
)
def x9_entry_text(spark, sf_dir):
    parts = a.entry_text(
        F.array("source", F.lit(""), "text"), F.when(F.col("lang") == "en", F.array("text", F.lit(None)))
    )
    return docs(spark, sf_dir, parts.alias("body")).where(F.col("body") != "")


_MIXED_DATES = """case (o_orderkey % 4)
    when 0 then strftime(o_orderdate, '%-m/%-d/%Y') when 1 then strftime(o_orderdate, '%m/%d/%y')
    when 2 then ' ' || strftime(o_orderdate, '%Y-%m-%d') else 'on ' || strftime(o_orderdate, '%Y-%m-%d') end"""


def _mixed_dates():
    key = F.col("o_orderkey") % 4
    return (
        F.when(key == 0, F.date_format("o_orderdate", "M/d/yyyy"))
        .when(key == 1, F.date_format("o_orderdate", "MM/dd/yy"))
        .when(key == 2, F.concat(F.lit(" "), F.date_format("o_orderdate", "yyyy-MM-dd")))
        .otherwise(F.concat(F.lit("on "), F.date_format("o_orderdate", "yyyy-MM-dd")))
    )


@query(
    "x17_iso_date",
    f"""with r as (select o_orderkey, {_MIXED_DATES} as raw from orders)
    select o_orderkey, raw, coalesce(
        strftime(case when regexp_full_match(trim(raw), '\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}')
            then try_strptime(trim(raw), '%m/%d/%Y') end, '%Y-%m-%d'),
        strftime(try_strptime(trim(raw), '%m/%d/%y'), '%Y-%m-%d'),
        strftime(try_strptime(trim(raw), '%Y-%m-%d'), '%Y-%m-%d'), trim(raw)) as iso from r""",
)
def x17_iso_date(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", _mixed_dates().alias("raw"))
    return rows.select("o_orderkey", "raw", d.iso_date("raw").alias("iso"))


@query(
    "x11_first_short_date",
    """select o_orderkey, case when o_orderkey % 3 = 2 then null
        else strftime(o_orderdate, '%Y-%m-%d') end as day from orders""",
)
def x11_first_short_date(spark, sf_dir):
    raw = F.when(F.col("o_orderkey") % 3 == 2, F.lit("no date 1/2/34567")).otherwise(
        F.concat("o_orderpriority", F.lit(" ("), F.date_format("o_orderdate", "M/d/yyyy"), F.lit(") 1/1/1999"))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", d.first_short_date(raw).alias("day"))


_LINK_SQL = """case event_type when 'click' then ' /feed/update/urn:li:activity:' || event_id || '/ '
    when 'view' then 'https://x.example/urn:li:activity:' || event_id when 'error' then '/in/' || user_id end"""


def event_links(spark, sf_dir):
    kind, eid = F.col("event_type"), F.col("event_id").cast("string")
    link = (
        F.when(kind == "click", F.concat(F.lit(" /feed/update/urn:li:activity:"), eid, F.lit("/ ")))
        .when(kind == "view", F.concat(F.lit("https://x.example/urn:li:activity:"), eid))
        .when(kind == "error", F.concat(F.lit("/in/"), F.col("user_id").cast("string")))
    )
    urn = F.when(kind == "purchase", F.concat(F.lit("urn:li:activity:p"), eid)).otherwise("none")
    return table(spark, sf_dir, "events").select("event_id", link.alias("link"), urn.alias("urn"))


@query(
    "x12_post_id",
    """select event_id, case when event_type in ('click', 'view') then event_id::varchar
        else 'p' || event_id end as post_id
    from events where event_type in ('click', 'view', 'purchase')""",
)
def x12_post_id(spark, sf_dir):
    rows = event_links(spark, sf_dir).select("event_id", u.post_id("link", "urn").alias("post_id"))
    return rows.where(F.col("post_id").isNotNull())


@query(
    "x13_absolute_links",
    f"""with l as (select event_id, trim({_LINK_SQL}) as link from events)
    select event_id, case when starts_with(link, '/feed/update/') then '{fv.POST_SITE}' || link else link end as url,
        case when starts_with(link, '/in/') then '{fv.POST_SITE}' || link else link end as profile from l""",
)
def x13_absolute_links(spark, sf_dir):
    return event_links(spark, sf_dir).select(
        "event_id", u.absolute("link", "/feed/update/").alias("url"), u.absolute("link", "/in/").alias("profile")
    )


@query(
    "x14_abbreviated_numbers",
    """select event_id, case event_type when 'click' then trunc(value * 1000)::bigint
        when 'view' then trunc(value * 1000000)::bigint when 'purchase' then event_id
        else 0 end::bigint as n from events""",
)
def x14_abbreviated_numbers(spark, sf_dir):
    kind, value = F.col("event_type"), F.col("value").cast("string")
    eid = F.col("event_id").cast("string")
    raw = (
        F.when(kind == "click", F.concat(value, F.lit("K")))
        .when(kind == "view", F.concat(F.lit(" "), value, F.lit("m")))
        .when(kind == "purchase", eid)
        .when(kind == "error", F.concat(F.lit("1,"), eid))
        .otherwise(F.lit("many"))
    )
    return table(spark, sf_dir, "events").select("event_id", n.abbreviated_number(raw).alias("n"))


_SPACED_SQL = "replace(replace(text, '. ', '.' || chr(160) || ' ' || chr(9)), ', ', ',' || chr(8232) || chr(65279) || ' ')"


def _spaced():
    return F.replace(
        F.replace("text", F.lit(". "), F.lit(".\u00a0 \t")), F.lit(", "), F.lit(",\u2028\ufeff ")
    )


@query("x15_collapse", f"select doc_id, {collapse_sql(_SPACED_SQL)} as clean from documents")
def x15_collapse(spark, sf_dir):
    return docs(spark, sf_dir, t.collapse(_spaced()).alias("clean"))


@query(
    "x16_csv_safe",
    f"select doc_id, {collapse_sql(f"replace({_SPACED_SQL}, chr(65279), '')")} as clean from documents",
)
def x16_csv_safe(spark, sf_dir):
    return docs(spark, sf_dir, t.csv_safe(_spaced()).alias("clean"))


_YEAR_SHAPES = [
    ("%Y-%m-%d", "yyyy-MM-dd"),
    ("%Y/%m/%d", "yyyy/MM/dd"),
    ("%d %b %Y", "dd MMM yyyy"),
    ("%d %B %Y", "dd MMMM yyyy"),
    ("Mon, %d %b %Y 10:11:12 +0200", "'Mon, 'dd MMM yyyy' 10:11:12 +0200'"),
    ("Tue, %d %b %Y 10:11:12 GMT", "'Tue, 'dd MMM yyyy' 10:11:12 GMT'"),
    ("%Y-%m-%dT10:11:12Z", "yyyy-MM-dd'T10:11:12Z'"),
    ("%Y-%m-%dT10:11:12-05:00", "yyyy-MM-dd'T10:11:12-05:00'"),
    ("%d/%m/%Y", "dd/MM/yyyy"),
    ("seen %Y somewhere", "'seen 'yyyy' somewhere'"),
    ("%Y-%m-%dx", "yyyy-MM-dd'x'"),
]


def dated_orders(spark, sf_dir):
    """Order dates written in many ways."""
    key = F.col("o_orderkey") % len(_YEAR_SHAPES)
    raw = None
    for i, (_, shape) in enumerate(_YEAR_SHAPES):
        raw = (F if raw is None else raw).when(key == i, F.date_format("o_orderdate", shape))
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", raw.alias("published"))


@query(
    "x18_parse_year",
    f"""select o_orderkey, case when o_orderkey % {len(_YEAR_SHAPES)} = 10 then null
            else year(o_orderdate) end::bigint as y,
        case when o_orderkey % {len(_YEAR_SHAPES)} in (8, 10) then null
            else year(o_orderdate) end::bigint as strict_y from orders""",
)
def x18_parse_year(spark, sf_dir):
    return dated_orders(spark, sf_dir).select(
        "o_orderkey",
        big(d.parse_year("published")).alias("y"),
        big(d.parse_year("published", strict_formats=True)).alias("strict_y"),
    )


@query(
    "p6_year_filter",
    f"""select o_orderkey from orders
    where o_orderkey % {len(_YEAR_SHAPES)} <> 10 and year(o_orderdate) >= 1996""",
)
def p6_year_filter(spark, sf_dir):
    return dated_orders(spark, sf_dir).where(d.parse_year("published") >= 1996).select("o_orderkey")


@query(
    "x19_feed_date",
    """select o_orderkey, case (o_orderkey % 7)
        when 0 then strftime(o_orderdate, '%d/%m/%Y')
        when 1 then strftime(o_orderdate + interval 1 day, '%d/%m/%Y')
        when 2 then strftime(o_orderdate, '%d/%m/%Y')
        when 3 then strftime(o_orderdate - interval 1 day, '%d/%m/%Y')
        when 4 then strftime(o_orderdate, '%d/%m/%Y')
        when 5 then strftime(o_orderdate, '%d/%m/%Y') else '' end as day from orders""",
)
def x19_feed_date(spark, sf_dir):
    shapes = [
        "'Mon, 'd MMM yyyy' 10:00:00 GMT'",
        "'Mon, 'd MMM yyyy' 23:30 EST'",
        "d MMM yyyy' 10:00:00 +0200'",
        "yyyy-MM-dd'T01:00:00+02:00'",
        "yyyy-MM-dd' 10:11:12'",
        "yyyy-MM-dd",
        "'week 'D",
    ]
    key = F.col("o_orderkey") % 7
    raw = None
    for i, shape in enumerate(shapes):
        raw = (F if raw is None else raw).when(key == i, F.date_format("o_orderdate", shape))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", raw.alias("raw"))
    return rows.select("o_orderkey", d.feed_date(F.lit(None).cast("string"), "raw").alias("day"))


@query(
    "x20_entry_author",
    """select doc_id, case when lang = 'en' then source || ', ' || lang
        when lang = 'fr' then source else '' end as author from documents""",
)
def x20_entry_author(spark, sf_dir):
    lang = F.col("lang")
    names = F.when(lang == "en", F.array(F.concat(F.lit(" "), "source"), F.lit(" "), "lang", F.lit(None)))
    single = F.when(lang != "de", F.when(lang == "fr", F.concat("source", F.lit(" "))).otherwise(F.lit("")))
    return docs(spark, sf_dir, a.entry_author(names, single).alias("author"))


@query(
    "x21_entry_categories",
    """with w as (select doc_id, unnest(string_split(text, ' ')) as w0,
        generate_subscripts(string_split(text, ' '), 1) as i from documents),
    u as (select doc_id, trim(w0, chr(10) || ' ') as w, min(i) as i from w
          where trim(w0, chr(10) || ' ') <> '' group by all)
    select doc_id, string_agg(w, ', ' order by i) as categories from u group by doc_id""",
)
def x21_entry_categories(spark, sf_dir):
    return docs(spark, sf_dir, F.array_join(a.entry_categories(F.split("text", " ")), ", ").alias("categories"))


@query(
    "x22_entry_link",
    """select page_id, case when page_id % 3 = 0 then url when page_id % 3 = 1 then 'alt:' || url
        else '' end as link from pages""",
)
def x22_entry_link(spark, sf_dir):
    key = F.col("page_id") % 3
    own = F.when(key == 0, F.concat(F.lit(" "), "url")).otherwise(F.lit(" "))
    others = F.when(key == 1, F.array(F.lit(None), F.lit(""), F.concat(F.lit("alt:"), F.col("url"), F.lit(" "))))
    return table(spark, sf_dir, "pages").select("page_id", a.entry_link(own, others).alias("link"))


def _soft():
    return F.replace(F.replace("text", F.lit("e"), F.lit("e\u00ad")), F.lit(". "), F.lit(".\u00a0"))


@query(
    "x23_press_text",
    f"select doc_id, {strip_sql('text')} as clean from documents",
)
def x23_press_text(spark, sf_dir):
    return docs(spark, sf_dir, t.press_text(F.concat(F.lit("\u00a0"), _soft())).alias("clean"))


_LINES = "unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as i"


@query(
    "x24_blocks_text",
    f"""with l as (select doc_id, {_LINES} from documents),
    k as (select doc_id, i, {strip_sql('line')} as line from l where i % 3 <> 0 and {strip_sql('line')} <> '')
    select d.doc_id, coalesce(string_agg(line, chr(10) || chr(10) order by i), '') as body
    from documents d left join k on d.doc_id = k.doc_id group by d.doc_id""",
)
def x24_blocks_text(spark, sf_dir):
    blocks = F.transform(
        F.split("text", "\n"),
        lambda x, i: F.struct(
            F.when((i + 1) % 3 == 0, F.lit("image")).otherwise(F.lit("text")).alias("Role"),
            F.concat(F.lit("\u00a0"), x, F.lit("\u00ad")).alias("Text"),
        ),
    )
    return docs(spark, sf_dir, a.blocks_text(blocks).alias("body"))


@query(
    "x25_join_list",
    f"""with l as (select doc_id, {_LINES} from documents),
    k as (select doc_id, i, {strip_sql('line')} as line from l where {strip_sql('line')} <> '')
    select d.doc_id, coalesce(string_agg(line, '; ' order by i), '') as items
    from documents d left join k on d.doc_id = k.doc_id group by d.doc_id""",
)
def x25_join_list(spark, sf_dir):
    lines = F.concat(F.split("text", "\n"), F.array(F.lit(None), F.lit("\u00ad")))
    return docs(spark, sf_dir, a.join_list(lines).alias("items"))


def _article_clean_sql(x: str) -> str:
    out = strip_sql(f"replace(replace({x}, chr(160), ' '), 'Â', ' ')")
    out = f"""case when contains({out}, '<') and contains({out}, '>')
        then regexp_replace({out}, '(<[/!?a-zA-Z][^>]*>)+', chr(10), 'g') else {out} end"""
    out = f"regexp_replace({out}, '[ \\t]+\\n', chr(10), 'g')"
    out = f"regexp_replace({out}, '\\n{{3,}}', chr(10) || chr(10), 'g')"
    return strip_sql(f"regexp_replace({out}, '[ \\t]{{2,}}', ' ', 'g')")


@query(
    "x26_article_clean",
    f"""with r as (select doc_id, '  <b>' || source || '</b> & Â' || replace(replace(text, chr(10), '  ' || chr(10) || chr(10) || chr(10) || chr(10)),
        '. ', '.   <p>') as raw from documents)
    select doc_id, {_article_clean_sql('raw')} as clean from r""",
)
def x26_article_clean(spark, sf_dir):
    body = F.replace(F.replace("text", F.lit("\n"), F.lit("  \n\n\n\n")), F.lit(". "), F.lit(".\u00a0  <p>"))
    raw = F.concat(F.lit("  <b>"), "source", F.lit("</b> &amp; &Acirc;"), body)
    return docs(spark, sf_dir, t.article_clean(raw).alias("clean"))


@query("x26_article_markup", "select doc_id, source || chr(10) || 'a < b' || chr(10) || lang as clean from documents")
def x26_article_markup(spark, sf_dir):
    raw = F.concat(
        F.lit("<p>"), "source", F.lit("</p><script>x();</script>a < b<!-- c --><i>"), "lang", F.lit("</i><style>b{}</style>")
    )
    return docs(spark, sf_dir, t.article_clean(raw).alias("clean"))


@query(
    "x27_strip_blocks",
    "select page_id, regexp_replace(html, '<(script|style)[^>]*>.*?</(script|style)>', '', 'gs') as kept from pages",
)
def x27_strip_blocks(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", h.strip_blocks("html").alias("kept"))


_P_TEXT = "regexp_replace(regexp_replace(piece, '(?s)</?(p|div|article|footer|nav|ul|h1|h2|h3|table|body|html|section)[ >].*', ''), '<[^>]+>', ' ', 'g')"
_P_DECODED = (
    f"regexp_replace(replace(replace(replace({_P_TEXT}, '&copy;', '©'), '&middot;', '·'), '&quot;', '\"'), '&amp;?', '&', 'g')"
)


@query(
    "x28_page_bodies",
    f"""with s as (select page_id, string_split(regexp_replace(html, '<(script|style)[^>]*>.*?</(script|style)>', '', 'gs'), '<p>') as ps from pages),
    p as (select page_id, unnest(ps) as piece, generate_subscripts(ps, 1) as i from s),
    c as (select page_id, i, {collapse_sql(_P_DECODED)} as para from p where i > 1),
    k as (select * from c where len(regexp_extract_all(para, '[^{WS_CLASS}]+')) >= 3),
    b as (select g.page_id, coalesce(string_agg(para, chr(10) || chr(10) order by i), '') as raw
          from pages g left join k on g.page_id = k.page_id group by g.page_id)
    select page_id, {_article_clean_sql('raw')} as body from b""",
)
def x28_page_bodies(spark, sf_dir):
    return page_bodies(table(spark, sf_dir, "pages").select("page_id", "html"))


@query(
    "x29_candidate_urls",
    """with u as (select page_id, 'https://cdn.' || regexp_replace(url, '^https?://', '') as url from pages
               union all select page_id, url from pages),
    p as (select *, regexp_extract(url, '^([a-z]+://)', 1) as scheme,
                 regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) as host,
                 regexp_extract(url, '^[a-z]+://[^/?#]*(.*)$', 1) as tail from u),
    c as (select page_id, url, scheme, tail, list_filter([host,
            case when starts_with(host, 'cdn.') then host[5:] end,
            case when starts_with(host, 'www.') then host[5:] else 'www.' || host end],
            lambda x: x is not null) as hosts from p)
    select page_id, url, array_to_string(list_transform(hosts, lambda h: scheme || h || tail), ' | ') as candidates from c""",
)
def x29_candidate_urls(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    cdn = F.concat(F.lit("https://cdn."), F.regexp_replace("url", "^https?://", ""))
    both = pages.withColumn("url", cdn).unionByName(pages)
    return both.select("page_id", "url", joined(u.candidate_urls("url")).alias("candidates"))


@query(
    "x30_string_list",
    """select event_id, case event_type when 'click' then event_type
        when 'view' then event_type || ' | ' || user_id else '' end as items from events""",
)
def x30_string_list(spark, sf_dir):
    kind = F.col("event_type")
    raw = (
        F.when(kind == "click", F.concat(F.lit('{"v": " '), kind, F.lit('"}')))
        .when(
            kind == "view",
            F.concat(
                F.lit('{"v": ["'), kind, F.lit('", null, " ", '), F.col("user_id").cast("string"), F.lit("]}")
            ),
        )
        .otherwise(F.lit('{"v": null}'))
    )
    rows = table(spark, sf_dir, "events").select("event_id", F.parse_json(raw).alias("v"))
    return rows.select("event_id", joined(a.string_list(F.col("v"), "$.v")).alias("items"))


@query(
    "x31_first_highlights",
    f"""with l as (select doc_id, {_LINES} from documents where lang = 'fr'),
    f as (select min(doc_id) as doc_id from documents where lang = 'fr')
    select (select count(*) from documents)::bigint as n,
        string_agg({strip_sql('line')}, '|' order by i) filter ({strip_sql('line')} <> '') as highlights
    from l join f using (doc_id)""",
)
def x31_first_highlights(spark, sf_dir):
    pages = docs(
        spark, sf_dir, F.when(F.col("lang") == "fr", F.split("text", "\n")).otherwise(F.array(F.lit(""))).alias("highlights")
    )
    rows = docs(spark, sf_dir).withColumn("highlights", first_highlights(pages, "doc_id"))
    return rows.groupBy("highlights").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@query(
    "x32_collection_time",
    "select event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') as collected from events",
)
def x32_collection_time(spark, sf_dir):
    rows = with_collection_time(table(spark, sf_dir, "events"), F.col("ts").cast("timestamp"))
    return rows.select("event_id", F.date_format("Date_Collected", "yyyy-MM-dd HH:mm:ss").alias("collected"))


@query(
    "d1_distinct_ignoring_case",
    """with w as (select doc_id, unnest(string_split(text, ' ')) as w,
        generate_subscripts(string_split(text, ' '), 1) as i from documents),
    u as (select * from w qualify row_number() over (partition by doc_id, lower(w) order by i) = 1)
    select doc_id, string_agg(w, ' ' order by i) as words from u group by doc_id""",
)
def d1_distinct_ignoring_case(spark, sf_dir):
    return docs(spark, sf_dir, F.array_join(a.distinct_ci(F.split("text", " ", -1)), " ").alias("words"))


@query(
    "d2_distinct_exact",
    """with w as (select doc_id, unnest(string_split(text, ' ')) as w,
        generate_subscripts(string_split(text, ' '), 1) as i from documents),
    u as (select doc_id, w, min(i) as i from w group by all)
    select doc_id, string_agg(w, ' ' order by i) as words from u group by doc_id""",
)
def d2_distinct_exact(spark, sf_dir):
    return docs(spark, sf_dir, F.array_join(a.distinct_exact(F.split("text", " ", -1)), " ").alias("words"))
