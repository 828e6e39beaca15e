"""Queries of the corpus operators over whole tables, with DuckDB twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe, licences, line_spread, minhash, packing, projections, repeats, runs, topk, toxicity, trie, url_filter, warc
from .common import small_batches

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return small_batches(spark).read.parquet(f"{sf_dir}/{name}.parquet")


TOP_K_SQL = """
with whole as (
    select vec_id, [floor(64 * x::double) for x in embedding] as v from embeddings
    where vec_id is not null and embedding is not null
      and len([x for x in embedding if x is null or not isfinite(x)]) = 0
),
scored as (
    select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
    from whole q join whole c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0
)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score
from scored qualify rank <= 20
"""


@query("op2_exact_topk", TOP_K_SQL)
def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


WARC_SQL = """
with p as (
    select page_id, coalesce(html, '') as html, strlen(coalesce(html, '')) as payload_bytes from pages
),
first as (
    select *, max(page_id) over (partition by html) as top from p
)
select page_id, payload_bytes, sha1(html) as payload_digest,
    case when payload_bytes >= 1000 and top <> page_id then 'revisit' else 'response' end as record_type,
    case when payload_bytes >= 1000 and top <> page_id then top end as refers_to
from first
"""


@query("op4_warc_archives", WARC_SQL)
def op4_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


LINE_SPREAD_SQL = """
with texts as (
    select *, lower(trim(regexp_replace(text, '[ \\t\\n\\v\\f\\r]+', ' ', 'g'), ' ')) as same
    from documents where text is not null
),
sited as (select *, min(source) over (partition by same) as site from texts),
raw as (
    select doc_id, site, unnest(string_split(text, chr(10))) as line,
           generate_subscripts(string_split(text, chr(10)), 1) as pos
    from sited
),
lines as (select *, lower(trim(regexp_replace(line, '[ \\t\\n\\v\\f\\r]+', ' ', 'g'), ' ')) as plain from raw),
spread as (
    select plain from lines where plain <> '' group by plain having count(distinct site) >= 10
),
cut as (
    select doc_id, count(*) as n_lines, count(s.plain) as n_removed,
        coalesce(string_agg(line, chr(10) order by pos) filter (s.plain is null), '') as kept
    from lines l left join spread s using (plain) group by doc_id
)
select d.doc_id, coalesce(n_lines, 0)::bigint as n_lines, coalesce(n_removed, 0)::bigint as n_removed,
    sha256(coalesce(kept, '')) as kept_sha256
from documents d left join cut using (doc_id)
"""


@query("op7_line_spread", LINE_SPREAD_SQL)
def op7_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_spread.line_spread_report(table(spark, sf_dir, "documents"))


def _templates_sql() -> str:
    rows = [(name, " ".join(licences.words(text))) for name, texts in licences.TEMPLATES.items() for text in texts]
    return ", ".join(f"('{name}', '{text}')" for name, text in rows)


def _bigrams_sql(found: str) -> str:
    return f"list_distinct([{found}[k] || ' ' || {found}[k + 1] for k in range(1, len({found}))])"


LICENCE_SQL = f"""
with lines as (
    select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 as pos
    from documents
),
own as (
    select doc_id, pos, {_bigrams_sql('w')} as g
    from (select doc_id, pos, regexp_extract_all(lower(line), '[a-z0-9]+') as w from lines)
),
templates as (
    select name, {_bigrams_sql('w')} as g
    from (select name, string_split(t, ' ') as w from (values {_templates_sql()}) as v(name, t))
),
scored as (
    select doc_id, pos, name, len(t.g) as n, len(list_intersect(o.g, t.g)) as shared, len(o.g) + len(t.g) as bigrams
    from own o join templates t on len(o.g) between len(t.g) / 1.6 and len(t.g) * 1.6
),
best as (
    select *, 2 * shared / bigrams as dice from scored where shared > 0 and 2 * shared / bigrams >= 0.8
    qualify row_number() over (partition by doc_id, pos order by dice desc, n, name) = 1
),
top as (select * from best qualify row_number() over (partition by doc_id order by dice desc, pos) = 1)
select d.doc_id, count(l.pos) as n_units,
    (select count(*) from best b where b.doc_id = d.doc_id) as n_matches,
    any_value(t.name) as licence, any_value(t.pos)::int as line, any_value(t.shared)::int as shared,
    any_value(t.bigrams)::int as bigrams, any_value(t.dice) as dice
from documents d join lines l using (doc_id) left join top t using (doc_id) group by d.doc_id
"""


@query("op9_licence_scan", LICENCE_SQL)
def op9_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units are single lines; op9_licence_texts looks over line ends and for whole licence texts."""
    return licences.scan_licences(table(spark, sf_dir, "documents"))


@query("op9_licence_texts")
def op9_licence_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licence_texts(table(spark, sf_dir, "documents"))


COSINE_SQL = """
with recursive good as (
    select vec_id, label, [x::double for x in embedding] as v from embeddings
    where vec_id is not null and label is not null and embedding is not null
      and len([x for x in embedding if x is null or not isfinite(x)]) = 0 and len([x for x in embedding if x <> 0]) > 0
),
link as (
    select a.vec_id as a, b.vec_id as b from good a join good b on a.label = b.label and a.vec_id <> b.vec_id
    where list_cosine_similarity(a.v, b.v) >= 0.98
),
reach as (select a, b from link union select r.a, l.b from reach r join link l on r.b = l.a)
select e.vec_id, (select count(*) from link l where l.a = e.vec_id) as n_links,
    coalesce(least(e.vec_id, (select min(b) from reach r where r.a = e.vec_id)), e.vec_id) as component_id,
    e.vec_id <= coalesce((select min(b) from reach r where r.a = e.vec_id), e.vec_id) as kept
from embeddings e
"""


@query("op10_collision_dedup", COSINE_SQL)
def op10_collision_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projections.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op6_bpe_round_trip")
def op6_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    return bpe.encode_report(table(spark, sf_dir, "documents"), path, pattern)


@query("op8_best_fit_packing")
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_packing(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op3_toxicity_cnn")
def op3_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_minhash_dedup")
def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, per_cent=85)


@query("op1_run_index_dedup")
def op1_run_index_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeats_report(table(spark, sf_dir, "documents"))


#: The rules of op12 as rows of (host, path, verdict).
URL_RULES = """
values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
       ('net', '/es/', 'block'), ('net', '/fr/', 'block')
"""

URL_SQL = f"""
with rules as (select * from ({URL_RULES}) as r(rule_host, rule_path, verdict)),
rest as (
    select page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest from pages
),
parsed as (
    select page_id,
        translate(regexp_extract(rest, '^([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        regexp_extract(rest, '^([^/?#]*)([^?#]*)', 2) as path
    from rest
)
select page_id, host, path,
    (select arg_max(rule_host || rule_path, length(rule_host || rule_path)) from rules
     where (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)) as rule,
    coalesce((select arg_max(verdict, length(rule_host || rule_path)) from rules
     where (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)), 'allow') as verdict
from parsed
"""


@query("op12_url_filter", URL_SQL)
def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql(f"select * from ({URL_RULES}) as r(host, path, verdict)")
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), rules)


@query("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.runs_report(runs.periodic_runs(runs.with_planted_runs(table(spark, sf_dir, "documents"))))


#: The unsigned CRC-32 of a text of ASCII characters.
CRC32_SQL = """xor(4294967295::bigint, list_reduce(
    list_prepend(4294967295::bigint, [ascii(x)::bigint for x in string_split({text}, '')]),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0]::bigint[], lambda p, q: xor(p >> 1, 3988292384 * (p & 1)))))"""

TRIE_SQL = f"""
with own as (
    select conv_id, row_number() over (partition by conv_id order by turn nulls first, role, text) as place,
        coalesce(role, '') as role, coalesce(text, '') as text
    from conversations where conv_id is not null
),
convs as (
    select conv_id, conv_id - conv_id % 20 as base, {CRC32_SQL.format(text="conv_id::varchar")} % 4 as h from own group by conv_id
),
rebuilt as (
    select c.conv_id, o.place, role, text from convs c join own o on o.conv_id = c.base and o.place <= c.h
    union all
    select c.conv_id, o.place, role, text from convs c join own o on o.conv_id = c.conv_id and o.place > c.h
),
turns as (
    select conv_id, row_number() over (partition by conv_id order by place) as depth, sha256(role) || sha256(text) as turn,
        len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as words
    from rebuilt
),
steps as (
    select conv_id, depth, words, sha256(string_agg(turn, '') over (partition by conv_id order by depth)) as node from turns
    union all
    select conv_id, 0, 0, '' from convs
),
chained as (
    select s.*, lag(node) over (partition by conv_id order by depth) as parent,
        depth = max(depth) over (partition by conv_id) as ends
    from steps s
),
nodes as (
    select node, any_value(depth) as depth, any_value(parent) as parent, min(conv_id) as conv_id, count(*) as n_convs,
        any_value(words) as words, sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ends), '')) as ends_sha256
    from chained group by node
),
children as (select parent as node, count(*) as n_children from nodes where parent is not null group by parent),
inside as (
    select s.node as top, sum((c.node is null)::int) as n_leaves, sum((n.n_convs - 1) * n.words) as saved_tokens
    from nodes n join chained s on s.conv_id = n.conv_id and s.depth <= n.depth left join children c on c.node = n.node
    group by s.node
)
select n.conv_id, n.depth::bigint as depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(n_children, 0)::bigint as n_children,
    n_leaves::bigint as n_leaves, saved_tokens::bigint as saved_tokens, n.ends_sha256
from nodes n left join nodes p on p.node = n.parent left join children c on c.node = n.node join inside i on i.top = n.node
"""


@query("op11_conversation_trie", TRIE_SQL)
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.rebuilt_trie(table(spark, sf_dir, "conversations")).drop("enter_at", "leave_at")
