"""Registration of checked queries, and SQL fragments their DuckDB twins share."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from gleanery import fixed_values as fv
from gleanery.functions.text import WHITE_SPACE
from gleanery.session import scratch_dir, small_batches

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; without SQL only its rows are checked."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return small_batches(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def work_folder(spark: SparkSession) -> str:
    """A new folder for tables a query maintains."""
    return f"{scratch_dir(spark).rstrip('/')}/work-{uuid.uuid4().hex}"


def joined(column, sep: str = " | "):
    """Array to text, so that both engines compare the same thing."""
    return F.coalesce(F.array_join(column, sep), F.lit(""))


def big(column):
    return F.col(column).cast("bigint") if isinstance(column, str) else column.cast("bigint")


# ---- SQL fragments ----


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


WS = quote(WHITE_SPACE)
WS_CLASS = (
    r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
NL = "chr(10)"


def strip_sql(x: str) -> str:
    return f"trim({x}, {WS})"


def collapse_sql(x: str) -> str:
    return f"trim(regexp_replace({x}, '[{WS_CLASS}]+', ' ', 'g'))"


def alternatives(words) -> str:
    """Words as regex alternatives, quoted for RE2 and SQL."""
    specials = set(".+*?()[]{}|\\^$-&")
    return "|".join("".join("\\" + c if c in specials else c for c in w) for w in words).replace("'", "''")


def distinct_lines_sql(source: str, keys: str, value: str, order: str) -> str:
    """First row of each lower-case value per key."""
    return (
        f"select * from {source} qualify row_number() over "
        f"(partition by {keys}, lower({value}) order by {order}) = 1"
    )


# ---- derived inputs, written once for each engine ----


def job_text():
    """A job description built from a whole document: title line, headings, bullets, lists,
    hint words, hashtags and technology names around the text."""
    return F.expr(
        """concat(
            'Job title: ', source, ' \\r\\n', 'Key Responsibilities:\\n- ', replace(text, '. ', '\\n* '),
            '\\n\\nRequired skills\\nKnowledge of ', text,
            '\\n\\nYou will require ', lang, ' experience with Python, sql, CI/CD, THE ', upper(lang),
            ' #Data-Science_', source, ' machine learning\\r\\nSoftwareEngineer wanted\\n',
            'Qualifications\\n', replace(text, ', ', '\\n')
        )"""
    )


JOB_TEXT_SQL = (
    "('Job title: ' || source || ' ' || chr(13) || chr(10) || 'Key Responsibilities:' || chr(10) || '- ' || "
    "replace(text, '. ', chr(10) || '* ') || chr(10) || chr(10) || 'Required skills' || chr(10) || "
    "'Knowledge of ' || text || chr(10) || chr(10) || 'You will require ' || lang || "
    "' experience with Python, sql, CI/CD, THE ' || upper(lang) || ' #Data-Science_' || source || "
    "' machine learning' || chr(13) || chr(10) || 'SoftwareEngineer wanted' || chr(10) || "
    "'Qualifications' || chr(10) || replace(text, ', ', chr(10)))"
)


def with_job_text(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", "lang", "text", job_text().alias("descr"))


def job_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_job_text(table(spark, sf_dir, "documents"))


JOB_DOCS_SQL = f"docs as (select doc_id, source, lang, text, {JOB_TEXT_SQL} as descr from documents)"

UNIX_DESCR = "replace(replace(descr, chr(13) || chr(10), chr(10)), chr(13), chr(10))"

# Sections of docs.descr as rows (doc_id, pos, code, line).
SECTIONS_SQL = f"""
    raw_lines as (
        select doc_id, unnest(string_split({UNIX_DESCR}, chr(10))) as line0,
               generate_subscripts(string_split({UNIX_DESCR}, chr(10)), 1) as pos
        from docs
    ),
    lines as (
        select doc_id, pos, trim({strip_sql('line0')}, ' -*•' || chr(9)) as line from raw_lines
    ),
    keyed as (
        select *, lower(trim(regexp_replace(line, '[^a-zA-Z0-9\\x{{4e00}}-\\x{{9fff}}]+', ' ', 'g'))) as k
        from lines
    ),
    events as (
        select *, case
            when line = '' then 'B'
            when regexp_matches(k, '^({alternatives(fv.RESPONSIBILITY_HEADINGS)})') then 'R'
            when regexp_matches(k, '^({alternatives(fv.SKILL_HEADINGS)})') then 'S'
            when regexp_matches(k, '^({alternatives(fv.REQUIREMENT_HEADINGS)})') then 'Q' end as ev
        from keyed
    ),
    carried as (
        select *, coalesce(last_value(ev ignore nulls) over (
            partition by doc_id order by pos rows between unbounded preceding and current row), 'B') as state
        from events
    ),
    routed as (
        select doc_id, pos, line, case when state <> 'B' then state
            when regexp_matches(k, '{alternatives(fv.RESPONSIBILITY_HINTS)}') then 'R'
            when regexp_matches(k, '{alternatives(fv.SKILL_HINTS)}') then 'S'
            when regexp_matches(k, '{alternatives(fv.REQUIREMENT_HINTS)}') then 'Q' end as code
        from carried where ev is null
    ),
    section_rows as (
        select doc_id, pos, line, code from routed where code is not null
        qualify row_number() over (partition by doc_id, code, lower(line) order by pos) = 1
    ),
    sections as (
        select d.doc_id,
            coalesce(string_agg(line, ' | ' order by pos) filter (code = 'R'), '') as responsibilities,
            coalesce(string_agg(line, ' | ' order by pos) filter (code = 'S'), '') as skills,
            coalesce(string_agg(line, ' | ' order by pos) filter (code = 'Q'), '') as requirements
        from docs d left join section_rows s on d.doc_id = s.doc_id group by d.doc_id
    )"""

_PHRASE_CHARS = "' -•' || chr(9) || chr(13) || chr(10) || '.:;'"


def shorten_sql(x: str) -> str:
    """Skill phrase cleaning, without the length limits."""
    out = f"trim({x}, {_PHRASE_CHARS})"
    out = f"trim(regexp_replace({out}, '^(?i)({alternatives(fv.SKILL_PREFIXES)})', ''), {_PHRASE_CHARS})"
    for suffix in fv.SKILL_SUFFIXES:
        out = f"trim(regexp_replace({out}, '(?i){suffix}$', ''), {_PHRASE_CHARS})"
    return out


def fits_sql(x: str) -> str:
    return (
        f"({x} <> '' and length({x}) <= {fv.MAX_SKILL_CHARS} and "
        f"len(regexp_extract_all({x}, '[^{WS_CLASS}]+')) <= {fv.MAX_SKILL_WORDS})"
    )


def normalized_skills_sql(source: str, keys: str = "doc_id") -> str:
    """CTEs ``pieces`` and ``skill_rows`` from rows (keys, place, raw)."""
    return f"""
    split_rows as (
        select {keys}, place, unnest(regexp_split_to_array(raw, '[,/;•\\r\\n]+')) as seg,
               generate_subscripts(regexp_split_to_array(raw, '[,/;•\\r\\n]+'), 1) as seg_no
        from {source}
    ),
    pieces as (select {keys}, place, seg_no, {shorten_sql('seg')} as skill from split_rows),
    skill_rows as (
        select * from pieces where {fits_sql('skill')}
        qualify row_number() over (partition by {keys}, lower(skill) order by place, seg_no) = 1
    )"""


# Letters outside ASCII become '_', so that RE2's ASCII word boundary acts as a Unicode one.
def ascii_words_sql(x: str) -> str:
    return f"regexp_replace({x}, '[À-ÖØ-öø-ÿĀ-ɏ]', '_', 'g')"


def candidates_sql(hashtags: bool) -> str:
    """CTE ``candidates``: (doc_id, place, raw) in candidate order, from docs and
    section_rows."""
    phrases = ", ".join(quote(p) for p in fv.SKILL_PHRASES)
    words = ", ".join(f"{quote(k)}: {quote(v)}" for k, v in fv.SKILL_WORDS.items())
    tags = (
        "union all select doc_id, 2e9::bigint + i, replace(replace(tag, '_', ' '), '-', ' ') from "
        "(select doc_id, unnest(tags) as tag, generate_subscripts(tags, 1) as i from "
        "(select doc_id, regexp_extract_all(descr, '#([A-Za-z0-9][A-Za-z0-9_\\-]+)', 1) as tags from docs))"
        if hashtags
        else ""
    )
    return f"""
    token_rows as (
        select doc_id, i, trim(tok, '-./') as tok from (
            select doc_id, unnest(toks) as tok, generate_subscripts(toks, 1) as i from (
                select doc_id, regexp_extract_all({ascii_words_sql('descr')},
                    '\\b[A-Za-z][A-Za-z0-9\\+#\\.\\-/]{{1,}}\\b') as toks from docs))
    ),
    known as (select map_from_entries([{', '.join(f"({quote(k)}, {quote(v)})" for k, v in fv.SKILL_WORDS.items())}]) as m),
    candidates as (
        select doc_id, pos::bigint as place, line as raw from section_rows where code = 'S'
        union all
        select doc_id, 1e9::bigint + i, p from (
            select doc_id, descr, unnest([{phrases}]) as p, unnest(range({len(fv.SKILL_PHRASES)})) as i from docs)
        where contains(lower(descr), p)
        {tags}
        union all
        select doc_id, 3e9::bigint + i, coalesce(m[lower(tok)], tok) from token_rows, known
        where m[lower(tok)] is not null or regexp_full_match(tok, '[A-Z0-9]{{2,5}}')
    )"""
