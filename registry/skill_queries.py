"""Sections, skills, titles."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanery import fixed_values as fv
from gleanery.functions import skills as s
from gleanery.functions.arrays import counted
from gleanery.session import materialize

from .base import (
    JOB_DOCS_SQL,
    SECTIONS_SQL,
    UNIX_DESCR,
    alternatives,
    ascii_words_sql,
    candidates_sql,
    fits_sql,
    job_docs,
    joined,
    normalized_skills_sql,
    query,
    shorten_sql,
    strip_sql,
    table,
    with_job_text,
)


@query(
    "x2_description_sections",
    f"with {JOB_DOCS_SQL}, {SECTIONS_SQL} select doc_id, responsibilities, skills, requirements from sections",
)
def x2_description_sections(spark, sf_dir):
    found = job_docs(spark, sf_dir).select("doc_id", s.description_sections("descr").alias("s"))
    return found.select(
        "doc_id",
        joined("s.responsibilities").alias("responsibilities"),
        joined("s.skills").alias("skills"),
        joined("s.requirements").alias("requirements"),
    )


@query(
    "l7_section_state",
    f"""with {JOB_DOCS_SQL}, {SECTIONS_SQL} select doc_id, line, coalesce(code, '-') as code, count(*)::bigint as n
    from routed group by all""",
)
def l7_section_state(spark, sf_dir):
    # Lines are counted in their row; only rows that share their doc_id with others meet in an aggregation, whose
    # memory would else grow with the lines of a whole split. Shared ids are stored: with their size known, a few
    # or none of them (the usual case) don't make the texts move.
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    rows_of_id = docs.groupBy(F.col("doc_id").alias("id")).agg(F.count(F.lit(1)).alias("n_rows"))
    shared = materialize(rows_of_id.where("n_rows > 1").select("id"))
    same = F.col("doc_id").eqNullSafe(F.col("id"))

    def line_counts(rows):
        counts = with_job_text(rows).select("doc_id", F.explode(counted(s.tagged_lines("descr"))).alias("c"))
        return counts.select(
            "doc_id", F.col("c.item.line").alias("line"), F.coalesce("c.item.code", F.lit("-")).alias("code"), "c.n"
        )

    alone = line_counts(docs.join(shared, same, "left_anti"))
    together = line_counts(docs.join(shared, same, "left_semi"))
    return alone.union(together.groupBy("doc_id", "line", "code").agg(F.sum("n").alias("n")))


@query(
    "x3_clean_skill_phrase",
    f"""with p as (
        select doc_id, 'Experience with ' || unnest(string_split(text, ', ')) || ' skill' as raw,
               generate_subscripts(string_split(text, ', '), 1) - 1 as pos from documents),
    c as (select doc_id, pos, {shorten_sql('raw')} as phrase from p)
    select doc_id, pos::bigint as pos, phrase from c where {fits_sql('phrase')}""",
)
def x3_clean_skill_phrase(spark, sf_dir):
    parts = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", ", ", -1)))
    phrase = F.concat(F.lit("Experience with "), F.col("col"), F.lit(" skill"))
    return parts.select(
        "doc_id", F.col("pos").cast("bigint").alias("pos"), s.clean_skill_phrase(phrase).alias("phrase")
    ).where(F.col("phrase").isNotNull())


@query(
    "x4_normalize_skills",
    f"""with src as (
        select doc_id, unnest(string_split(text, chr(10))) as raw,
               generate_subscripts(string_split(text, chr(10)), 1) as place from documents),
    {normalized_skills_sql('src')}
    select d.doc_id, coalesce(string_agg(skill, ' | ' order by place, seg_no), '') as skills
    from documents d left join skill_rows s on d.doc_id = s.doc_id group by d.doc_id""",
)
def x4_normalize_skills(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", joined(s.normalize_skills(F.split("text", "\n", -1))).alias("skills"))


def _local_skills_sql(hashtags: bool) -> str:
    return f"""with {JOB_DOCS_SQL}, {SECTIONS_SQL}, {candidates_sql(hashtags)},
    {normalized_skills_sql('candidates')}
    select d.doc_id, coalesce(string_agg(skill, ' | ' order by place, seg_no), '') as skills
    from docs d left join skill_rows s on d.doc_id = s.doc_id group by d.doc_id"""


def _local_skills(spark, sf_dir, hashtags):
    found = job_docs(spark, sf_dir).select("doc_id", "descr", s.description_sections("descr").alias("s"))
    return found.select("doc_id", joined(s.local_skills("descr", "s.skills", hashtags)).alias("skills"))


@query("x5_local_skills", _local_skills_sql(True))
def x5_local_skills(spark, sf_dir):
    return _local_skills(spark, sf_dir, True)


@query("x5_local_skills_no_hashtags", _local_skills_sql(False))
def x5_local_skills_no_hashtags(spark, sf_dir):
    return _local_skills(spark, sf_dir, False)


_ROLE_WORD = fv.TITLE_WORD
TITLES_SQL = f"""
    title_lines as (
        select doc_id, {strip_sql('line0')} as line, pos from (
            select doc_id, unnest(string_split({UNIX_DESCR}, chr(10))) as line0,
                   generate_subscripts(string_split({UNIX_DESCR}, chr(10)), 1) as pos from docs)
    ),
    titled as (
        select doc_id, pos, case
            when regexp_matches(lower(line), '{alternatives(fv.TITLE_HINTS)}') then trim(line, ':- ')
            else nullif(regexp_extract({ascii_words_sql('line')},
                '\\b({_ROLE_WORD}(?:\\s+{_ROLE_WORD}){{0,5}}({'|'.join(fv.TITLE_ROLES)}))\\b', 1), '') end as title
        from title_lines where line <> '' and length(line) <= {fv.MAX_TITLE_LINE_CHARS}
    ),
    title_rows as (
        select * from titled where title is not null
        qualify row_number() over (partition by doc_id, lower(title) order by pos) = 1
    ),
    titles as (
        select d.doc_id, coalesce(string_agg(title, ' | ' order by pos), '') as job_titles
        from docs d left join title_rows t on d.doc_id = t.doc_id group by d.doc_id
    )"""


@query("x6_guess_titles", f"with {JOB_DOCS_SQL}, {TITLES_SQL} select doc_id, job_titles from titles")
def x6_guess_titles(spark, sf_dir):
    return job_docs(spark, sf_dir).select("doc_id", joined(s.guess_titles("descr")).alias("job_titles"))


@query(
    "x7_local_insight",
    f"""with {JOB_DOCS_SQL}, {SECTIONS_SQL}, {candidates_sql(True)}, {normalized_skills_sql('candidates')},
    {TITLES_SQL},
    found as (select doc_id, string_agg(skill, ' | ' order by place, seg_no) as skills
              from skill_rows group by doc_id)
    select doc_id, job_titles, responsibilities, coalesce(f.skills, '') as skills, requirements
    from sections s join titles using (doc_id) left join found f using (doc_id)""",
)
def x7_local_insight(spark, sf_dir):
    rows = job_docs(spark, sf_dir).select("doc_id", s.local_insight("descr").alias("i"))
    return rows.select("doc_id", *[joined(f"i.{n}").alias(n) for n in s.INSIGHT_FIELDS])


@query(
    "j8_canonical_skills",
    """with toks as (
        select doc_id, unnest(regexp_extract_all(descr, '[A-Za-z]+')) as tok from docs)
    select canon as name, count(*)::bigint as n, count(distinct doc_id)::bigint as docs
    from (select doc_id, m[lower(tok)] as canon from toks, known) where canon is not null group by canon""".replace(
        "with toks", f"with {JOB_DOCS_SQL}, known as (select map_from_entries([" + ", ".join(
            f"('{k}', '{v}')" for k, v in fv.SKILL_WORDS.items()) + "]) as m), toks"
    ),
)
def j8_canonical_skills(spark, sf_dir):
    from gleanery.operators.joins import canonical_by_dimension

    tokens = job_docs(spark, sf_dir).select(
        "doc_id", F.explode(F.regexp_extract_all("descr", F.lit("[A-Za-z]+"), F.lit(0))).alias("token")
    )
    dictionary = spark.createDataFrame(list(fv.SKILL_WORDS.items()), "word string, name string")
    return (
        canonical_by_dimension(tokens, dictionary)
        .groupBy("name")
        .agg(
            F.count(F.lit(1)).cast("bigint").alias("n"),
            F.count_distinct("doc_id").cast("bigint").alias("docs"),
        )
    )
