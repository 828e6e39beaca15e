"""Batched enrichment: requests, answers, fallback."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanery import fixed_values as fv
from gleanery.functions import skills
from gleanery.operators import enrich
from gleanery.operators.dedupe import first_wins

from .base import (
    JOB_DOCS_SQL,
    SECTIONS_SQL,
    candidates_sql,
    joined,
    normalized_skills_sql,
    query,
    quote,
    strip_sql,
    table,
)
from .skill_queries import TITLES_SQL


def texts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        F.col("doc_id").alias("ord"),
        "lang",
        "source",
        F.when(F.col("lang") == "es", F.lit(" ")).otherwise(F.col("text")).alias("text"),
    )


_NUMBERED = f"""n as (select doc_id, lang, source, {strip_sql("case when lang = 'es' then ' ' else text end")} as body,
    row_number() over (order by doc_id) - 1 as i, count(*) over () as total from documents)"""


def _sql_text(text: str) -> str:
    return "(" + " || chr(10) || ".join(quote(part) for part in text.split("\n")) + ")"


@query(
    "n1_skill_requests",
    f"""with {_NUMBERED}, p as (select *, case when body = '' then '{fv.NO_DESCRIPTION}'
        else body end as shown from n)
    select i // 5 as batch_id, string_agg(doc_id::varchar, ',' order by i) as members,
        {_sql_text(fv.SKILL_REQUEST_TEXT)} || chr(10) || chr(10) ||
        string_agg((i % 5 + 1) || '. ' || shown, chr(10) || chr(10) order by i) as prompt from p group by 1""",
)
def n1_skill_requests(spark, sf_dir):
    found = enrich.build_requests(texts(spark, sf_dir), kind="skills")
    members = joined(F.transform("member_ids", lambda x: x.cast("string")), ",")
    return found.select("batch_id", members.alias("members"), "prompt")


@query(
    "n1_cut_skill_requests",
    f"""with {_NUMBERED}, p as (select *, case when body = '' then '{fv.NO_DESCRIPTION}'
        when length(body) > 4000 then substr(body, 1, 4000) || '...' else body end as shown from n)
    select i // 5 as batch_id,
        {_sql_text(fv.SKILL_REQUEST_TEXT)} || chr(10) || chr(10) ||
        string_agg((i % 5 + 1) || '. ' || shown, chr(10) || chr(10) order by i) as prompt from p group by 1""",
)
def n1_cut_skill_requests(spark, sf_dir):
    found = enrich.build_requests(texts(spark, sf_dir), kind="skills", max_chars=fv.MAX_REQUEST_CHARS)
    return found.select("batch_id", "prompt")


@query(
    "n1_insight_requests",
    f"""with {_NUMBERED.replace('over (order by doc_id) - 1', 'over (partition by lang order by doc_id) - 1')}
    select lang, i // 5 as batch_id, string_agg(doc_id::varchar, ',' order by i) as members,
        {_sql_text(chr(10).join(fv.INSIGHT_REQUEST_LINES))} || chr(10) || chr(10) ||
        string_agg('CONTENT ' || (i % 5 + 1) || ':' || chr(10) || body, chr(10) order by i) as prompt
    from n group by all""",
)
def n1_insight_requests(spark, sf_dir):
    found = enrich.build_requests(texts(spark, sf_dir), kind="insights", partition_by=["lang"])
    members = joined(F.transform("member_ids", lambda x: x.cast("string")), ",")
    return found.select("lang", "batch_id", members.alias("members"), "prompt")


def skill_answers(requests):
    """Answers to requests: clean, inside prose, too short, broken, or none, by batch."""
    key = F.col("batch_id") % 7
    lists = F.transform(
        "member_ids",
        lambda m: F.array(F.concat(F.lit(" Skill "), m.cast("string")), F.lit("Python, sql skills"), F.lit("")),
    )
    clean = F.to_json(lists)
    raw = (
        F.when(key == 1, F.concat(F.lit("Sure: "), clean, F.lit(" done")))
        .when(key == 2, F.to_json(F.concat(lists, lists)))
        .when(key == 3, F.lit("no [idea"))
        .when(key == 5, F.concat(F.lit("["), F.array_join(F.transform("member_ids", lambda m: F.lit('" one "')), ","), F.lit("]")))
        .otherwise(clean)
    )
    return requests.where(key != 6).select("batch_id", raw.alias("raw"))


_ANSWERED = f"""{_NUMBERED}, a as (select doc_id, source, i // 5 as batch_id, case (i // 5) % 7
    when 2 then null when 3 then null when 6 then null when 5 then ['one']
    else ['Skill ' || doc_id, 'Python, sql skills'] end as found from n)"""


@query(
    "n2_skill_answers",
    f"with {_ANSWERED} select doc_id as member_id, batch_id, array_to_string(found, ' | ') as found from a",
)
def n2_skill_answers(spark, sf_dir):
    requests = enrich.build_requests(texts(spark, sf_dir), kind="skills")
    parsed = enrich.skill_answer("raw", "expected")
    found = enrich.member_rows(requests, skill_answers(requests), parsed, "found")
    return found.select("member_id", "batch_id", F.array_join("found", " | ").alias("found"))


@query(
    "n4_skills_with_fallback",
    f"""with {_ANSWERED} select doc_id as member_id, case when found is null then source
        when len(found) = 1 then 'one' else 'Skill ' || doc_id || ' | Python | sql' end as skills from a""",
)
def n4_skills_with_fallback(spark, sf_dir):
    source = texts(spark, sf_dir)
    requests = enrich.build_requests(source, kind="skills")
    found = enrich.member_rows(requests, skill_answers(requests), enrich.skill_answer("raw", "expected"), "found")
    rows = found.join(source.withColumnRenamed("id", "member_id"), "member_id")
    chosen = enrich.skills_or_fallback("found", F.array("source"))
    return rows.select("member_id", joined(chosen).alias("skills"))


def insight_answers(requests):
    """Answers: one object per text, a single object, an array in prose, a scalar among objects,
    broken, or none, by batch."""
    key = F.col("batch_id") % 7

    def item(m):
        return F.struct(
            F.concat(F.lit(" Title "), m.cast("string")).alias("job_titles"),
            F.array(F.lit("a"), F.lit(" "), F.lit(" b ")).alias("skills"),
            F.when(m % 2 == 0, F.array(F.lit("r"))).alias("requirements"),
        )

    items = F.to_json(F.transform("member_ids", item))
    raw = (
        F.when(key == 1, F.to_json(item(F.element_at("member_ids", 1))))
        .when(key == 2, F.concat(F.lit("Here: "), items))
        .when(key == 3, F.concat(F.lit("[1, "), F.array_join(F.transform("member_ids", lambda m: F.lit("{}")), ","), F.lit("]")))
        .when(key == 4, F.concat(F.lit("["), F.array_join(F.transform("member_ids", lambda m: F.lit("{}")), ","), F.lit("]")))
        .when(key == 5, F.lit("oops"))
        .otherwise(items)
    )
    return requests.where(key != 6).select("batch_id", raw.alias("raw"))


# State of a text's answer: 'full', 'empty' (present but says nothing) or 'none'.
_INSIGHT_STATE = """case when (i // 5) % 7 in (3, 5, 6) then 'none' when (i // 5) % 7 = 4 then 'empty'
    when (i // 5) % 7 = 1 and i % 5 > 0 then 'empty' else 'full' end"""


@query(
    "n3_insight_answers",
    f"""with {_NUMBERED}, s as (select *, {_INSIGHT_STATE} as state from n)
    select doc_id as member_id, state,
        case state when 'full' then 'Title ' || doc_id || '//a | b/' || (case when doc_id % 2 = 0 then 'r' else '' end)
             when 'empty' then '///' else '-' end as insight from s""",
)
def n3_insight_answers(spark, sf_dir):
    requests = enrich.build_requests(texts(spark, sf_dir), kind="insights")
    parsed = enrich.insight_answer("raw", "expected")
    found = enrich.member_rows(requests, insight_answers(requests), parsed, "insight")
    i = F.col("insight")
    shown = F.concat_ws("/", *[joined(i[n]) for n in skills.INSIGHT_FIELDS])
    return found.select(
        "member_id",
        F.when(i.isNull(), F.lit("none")).when(shown == "///", F.lit("empty")).otherwise(F.lit("full")).alias("state"),
        F.when(i.isNull(), F.lit("-")).otherwise(shown).alias("insight"),
    )


@query(
    "n4_insights_with_fallback",
    f"""with {_NUMBERED}, st as (select doc_id, {_INSIGHT_STATE} as state from n),
    {JOB_DOCS_SQL}, {SECTIONS_SQL}, {candidates_sql(True)}, {normalized_skills_sql('candidates')}, {TITLES_SQL},
    f as (select doc_id, string_agg(skill, ' | ' order by place, seg_no) as skills from skill_rows group by doc_id)
    select doc_id as member_id,
        case when state = 'full' then 'Title ' || doc_id else job_titles end as job_titles,
        case when state = 'full' then 'a | b' else coalesce(f.skills, '') end as skills
    from st join sections s using (doc_id) join titles using (doc_id) left join f using (doc_id)""",
)
def n4_insights_with_fallback(spark, sf_dir):
    from .base import job_docs

    requests = enrich.build_requests(texts(spark, sf_dir), kind="insights")
    found = enrich.member_rows(
        requests, insight_answers(requests), enrich.insight_answer("raw", "expected"), "answered"
    )
    rows = job_docs(spark, sf_dir).withColumnRenamed("doc_id", "member_id").join(found, "member_id")
    final = rows.select("member_id", enrich.insight_or_fallback("answered", "descr").alias("i"))
    return final.select("member_id", joined("i.job_titles").alias("job_titles"), joined("i.skills").alias("skills"))


@query(
    "n5_answer_function",
    f"""with {_NUMBERED} select i // 5 as batch_id, count(*)::bigint as n,
        case when (i // 5) % 3 = 0 then null else 'words: ' || max(total) end as raw
    from n group by 1, 3, total""".replace("'words: ' || max(total)", "'ok'").replace("group by 1, 3, total", "group by 1, 3"),
)
def n5_answer_function(spark, sf_dir):
    requests = enrich.build_requests(texts(spark, sf_dir), kind="insights")

    def answer(prompt: str) -> str:
        number, rest = prompt.split("#", 1)
        if int(number) % 3 == 0:
            raise ValueError("no answer")
        return "ok" if rest.startswith("Extract") else "?"

    numbered = requests.withColumn("prompt", F.concat(F.col("batch_id").cast("string"), F.lit("#"), "prompt"))
    answered = enrich.answer_requests(numbered, answer)
    return answered.join(requests, "batch_id").select(
        "batch_id", F.size("member_ids").cast("bigint").alias("n"), "raw"
    )


@query(
    "n6_lenient_skill_list",
    r"""with w as (select doc_id, lang, unnest(regexp_split_to_array(text, '[\n,;•\-]+')) as w,
        generate_subscripts(regexp_split_to_array(text, '[\n,;•\-]+'), 1) as i from documents),
    t as (select doc_id, i, trim(w, ' -*•' || chr(9) || chr(13) || chr(10)) as w from w where lang in ('en', 'fr')),
    u as (select * from t where w <> '' qualify row_number() over (partition by doc_id, lower(w) order by i) = 1),
    g as (select doc_id, string_agg(w, ' | ' order by i) as skills from u group by doc_id)
    select d.doc_id, case when lang in ('de', 'es') then source || ' | x' else coalesce(skills, '') end as skills
    from documents d left join g on g.doc_id = d.doc_id""",
)
def n6_lenient_skill_list(spark, sf_dir):
    lang = F.col("lang")
    listed = F.array(F.concat(F.lit("- "), "source"), F.lit("x"), F.upper("source"), F.lit(" "))
    raw = (
        F.when(lang == "de", F.concat(F.lit("here: "), F.to_json(listed)))
        .when(lang == "es", F.to_json(F.struct(listed.alias("skill_list"))))
        .otherwise(F.col("text"))
    )
    return table(spark, sf_dir, "documents").select("doc_id", joined(enrich.parse_skill_list(raw)).alias("skills"))


@query(
    "x7_insight_modes",
    f"""with {JOB_DOCS_SQL}, {TITLES_SQL} select doc_id, job_titles, '' as none_titles from titles""",
)
def x7_insight_modes(spark, sf_dir):
    from .base import job_docs

    rows = enrich.insights_for_mode(job_docs(spark, sf_dir), "descr", "local", "local")
    both = enrich.insights_for_mode(rows, "descr", "none", "none")
    return both.select(
        "doc_id", joined("local.job_titles").alias("job_titles"), joined("none.job_titles").alias("none_titles")
    )


@query(
    "u2_union_of_batches",
    "select doc_id, lower(text) as k from documents qualify row_number() over (partition by lower(text) order by doc_id) = 1",
)
def u2_union_of_batches(spark, sf_dir):
    from gleanery.operators.rows import union_all

    source = table(spark, sf_dir, "documents").select("doc_id", "lang", F.lower("text").alias("k"))
    batches = union_all(*[source.where(F.col("lang") == code) for code in ("en", "fr", "de", "es")])
    return first_wins(batches, "k", "doc_id").select("doc_id", "k")
