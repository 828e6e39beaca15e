"""Keyword and field predicates."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fv
from ..functions.boolean import matches_expression
from ..functions.text import as_col, let, or_empty
from .dedupe import dedupe_text
from .limits import first_rows
from .rows import keep_computed


def normalize_keywords(keywords: Sequence[str]) -> list[str]:
    """Lower-case trimmed keywords, blank ones dropped; the default list when none is left."""
    kept = [k.lower().strip() for k in keywords if k.strip()]
    return kept or list(fv.DEFAULT_KEYWORDS)


def _has(lowered: Column, keyword: str, whole_word: bool) -> Column:
    if whole_word:
        return lowered.rlike(rf"(?U)(?<!\w){re.escape(keyword)}(?!\w)")
    return F.contains(lowered, F.lit(keyword))


def has_keyword(text: Column | str, keywords: Sequence[str], whole_word: bool = False) -> Column:
    """Whether the lower-case text contains any keyword."""
    lowered = F.lower(as_col(text))
    return reduce(or_, [_has(lowered, k, whole_word) for k in normalize_keywords(keywords)])


def keyword_hits(text: Column | str, keywords: Sequence[str], whole_word: bool = False) -> Column:
    """Keywords contained in the text, in keyword order; the text is lower-cased once."""
    wanted = normalize_keywords(keywords)

    def hits(lowered: Column) -> Column:
        found = [F.when(_has(lowered, k, whole_word), F.lit(k)) for k in wanted]
        return F.array_compact(F.array(*found))

    return let(F.lower(as_col(text)), hits)


def match_keywords(
    df: DataFrame, text: str, keywords: Sequence[str] = tuple(fv.DEFAULT_KEYWORDS), whole_word: bool = False
) -> DataFrame:
    """Rows with text that contain a keyword, with the hits upper-cased in
    ``matched_keywords``. The text, often computed itself, is evaluated once."""

    def match(value: Column) -> Column:
        hits = F.transform(keyword_hits(value, keywords, whole_word), F.upper)
        return F.struct(value.alias("text"), hits.alias("hits"))

    found = keep_computed(
        df,
        {"_match": let(F.col(text), match)},
        lambda row: (row["_match"]["text"] != "") & (F.size(row["_match"]["hits"]) > 0),
    )
    columns = [F.col("_match.text").alias(c) if c == text else F.col(c) for c in df.columns]
    return found.select(*columns, F.col("_match.hits").alias("matched_keywords"))


def _one_of(value: str | None, allowed: Sequence[str], name: str) -> str | None:
    if value is not None and value not in allowed:
        raise ValueError(f"{name} must be one of {', '.join(allowed)}")
    return value


def search_jobs(
    jobs: DataFrame,
    *,
    title: str | None = None,
    location: str | None = None,
    companies: Sequence[str] = (),
    company_ids: Sequence[str] = (),
    published_after: str | None = None,
    work_type: str | None = None,
    contract_type: str | None = None,
    experience_level: str | None = None,
    rows: int | None = None,
    order: str = "ord",
) -> DataFrame:
    """Job search: title by a boolean expression (see ``functions.boolean``), location and company by
    substring, codes by equality; with ``rows``, that many first rows in order."""
    out = jobs
    if title:
        out = out.where(matches_expression("title", title))
    if location:
        out = out.where(F.contains(F.lower(or_empty("location")), F.lit(location.lower())))
    if companies:
        company = F.lower(or_empty("company"))
        out = out.where(reduce(or_, [F.contains(company, F.lit(c.lower())) for c in companies]))
    if company_ids:
        out = out.where(F.col("company_id").isin(list(company_ids)))
    if published_after:
        out = out.where(F.col("published_at") > published_after)
    for column, value, allowed in (
        ("work_type", work_type, fv.WORK_TYPES),
        ("contract_type", contract_type, fv.CONTRACT_TYPES),
        ("experience_level", experience_level, fv.EXPERIENCE_LEVELS),
    ):
        if _one_of(value, allowed, column):
            out = out.where(F.col(column) == value)
    return out if rows is None else first_rows(out, rows, order)


def search_articles(
    articles: DataFrame,
    *,
    text: str = "",
    author: str = "",
    languages: str = "",
    newspapers: str = "",
    countries: str = "",
    categories: str = "",
    start_date: str = "",
    stop_date: str = "",
    search_in: str = "ALL",
    hide_same: bool = False,
    order: str = "ord",
    order_by: str | None = None,
) -> DataFrame:
    """Article search: text in title or body (or the title alone), author by substring, comma
    separated lists by equality, dates inclusive; ``hide_same`` keeps the first of equal
    bodies in ``order``. ``order_by`` sorts the result: 'date' (newest first), 'rank' (best
    first), or the name of a column; ties go by ``order``."""
    out = articles
    if text:
        needle = F.lit(text.lower())
        fields = ["title"] if search_in.upper() == "TITLE" else ["title", "article_text"]
        out = out.where(reduce(or_, [F.contains(F.lower(or_empty(f)), needle) for f in fields]))
    if author:
        out = out.where(F.contains(F.lower(or_empty("authors")), F.lit(author.lower())))
    for column, wanted in (
        ("language", languages),
        ("issue_cid", newspapers),
        ("issue_country", countries),
        ("section", categories),
    ):
        values = [v.strip().lower() for v in wanted.split(",") if v.strip()]
        if values:
            out = out.where(F.lower(F.col(column)).isin(values))
    if start_date:
        out = out.where(F.col("issue_date") >= start_date)
    if stop_date:
        out = out.where(F.col("issue_date") <= stop_date)
    if hide_same:
        out = dedupe_text(out, "article_text", order)
    if order_by is None:
        return out
    newest = {"date": F.desc_nulls_last("issue_date"), "rank": F.desc_nulls_last("rank")}
    return out.orderBy(newest.get(order_by, F.asc_nulls_last(order_by)), order)


def past_window(code: str) -> int:
    """Seconds of a time filter code such as ``r86400``."""
    if not re.fullmatch(r"r[0-9]+", code):
        raise ValueError(f"unknown time filter: {code}")
    return int(code[1:])


def within_last(df: DataFrame, time_col: str, seconds: int | str, as_of: Column) -> DataFrame:
    """Rows not older than the given number of seconds (or filter code) at ``as_of``."""
    span = past_window(seconds) if isinstance(seconds, str) else seconds
    return df.where(
        (F.col(time_col) >= as_of - F.make_dt_interval(secs=F.lit(span))) & (F.col(time_col) <= as_of)
    )


def sort_posts(df: DataFrame, sort_order: str, *, time_col: str, tie: str, relevance: Column | None = None) -> DataFrame:
    """Newest first, or by a relevance score."""
    if sort_order == "recent":
        return df.orderBy(F.col(time_col).desc(), tie)
    if sort_order == "relevance" and relevance is not None:
        return df.orderBy(relevance.desc(), tie)
    raise ValueError(f"unknown sort order: {sort_order}")
