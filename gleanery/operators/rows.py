"""Row builders: one ``select`` each."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

from .. import fixed_values as fv
from ..functions.arrays import (
    blocks_text,
    clean_items,
    entry_author,
    entry_categories,
    entry_text,
    fields_of,
    no_strings,
)
from ..functions.dates import feed_date, parse_year
from ..functions.skills import description_sections, normalize_skills
from ..functions.text import csv_safe, nonblank, nonempty, or_empty, plain_texts, strip
from ..functions.urls import article_url


def keep_computed(df: DataFrame, columns: dict[str, Column], keep: Callable[[Column], Column]) -> DataFrame:
    """Add (or replace) costly columns and keep the rows that pass a test on them.

    A plain filter would be pushed below the projection, with the costly expressions copied
    into each of its terms. Here the columns are computed once per row, as a one-row array
    that is empty when the test fails.
    """
    made = F.struct(*[c.alias(n) for n, c in columns.items()])
    others = [c for c in df.columns if c not in columns]
    return df.select(*others, F.inline(F.filter(F.array(made), keep)))


def normalize_jobs(items: DataFrame, sections: bool = True) -> DataFrame:
    """Job rows from raw items: the first non-empty of the alternative fields, trimmed where
    the reader expects trimmed text, with sections and normalized skills."""

    def first(*names: str) -> Column:
        return F.coalesce(*[nonempty(n) for n in names], F.lit(""))

    rows = items.select(
        "ord",
        or_empty("search_query").alias("search_query"),
        strip(or_empty("title")).alias("title"),
        strip(first("companyName", "company")).alias("company"),
        strip(first("location", "companyLocation")).alias("location"),
        first("publishedAt", "listedAt").alias("published_at"),
        first("jobUrl", "url", "link").alias("url"),
        strip(first("description", "jobDescription", "jobDescriptionText")).alias("description"),
    )
    return with_sections(rows) if sections else rows


def with_sections(jobs: DataFrame) -> DataFrame:
    """Add responsibilities, normalized skills and requirements from the description. (Outer
    white space, already trimmed, has no bearing on sections.)"""
    found = jobs.withColumn("_sections", description_sections("description"))
    return found.select(
        "ord",
        *fv.JOB_COLUMNS[:6],
        F.col("_sections.responsibilities").alias("responsibilities"),
        normalize_skills("_sections.skills").alias("skills"),
        F.col("_sections.requirements").alias("requirements"),
        "description",
    )


def press_rows(joined: DataFrame, search_text: str | Column, highlights: Column) -> DataFrame:
    """Article rows from ``hit``, ``meta`` and ``detail`` structs; list columns stay arrays."""
    hit, meta, detail = F.col("hit"), F.col("meta"), F.col("detail")
    issue = meta["Issue"]
    length = F.coalesce(detail["TotalTextLength"], meta["TotalTextLength"])
    columns = {
        "search_text": F.lit(search_text) if isinstance(search_text, str) else search_text,
        "highlights": highlights,
        "region_id": hit["RegionId"],
        "profile_id": or_empty(hit["ProfileId"]),
        "issue_id": or_empty(issue["Id"]),
        "issue_title": or_empty(issue["Title"]),
        "issue_date": F.coalesce(nonempty(issue["ShortDateString"]), issue["Date"], F.lit("")),
        "issue_country": or_empty(issue["CountryCode"]),
        "issue_cid": or_empty(issue["CID"]),
        "page": or_empty(meta["Page"]),
        "page_name": or_empty(meta["PageName"]),
        "section": or_empty(meta["Section"]),
        "title": or_empty(meta["Title"]),
        "subtitle": or_empty(meta["Subtitle"]),
        "hyphenated_title": or_empty(meta["HyphenatedTitle"]),
        "language": or_empty(meta["Language"]),
        "authors": clean_items(fields_of(meta["Bylines"], "Text")),
        "byline": or_empty(meta["Byline"]),
        "is_top_article": hit["IsTopArticle"],
        "rank": hit["Rank"],
        "rate": or_empty(meta["Rate"]),
        "similars_count": meta["SimilarsCount"],
        "current_text_length": meta["CurrentTextLength"],
        # A length of 0 counts as missing.
        "total_text_length": F.nullif(length, F.lit(0)),
        "classification_tags": clean_items(fields_of(meta["Classification"]["Tags"], "DisplayName")),
        "related_titles": clean_items(fields_of(meta["Related"], "Title")),
        "images": clean_items(fields_of(meta["Images"], "Url")),
        "article_url": article_url(hit, meta, detail),
        "article_text": or_empty(blocks_text(detail["Blocks"])),
    }
    return joined.select(*[c for c in joined.columns if c == "ord"], *[v.alias(k) for k, v in columns.items()])


def with_entry_text(entries: DataFrame) -> DataFrame:
    """Add ``article_text``: title, summary, contents and summary detail as plain text, joined
    by blank lines; empty parts dropped, repeated ones kept."""
    e = F.col("entry")
    parts = F.concat(
        F.array(e["title"], e["summary"]), F.coalesce(e["contents"], no_strings()), F.array(e["summary_detail"])
    )
    return entries.withColumn("article_text", entry_text(plain_texts(parts)))


def feed_match_rows(matches: DataFrame) -> DataFrame:
    """The columns of a feed match; categories and keywords stay arrays."""
    e = F.col("entry")
    return matches.select(
        *[c for c in ("ord", "entry_pos") if c in matches.columns],
        csv_safe("title").alias("feed_title"),
        F.col("xml_url").alias("feed_xml_url"),
        or_empty("html_url").alias("feed_html_url"),
        csv_safe(e["title"]).alias("entry_title"),
        csv_safe(entry_author(e["author_names"], e["author"])).alias("entry_author"),
        e["link"].alias("entry_url"),
        feed_date(*[F.get(e["dates"], F.lit(i)) for i in range(3)]).alias("published"),
        F.transform(entry_categories(e["terms"]), csv_safe).alias("categories"),
        "matched_keywords",
        csv_safe("article_text").alias("article_text"),
    )


def clean_matches(
    matches: DataFrame,
    *,
    min_year: int = fv.MIN_YEAR,
    min_chars: int = fv.MIN_CHARS,
    strict_formats: bool = False,
) -> DataFrame:
    """Keep recent, long enough matches and clean their text columns; the others stay raw."""
    # A plain filter would be pushed down, with the date parsed in it and again in the result.
    year = {"_year": parse_year("published", strict_formats)}
    kept = keep_computed(matches, year, lambda row: row["_year"] >= min_year).drop("_year")
    names = ["article_text", "entry_title", "entry_author", "feed_title"]
    if dict(matches.dtypes)["categories"] == "string":
        names.append("categories")
    cleaned = keep_computed(
        kept, {n: csv_safe(n) for n in names}, lambda row: F.length(row["article_text"]) >= min_chars
    )
    return cleaned.select(*matches.columns)


def body_missing(text: str = "article_text", url: str = "article_url") -> Column:
    """Whether a row has a link but no body."""
    return nonblank(or_empty(text)).isNull() & nonblank(or_empty(url)).isNotNull()


def with_collection_time(posts: DataFrame, at: Column | None = None) -> DataFrame:
    """Add ``Date_Collected``: given time, or now, to the second."""
    moment = F.current_timestamp() if at is None else at
    return posts.withColumn("Date_Collected", F.date_trunc("second", moment))


def union_all(*frames: DataFrame) -> DataFrame:
    """Union by column name; a missing column becomes null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def counted(df: DataFrame, name: str, **counters: Column) -> tuple[DataFrame, Observation]:
    """Count rows (and sums of the given flags) while the rows pass, without a second job."""
    seen = Observation(name)
    sums = [F.sum(F.when(flag, 1).otherwise(0)).alias(k) for k, flag in counters.items()]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *sums), seen
