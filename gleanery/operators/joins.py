"""Joins between hits, metadata, details, pages and dictionaries.

Both sides are cut to one row per key before they meet, so no key can multiply or skew a
join. Join strategies are left to the optimizer, which broadcasts a side only when its size
statistics allow it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import nonblank, or_empty
from ..functions.urls import candidate_urls
from .dedupe import Order, _names, first_wins, last_wins


def latest_by_id(df: DataFrame, key: str, order) -> DataFrame:
    """Last row per non-empty key."""
    return last_wins(df.where(F.col(key).isNotNull() & (F.col(key) != "")), key, order)


def one_per_id(df: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """One row per key: the last in ``order``, or without an order the smallest row."""
    others = [c for c in df.columns if c not in (key, order)]
    return first_wins(df, key, others or key) if order is None else last_wins(df, key, order)


def inner_by_id(left: DataFrame, right: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """Rows of ``left`` with the one row of ``right`` that counts for their key."""
    return left.join(one_per_id(right, key, order), key, "inner")


def left_by_id(left: DataFrame, right: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """All rows of ``left``, with the one row of ``right`` that counts for their key, if any."""
    return left.join(one_per_id(right, key, order), key, "left")


def except_by_id(left: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows of ``left`` whose key is not in ``done``."""
    return left.join(done.select(key), key, "left_anti")


def not_completed(hits: DataFrame, existing: DataFrame, key: str = "region_id") -> DataFrame:
    """Hits whose id has no stored row with a body. The last stored row of an id decides."""
    done = (
        existing.where(nonblank(key).isNotNull())
        .select(nonblank(key).alias(key), nonblank("article_text").isNotNull().alias("_done"), "ord")
        .groupBy(key)
        .agg(F.max_by("_done", "ord").alias("_done"))
        .where("_done")
        .select(key)
    )
    return hits.join(done, key, "left_anti")


def by_row_id(
    records: DataFrame, results: DataFrame, key: str, column: str, default: Column, order: str | None = None
) -> DataFrame:
    """Attach results to records by row id; records without a result get the default.

    Of several results of one id the last in ``order`` counts (without an order the largest).
    """
    one = F.max(column) if order is None else F.max_by(column, order)
    joined = records.join(results.groupBy(key).agg(one.alias(column)), key, "left")
    return joined.withColumn(column, F.coalesce(F.col(column), default))


def by_candidate_url(
    articles: DataFrame, stored: DataFrame, *, url: str = "url", body: str = "body", order: Order | None = None
) -> DataFrame:
    """Attach the body of the first host variant of each article's link that is stored, else
    ''. Of several stored pages of one link the last in ``order`` (one or more columns) counts, of those
    with the same place the one with the largest body; without an order the smallest body.

    Finding the variant joins distinct links with distinct stored links; bodies are cut to one for each link before they meet
    the winners, so any number of copies of a link on either side costs one row inside.
    """
    place = F.lit(0) if order is None else F.struct(*[F.col(c) for c in _names(order)])
    stored = stored.select(F.col(url).alias("_page_url"), F.col(body).alias("_body"), place.alias("_place"))
    one = F.min("_body") if order is None else F.max(F.struct("_place", "_body"))["_body"]
    links = articles.select(F.col(url).alias("_url")).distinct()
    variants = links.select("_url", F.posexplode(candidate_urls("_url")).alias("_idx", "_page_url"))
    known = variants.join(stored.select("_page_url").distinct(), "_page_url")
    best = known.groupBy("_url").agg(F.min_by("_page_url", "_idx").alias("_page_url"))
    asked = stored.join(best.select("_page_url").distinct(), "_page_url", "left_semi")
    bodies = asked.groupBy("_page_url").agg(one.alias("_body"))
    found = best.join(bodies, "_page_url").select(F.col("_url").alias(url), F.col("_page_url").alias("stored_url"), F.col("_body").alias(body))
    return articles.join(found, url, "left").withColumns(
        {"stored_url": or_empty("stored_url"), body: or_empty(body)}
    )


def canonical_by_dimension(tokens: DataFrame, dictionary: DataFrame, token: str = "token") -> DataFrame:
    """Map tokens to their canonical name through a dictionary table (``word``, ``name``);
    tokens that are not in it are dropped."""
    keyed = tokens.withColumn("_word", F.lower(F.col(token)))
    return keyed.join(dictionary.select(F.col("word").alias("_word"), "name"), "_word").drop("_word")
