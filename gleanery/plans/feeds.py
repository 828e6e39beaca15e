"""Feeds: feed list and feed documents to keyword matches, and their cleaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as fv
from ..operators.rows import clean_matches, feed_match_rows, with_entry_text
from ..operators.search import match_keywords
from ..sources.feeds import parse_feeds


def scan_feeds(
    feeds: DataFrame,
    docs: DataFrame,
    keywords: Sequence[str] = tuple(fv.DEFAULT_KEYWORDS),
    *,
    max_items: int | None = None,
    whole_word: bool = False,
) -> DataFrame:
    """Entries that contain a keyword, in ``(ord, entry_pos)`` order.

    ``feeds`` has ``ord, title, xml_url, html_url`` and ``docs`` has ``xml_url, raw``, one per
    link. Documents are cut to entries and filtered before the join, which then carries
    matches only.
    """
    entries = parse_feeds(docs.where(F.col("raw").isNotNull()), max_items=max_items)
    matches = match_keywords(with_entry_text(entries), "article_text", keywords, whole_word)
    return feed_match_rows(matches.join(feeds, "xml_url"))


def scan_and_clean(
    feeds: DataFrame,
    docs: DataFrame,
    keywords: Sequence[str] = tuple(fv.DEFAULT_KEYWORDS),
    *,
    min_year: int = fv.MIN_YEAR,
    min_chars: int = fv.MIN_CHARS,
    max_items: int | None = None,
) -> DataFrame:
    """Scan and clean as one plan."""
    found = scan_feeds(feeds, docs, keywords, max_items=max_items)
    return clean_matches(found, min_year=min_year, min_chars=min_chars)
