"""Blog articles: listing pages and stored article pages to one table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as fv
from ..operators.dedupe import first_wins
from ..operators.joins import by_candidate_url
from ..operators.limits import stop_at_empty_page
from ..session import materialize
from ..sources.pages import page_bodies, parse_listing


def collect_articles(listing: DataFrame, base_url: str = fv.BLOG_BASE_URL) -> DataFrame:
    """Cards up to the first page without any, the first of equal links kept.

    ``listing`` has ``page, html``; pages without HTML were not fetched and are skipped.
    """
    # Both the cut-off and the result need the cards; they are parsed once.
    cards = materialize(parse_listing(listing, base_url=base_url))
    fetched = listing.where(F.col("html").isNotNull()).select("page")
    return first_wins(stop_at_empty_page(cards, fetched), "url", ["page", "card_pos"])


def blog_table(listing: DataFrame, stored_pages: DataFrame, base_url: str = fv.BLOG_BASE_URL) -> DataFrame:
    """Articles with the body of their stored page (``url, html``, one per link)."""
    articles = collect_articles(listing, base_url)
    # Pages are parsed after the join: only those that an article links to.
    found = by_candidate_url(articles, stored_pages, body="html")
    return page_bodies(found).select(
        "title",
        "publisher",
        "publish_date",
        "summary",
        F.col("body").alias("detail_content"),
        F.col("url").alias("source_url"),
        F.col("page").alias("engblogs_page"),
        "card_pos",
    )
