"""Cards and bodies out of HTML pages at rest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fv
from ..functions.dates import first_short_date
from ..functions.html import listing_cards, paragraphs, post_cards
from ..functions.numbers import abbreviated_number
from ..functions.text import article_clean, collapse, nonempty, or_empty, strip, word_count
from ..functions.urls import absolute, post_id

_ONLY_DATE = r"^(?:" + fv.SHORT_DATE_PATTERN + r")\z"


def _not_a_date(text: Column) -> Column:
    return (text != "") & ~text.rlike(_ONLY_DATE)


def card_publisher(badge: Column, logo: Column, spans: Column) -> Column:
    """Badge text unless it is a date, else the logo's name, else the first text that is not a
    date, else ''."""
    label = collapse(badge)
    others = F.filter(F.transform(spans, collapse), _not_a_date)
    return (
        F.when(_not_a_date(label), label)
        .when(nonempty(logo).isNotNull(), collapse(logo))
        .otherwise(or_empty(F.get(others, F.lit(0))))
    )


def card_date(strings: Column) -> Column:
    """First short date in the card's texts, as ISO, else ''."""
    dated = F.get(F.filter(strings, lambda s: s.rlike(fv.SHORT_DATE_PATTERN)), F.lit(0))
    return or_empty(first_short_date(dated))


def complete_cards(cards: DataFrame) -> DataFrame:
    """Only cards with title, summary, publisher and date."""
    needed = [F.col(c) != "" for c in ("title", "summary", "publisher", "publish_date")]
    return cards.where(needed[0] & needed[1] & needed[2] & needed[3])


def parse_listing(
    pages: DataFrame, page: str = "page", html: str = "html", base_url: str = fv.BLOG_BASE_URL
) -> DataFrame:
    """Complete article cards of listing pages, one row each, in ``(page, card_pos)`` order."""
    raw = pages.where(F.col(html).isNotNull()).select(
        F.col(page).alias("page"), F.posexplode(listing_cards(html, base_url)).alias("card_pos", "c")
    )
    return complete_cards(
        raw.select(
            "page",
            F.col("card_pos").cast("bigint").alias("card_pos"),
            collapse("c.title").alias("title"),
            card_publisher(F.col("c.badge"), F.col("c.logo"), F.col("c.spans")).alias("publisher"),
            card_date(F.col("c.strings")).alias("publish_date"),
            collapse("c.summary").alias("summary"),
            F.col("c.url").alias("url"),
        )
    )


def parse_posts(snapshots: DataFrame, snapshot: str = "snapshot_pass", html: str = "html") -> DataFrame:
    """Post cards of page snapshots that have an id, in ``(snapshot_pass, card_pos)`` order.
    The same post appears once per snapshot that shows it."""
    raw = snapshots.where(F.col(html).isNotNull()).select(
        F.col(snapshot).alias("snapshot_pass"), F.posexplode(post_cards(html)).alias("card_pos", "c")
    )

    def label_number(name: str) -> Column:
        return abbreviated_number(or_empty(F.substring_index(F.col(f"c.{name}"), " ", 1)))

    seen = F.lower("c.impressions_text")
    views = F.substring_index(strip(F.replace(seen, F.lit("impressions"), F.lit(""))), " ", 1)
    return raw.select(
        "snapshot_pass",
        F.col("card_pos").cast("bigint").alias("card_pos"),
        post_id("c.link", "c.data_urn").alias("post_id"),
        or_empty(absolute("c.link", "/feed/update/")).alias("post_url"),
        or_empty("c.author_name").alias("author_name"),
        or_empty(absolute("c.author_profile", "/in/")).alias("author_profile"),
        or_empty("c.author_job").alias("author_job"),
        or_empty("c.post_time").alias("post_time"),
        or_empty("c.content").alias("content"),
        label_number("reactions_label").alias("reactions"),
        label_number("comments_label").alias("comments"),
        F.when(F.contains(seen, F.lit("impressions")), abbreviated_number(views))
        .otherwise(F.lit(0).cast("bigint"))
        .alias("impressions"),
    ).where(F.col("post_id").isNotNull())


def join_paragraphs(texts: Column | str) -> Column:
    """Paragraphs of at least three words, joined by a blank line."""
    column = F.col(texts) if isinstance(texts, str) else texts
    kept = F.filter(F.transform(column, collapse), lambda p: word_count(p) >= fv.MIN_PARAGRAPH_WORDS)
    return F.array_join(kept, "\n\n")


def page_bodies(pages: DataFrame, html: str = "html", body: str = "body") -> DataFrame:
    """Add the readable body of each page; the HTML column is dropped.

    Parser output and joined text are columns of their own, so that each is computed once.
    """
    kept = [c for c in pages.columns if c != html]
    parsed = pages.select(*kept, paragraphs(nonempty(html)).alias("_paragraphs"))
    joined = parsed.select(*kept, join_paragraphs("_paragraphs").alias("_text"))
    return joined.select(*kept, article_clean("_text").alias(body))
