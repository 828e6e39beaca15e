"""Posts: page snapshots to a table with insights."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fv
from ..operators.dedupe import first_wins
from ..operators.enrich import answered_texts, insight_answer, insight_or_fallback, insights_for_mode
from ..operators.limits import first_rows, passes_until_idle
from ..operators.rows import with_collection_time
from ..session import materialize
from ..sources.pages import parse_posts


def collect_posts(
    posts: DataFrame,
    passes: DataFrame,
    *,
    max_posts: int | None = None,
    max_idle: int = fv.MAX_IDLE_PASSES,
    max_passes: int | None = None,
) -> DataFrame:
    """The first sighting of every post, over the passes that a run makes, up to a number of
    posts in ``(snapshot_pass, card_pos)`` order."""
    made = passes_until_idle(
        posts, passes, key="post_id", pass_col="snapshot_pass", max_idle=max_idle, max_passes=max_passes
    )
    seen = posts.join(made.select("snapshot_pass"), "snapshot_pass", "left_semi")
    unique = first_wins(seen, "post_id", ["snapshot_pass", "card_pos"])
    return unique if max_posts is None else first_rows(unique, max_posts, "snapshot_pass", "card_pos")


def external_insights(posts: DataFrame, answer: Callable[[str], str | None], **request) -> DataFrame:
    """Posts with ``insight`` from an answer function; the rule-based one where no answer fits or says
    anything. ``error`` tells what a failed call said."""
    place = F.shiftleft(F.col("snapshot_pass").cast("bigint"), 32) + F.col("card_pos")
    posts = materialize(posts.withColumn("_place", place))
    answered = answered_texts(
        posts, answer, kind="insights", key="_place", text="content", order="_place",
        parsed=insight_answer("raw", "expected"), **request,
    )
    joined = posts.join(answered.withColumnRenamed("member_id", "_place"), "_place", "left").drop("_place")
    return joined.withColumn("insight", insight_or_fallback("answered", "content"))


def post_table(
    snapshots: DataFrame,
    *,
    mode: str | None = "none",
    at: Column | None = None,
    answer: Callable[[str], str | None] | None = None,
    request: dict | None = None,
    **limits,
) -> DataFrame:
    """Post rows with insights. ``snapshots`` has ``snapshot_pass, html``.

    With mode 'external', ``answer`` is called with prompts that ``request`` shapes (``size``, ``max_chars``),
    and an ``error`` column is added.
    """
    # Both the stop rule and the result need the posts; they are parsed once.
    seen = materialize(parse_posts(snapshots))
    posts = collect_posts(seen, snapshots.select("snapshot_pass"), **limits)
    external = mode == "external"
    found = external_insights(posts, answer, **(request or {})) if external else insights_for_mode(posts, "content", mode)
    rows = with_collection_time(found, at)
    sources = [
        "post_id",
        "post_url",
        "author_name",
        "author_profile",
        "author_job",
        "post_time",
        "content",
        "reactions",
        "comments",
        "impressions",
        "Date_Collected",
        "insight.job_titles",
        "insight.responsibilities",
        "insight.skills",
        "insight.requirements",
    ]
    return rows.select(
        "snapshot_pass",
        "card_pos",
        *[F.col(s).alias(n) for s, n in zip(sources, fv.POST_COLUMNS)],
        *(["error"] if external else []),
    )
