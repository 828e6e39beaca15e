"""Job ads: raw items to a de-duplicated table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as fv
from ..functions.text import let
from ..operators.dedupe import dedupe_jobs
from ..operators.enrich import answered_texts, keep_nonempty, skill_answer, skills_for_mode, skills_or_fallback
from ..operators.rows import normalize_jobs, with_sections
from ..session import materialize


def job_table(
    items: DataFrame,
    mode: str = "heuristic",
    answer: Callable[[str], str | None] | None = None,
    *,
    size: int = fv.TEXTS_PER_REQUEST,
    max_chars: int | None = None,
) -> DataFrame:
    """Normalized, de-duplicated and enriched jobs; ``ord`` gives the order of first
    appearance.

    The key of the de-duplication does not depend on the extraction, so repeated ads are
    dropped before the costly part. With mode 'external', ``answer`` is called with a prompt for
    every ``size`` jobs; jobs without a fitting answer keep their own skills, and ``error`` tells
    what a failed call said.
    """
    unique = dedupe_jobs(normalize_jobs(items, sections=False))
    jobs = with_sections(unique)
    if mode != "external":
        enriched = jobs.withColumn("skills", skills_for_mode(mode, "description", "skills"))
        return enriched.select("ord", *fv.JOB_COLUMNS)
    jobs = materialize(jobs)
    answered = answered_texts(
        jobs, answer, kind="skills", key="ord", text="description", order="ord",
        parsed=skill_answer("raw", "expected"), size=size, max_chars=max_chars,
    )
    joined = jobs.join(answered.withColumnRenamed("member_id", "ord"), "ord", "left")
    found = let(skills_or_fallback("answered", "skills"), lambda new: keep_nonempty(new, "skills"))
    return joined.withColumn("skills", found).select("ord", *fv.JOB_COLUMNS, "error")
