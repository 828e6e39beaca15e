"""Press articles: search hits, metadata and details to article rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..functions.arrays import clean_items
from ..operators.dedupe import first_wins
from ..operators.joins import latest_by_id, not_completed
from ..operators.limits import first_rows
from ..operators.rows import counted, press_rows
from ..operators.tables import read_table, upsert_table
from ..session import materialize
from ..sources.press import parse_details, parse_highlights, parse_hits, parse_metadata


def first_highlights(pages: DataFrame, page: str = "page") -> Column:
    """First non-empty highlight list over the result pages, joined by '|', as one value."""
    filled = F.exists("highlights", lambda h: h.isNotNull() & (h != ""))
    kept = pages.where(filled).select(page, F.array_join(clean_items("highlights"), "|").alias("h"))
    return F.coalesce(kept.agg(F.min_by("h", page)).scalar(), F.lit(""))


def new_hits(hits: DataFrame, existing: DataFrame, max_results: int | None = None) -> DataFrame:
    """Hits still to process: within the limit, with an id, each id once, not completed.

    Repeated ids go first, inside the map tasks, so that none is hot in the joins; those run on
    the same key and keep the partitioning.
    """
    limited = hits if max_results is None else first_rows(hits, max_results, "ord")
    with_id = limited.withColumn("region_id", F.col("hit.RegionId")).where(
        F.col("region_id").isNotNull() & (F.col("region_id") != "")
    )
    return not_completed(first_wins(with_id, "region_id", "ord"), existing)


def article_rows(
    hits: DataFrame,
    metadata: DataFrame,
    details: DataFrame,
    existing: DataFrame,
    *,
    search_text: str,
    highlights: Column | None = None,
    max_results: int | None = None,
) -> DataFrame:
    """Rows for new hits: metadata is required, details are optional.

    ``hits`` has ``ord, hit``; ``metadata`` has ``ord, meta`` (the last of equal ids counts);
    ``details`` has ``detail`` (of equal ids the largest counts, or the last one where it has an
    ``ord``); ``existing`` has ``ord, region_id, article_text``.
    """
    todo = new_hits(hits, existing, max_results)
    meta = latest_by_id(
        metadata.select("ord", "meta", F.col("meta.Id").alias("region_id")), "region_id", "ord"
    ).drop("ord")
    one = F.max_by("detail", "ord") if "ord" in details.columns else F.max("detail")
    detail = details.groupBy(F.col("detail.Id").alias("region_id")).agg(one.alias("detail"))
    # Both have one row per id already.
    joined = todo.join(meta, "region_id").join(detail, "region_id", "left")
    return press_rows(
        joined.select("ord", "hit", "meta", "detail"), search_text, F.lit("") if highlights is None else highlights
    )


def in_arrival_order(rows: DataFrame, page: str) -> DataFrame:
    """``ord`` from a page number and the place within it (``pos``), free of collisions up to 2^31 each."""
    place = F.shiftleft(F.col(page).cast("bigint"), 32) + F.col("pos")
    return rows.withColumn("ord", place).drop(page, "pos")


def press_run(
    spark: SparkSession,
    root: str,
    pages: DataFrame,
    batches: DataFrame,
    details: DataFrame,
    *,
    schema: StructType | str,
    search_text: str,
    max_results: int | None = None,
) -> dict[str, int]:
    """One run from stored responses to the maintained table: new hits become rows and are upserted.

    ``pages`` has ``page, raw``, ``batches`` has ``batch, raw`` and ``details`` has ``raw``. Returns how many hits
    there were, how many rows they made, and how many stored rows were changed and added.
    """
    hits = in_arrival_order(parse_hits(pages), "page")
    metadata = in_arrival_order(parse_metadata(batches), "batch")
    existing = read_table(spark, root, schema)
    made = article_rows(
        hits, metadata, parse_details(details), existing, search_text=search_text,
        highlights=first_highlights(parse_highlights(pages)), max_results=max_results,
    )
    made, seen = counted(made, "press")
    made = materialize(made)
    counts = upsert_table(spark, root, made, schema)
    return {"hits": hits.count(), "rows": seen.get["rows"], **counts}
