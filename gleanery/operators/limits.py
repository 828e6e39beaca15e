"""Row numbers, limits, batches and stop rules over arrival order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import fixed_values as fv
from ..functions.arrays import preview_list
from ..functions.text import nonempty
from ..session import materialize
from .dedupe import first_n

# Rows that are numbered together, and buckets a single task may add up, as powers of two. The rows of a bucket meet in one
# task, with all their columns: few enough to be a small share of a partition even with whole texts.
_ROW_BITS = 10
_BUCKET_BITS = 22


def row_index(
    df: DataFrame, order: str, name: str = "row_idx", partition_by: Sequence[str] = ()
) -> DataFrame:
    """Number rows from 0 in the order of a bigint column that is unique (within
    ``partition_by``), without one window over all rows.

    Rows fall into buckets of neighbouring order values. As values are unique, a bucket holds
    at most 2**10 rows, also where one partition key holds most of the table. Bucket counts
    become offsets in two steps, over groups of 2**22 buckets and over the at most 2**22
    groups, so every window is bounded. The input is read twice, for the counts and for the
    rows: store a costly one first.
    """
    keys = list(partition_by)
    rows = df.withColumn("_bucket", F.shiftright(F.col(order).cast("bigint"), _ROW_BITS))
    buckets = (
        rows.groupBy(*keys, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_group", F.shiftright("_bucket", _BUCKET_BITS))
    )
    groups = buckets.groupBy(*keys, "_group").agg(F.sum("_n").alias("_n"))

    def rows_before(*within: str, by: str) -> Column:
        earlier = Window.partitionBy(*within).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("_n").over(earlier), F.lit(0))

    def matched(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
        """Join on the keys (null equals null) and one bucket column."""
        names = [*keys, column]
        renamed = right.withColumnsRenamed({n: f"_r_{n}" for n in names})
        same = [left[n].eqNullSafe(renamed[f"_r_{n}"]) for n in names]
        return left.join(renamed, same).drop(*[f"_r_{n}" for n in names])

    group_starts = groups.select(*keys, "_group", rows_before(*keys, by="_group").alias("_start"))
    bucket_starts = matched(
        buckets.withColumn("_inner", rows_before(*keys, "_group", by="_bucket")), group_starts, "_group"
    ).select(*keys, "_bucket", (F.col("_start") + F.col("_inner")).alias("_start"))
    place = F.row_number().over(Window.partitionBy(*keys, "_bucket").orderBy(order))
    return (
        matched(rows, bucket_starts, "_bucket")
        .withColumn(name, (F.col("_start") + place - 1).cast("bigint"))
        .select(*df.columns, name)
    )


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows in the order of any sortable columns, nulls first, for any ``n``.

    Rows of equal order values are told apart by a hash of the whole row, so the choice is the same on every run, and
    many equal values do not meet in one task. Order values and hashes alone are sorted, once, into ranges that are
    counted; the range in which the n-th row lies gives the last key that is taken, and the rows are filtered by it.
    Runs jobs when called.
    """
    columns = [F.col(c).alias(f"k{i}") for i, c in enumerate(order)]
    key = F.struct(*columns, F.xxhash64(*df.columns).alias("row"))
    ranges = df.select(key.alias("key")).repartitionByRange("key").withColumn("part", F.spark_partition_id())
    keys = materialize(ranges)
    before, part, rest = 0, None, 0
    for row in keys.groupBy("part").count().orderBy("part").collect():  # a row for each partition
        if before + row["count"] >= n:
            part, rest = row["part"], n - before
            break
        before += row["count"]
    if part is None:
        return df
    if rest <= 0:
        return df.limit(0)
    place = F.row_number().over(Window.partitionBy("part").orderBy("key"))
    last = materialize(keys.where(F.col("part") == part).withColumn("n", place).where(F.col("n") == rest).select("key"))
    cut = last.scalar()
    rank = keys.where(F.col("part") == part).agg(
        F.count(F.when(F.col("key") < cut, 1)).alias("less"), F.count(F.when(F.col("key") == cut, 1)).alias("same")
    )
    found = rank.first()
    if rest - found["less"] == found["same"]:
        return df.where(key <= cut)
    # Rows that equal the last one in all columns: any of them will do.
    return df.where(key < cut).unionByName(df.where(key == cut).limit(rest - found["less"]))


def first_per_key(df: DataFrame, key: str, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows of each key, cut inside the map tasks already."""
    return first_n(df, key, [F.col(c) for c in order], n)


def batch_ids(
    df: DataFrame, size: int, order: str = "ord", partition_by: Sequence[str] = ()
) -> DataFrame:
    """Add ``batch_id`` (fixed-size chunks in order, from 0) and ``batch_pos`` (from 0)."""
    numbered = row_index(df, order, "_idx", partition_by)
    return numbered.withColumns(
        {
            "batch_id": F.expr(f"_idx div {size}"),
            "batch_pos": F.col("_idx") % size,
        }
    ).drop("_idx")


def stop_at_empty_page(cards: DataFrame, pages: DataFrame, page: str = "page") -> DataFrame:
    """Cards of pages before the first fetched page that has none.

    ``pages`` lists the pages that were fetched; a page missing there is skipped, not a stop.
    The cut-off is one number, read as a scalar subquery.
    """
    full = cards.select(page).distinct()
    first_empty = pages.join(full, page, "left_anti").agg(F.min(page).alias("stop"))
    stop = first_empty.scalar()
    return cards.where(stop.isNull() | (F.col(page) < stop))


def passes_until_idle(
    sightings: DataFrame,
    passes: DataFrame,
    *,
    key: str,
    pass_col: str,
    max_idle: int = fv.MAX_IDLE_PASSES,
    max_passes: int | None = None,
) -> DataFrame:
    """The passes that a run makes: it stops after ``max_idle`` passes in a row without a new
    key, or after ``max_passes`` if that is given.

    ``passes`` holds one row per pass (a bigint column). Passes are numbered by :func:`row_index`, and the last pass with a
    new key is carried from bucket to bucket of passes in the same two steps, so no task sees all passes, however
    many there are; the stop is one number, read as a scalar subquery.
    """
    first_seen = sightings.groupBy(key).agg(F.min(pass_col).alias("_pass"))
    fresh = first_seen.groupBy("_pass").agg(F.count(F.lit(1)).alias("new_keys"))
    made = passes.select(F.col(pass_col).alias("_pass")).where("_pass is not null").distinct()
    counted = made.join(fresh, "_pass", "left").select("_pass", F.coalesce("new_keys", F.lit(0)).cast("bigint").alias("new_keys"))
    turns = row_index(materialize(counted), "_pass", "_turn").withColumn("_turn", F.col("_turn") + 1)
    if max_passes is not None:
        turns = turns.where(F.col("_turn") <= max_passes)
    turns = carried_max(turns, "_turn", F.when(F.col("new_keys") > 0, F.col("_turn")), "_last_new")
    idle = turns.withColumn("idle_run", (F.col("_turn") - F.coalesce("_last_new", F.lit(0))).cast("bigint"))
    idle = materialize(idle.select("_pass", "_turn", "new_keys", "idle_run"))
    stop = idle.where(F.col("idle_run") >= max_idle).agg(F.min("_turn").alias("stop")).scalar()
    made = idle.where(stop.isNull() | (F.col("_turn") <= stop))
    return made.select(F.col("_pass").alias(pass_col), "new_keys", "idle_run")


def carried_max(df: DataFrame, index: str, value: Column, name: str) -> DataFrame:
    """``name``: the largest ``value`` of all rows up to each one, in the order of a row number (bigint, distinct); null before
    the first value that is not null.

    Each bucket of 2**10 neighbouring rows has its running maximum; what was reached before a bucket comes from the maxima of
    the buckets of its group and of the groups before, as in :func:`row_index`.
    """
    rows = df.withColumns({"_bucket": F.shiftright(index, _ROW_BITS), "_value": value})
    buckets = rows.groupBy("_bucket").agg(F.max("_value").alias("_max")).withColumn("_group", F.shiftright("_bucket", _BUCKET_BITS))
    groups = buckets.groupBy("_group").agg(F.max("_max").alias("_max"))

    def reached(*within: str, by: str) -> Column:
        earlier = Window.partitionBy(*within).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        return F.max("_max").over(earlier)

    inner = buckets.select("_bucket", "_group", reached("_group", by="_bucket").alias("_inner"))
    outer = groups.select("_group", reached(by="_group").alias("_outer"))
    before = inner.join(outer, "_group").select("_bucket", F.greatest("_inner", "_outer").alias("_before"))
    running = F.max("_value").over(Window.partitionBy("_bucket").orderBy(index))
    return rows.withColumn("_running", running).join(before, "_bucket").select(*df.columns, F.greatest("_running", "_before").alias(name))


def preview(jobs: DataFrame, limit: int = 20, order: str = "ord") -> DataFrame:
    """Console table of the first jobs: short lists, cut texts, '-' for nothing."""
    widths = {"Query": 36, "Title": 40, "Company": 28, "Location": 24, "Published": 20}
    sources = ["search_query", "title", "company", "location", "published_at"]
    top = jobs.orderBy(order).limit(limit)

    def cell(source: str, header: str):
        text = F.substring(source, 1, 19) if source == "published_at" else F.col(source)
        return F.substring(F.coalesce(nonempty(text), F.lit("-")), 1, widths[header]).alias(header)

    return top.select(
        *[cell(s, h) for s, h in zip(sources, widths)],
        preview_list("responsibilities", 3, 60).alias("Responsibilities"),
        preview_list("skills", 3, 60).alias("Skills"),
    )


def hidden_rows(jobs: DataFrame, limit: int = 20) -> DataFrame:
    """How many rows the preview leaves out."""
    return jobs.agg(F.greatest(F.count(F.lit(1)) - F.lit(limit), F.lit(0)).alias("more_rows"))
