"""Sinks and table maintenance: CSV edge, append, incremental run, upsert, backfill.

A maintained table is a folder of numbered versions, and of numbered changes on top of each. Both
count once Spark has committed them (their success marker exists); readers take the highest
version with its changes: a job that dies half-way leaves the table as it was, and no job
overwrites files it reads. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import ArrayType, BooleanType, StructType, TimestampType

from ..functions.arrays import blocks_text
from ..functions.text import nonblank, nonempty, or_empty
from ..functions.urls import article_id
from ..session import materialize
from .dedupe import first_wins, last_wins
from .rows import body_missing


# ---- CSV edge ----


def csv_edge(df: DataFrame, separators: Mapping[str, str] | None = None) -> DataFrame:
    """All columns as CSV text: lists joined (by '; ' unless told otherwise), times to the
    second, null to ''."""
    separators = separators or {}

    def edge(field) -> Column:
        c = F.col(field.name)
        if isinstance(field.dataType, ArrayType):
            c = F.array_join(c, separators.get(field.name, "; "))
        elif isinstance(field.dataType, TimestampType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, BooleanType):
            c = F.initcap(c.cast("string"))
        return or_empty(c.cast("string")).alias(field.name)

    return df.select(*[edge(f) for f in df.schema.fields])


def write_csv(
    df: DataFrame, path: str, separators: Mapping[str, str] | None = None, mode: str = "overwrite"
) -> None:
    """CSV files with a header; quotes doubled, empty fields left empty, white space kept."""
    spaces = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    csv_edge(df, separators).write.mode(mode).options(header="true", escape='"', emptyValue="", **spaces).csv(path)


def append_rows(df: DataFrame, path: str) -> None:
    """Append to a Parquet folder. Nothing is de-duplicated across runs."""
    df.write.mode("append").parquet(path)


def append_batch(df: DataFrame, root: str, batch_id: int) -> None:
    """Append the rows of a numbered batch to a folder of batches; a batch that is written again replaces its first try.

    For ``foreachBatch``, which may hand over a batch twice after a failure: its rows count once.
    """
    df.write.mode("overwrite").parquet(f"{root.rstrip('/')}/batch={batch_id}")


def read_batches(spark: SparkSession, root: str, schema: StructType | str) -> DataFrame:
    """The rows of all batches that :func:`append_batch` wrote; an empty table when there is none."""
    empty = spark.createDataFrame([], schema)
    fs, path = _folder(spark, root)
    if not fs.exists(path):
        return empty
    return spark.read.schema(empty.schema).parquet(root).select(*empty.columns)


# ---- versions ----


def _folder(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _version_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/version-{version:08d}"


def _committed(spark: SparkSession, root: str, kind: str) -> list[str]:
    """Names of the committed folders of a kind, in order."""
    fs, path = _folder(spark, root)
    if not fs.exists(path):
        return []
    marker = spark._jvm.org.apache.hadoop.fs.Path
    names = [status.getPath() for status in fs.listStatus(path)]
    return sorted(p.getName() for p in names if p.getName().startswith(kind) and fs.exists(marker(p, "_SUCCESS")))


def committed_version(spark: SparkSession, root: str) -> int | None:
    """Highest committed version, or null when there is none."""
    found = _committed(spark, root, "version-")
    return int(found[-1].removeprefix("version-")) if found else None


def committed_deltas(spark: SparkSession, root: str, version: int) -> list[str]:
    """Names of the changes committed on top of a version, in order."""
    return _committed(spark, root, f"delta-{version:08d}-")


def read_table(spark: SparkSession, root: str, schema: StructType | str, order: str = "ord") -> DataFrame:
    """The table as of its last commit; an empty one when there is none.

    Rows of a version that a later change rewrote (same order value) give way to the last change.
    """
    version = committed_version(spark, root)
    if version is None:
        return spark.createDataFrame([], schema)
    base = spark.read.schema(schema).parquet(_version_path(root, version))
    deltas = committed_deltas(spark, root, version)
    if not deltas:
        return base
    changes = [
        spark.read.schema(schema).parquet(f"{root.rstrip('/')}/{name}").withColumn("_turn", F.lit(i))
        for i, name in enumerate(deltas)
    ]
    together = reduce(DataFrame.unionByName, changes)
    latest = last_wins(together, order, "_turn").drop("_turn")
    return base.join(latest.select(order), order, "left_anti").select(*latest.columns).unionByName(latest)


def write_next_version(spark: SparkSession, df: DataFrame, root: str, keep: int = 2) -> int:
    """Write a new version, then drop all but the last ``keep`` ones with their changes.

    Older folders than the kept ones are no longer read by jobs that start now; jobs that still read one fail and
    can be run again.
    """
    version = (committed_version(spark, root) or 0) + 1
    df.write.mode("overwrite").parquet(_version_path(root, version))
    fs, path = _folder(spark, root)
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        if name.startswith(("version-", "delta-")) and int(name.split("-")[1]) <= version - keep:
            fs.delete(status.getPath(), True)
    return version


def write_delta(spark: SparkSession, df: DataFrame, root: str, version: int) -> str:
    """Write changed and added rows on top of a version; they count once all of them are written."""
    number = len(committed_deltas(spark, root, version)) + 1
    path = f"{root.rstrip('/')}/delta-{version:08d}-{number:06d}"
    df.write.mode("overwrite").parquet(path)
    return path


# ---- upsert ----


def mark_new(existing: DataFrame, new: DataFrame, key: str = "region_id", order: str = "ord") -> DataFrame:
    """New rows with the order value of the stored row they replace as ``_target``, null for
    rows of unknown ids.

    Of equal new ids the first counts; of equal stored ids the last is the target. Only ids
    and order values of the stored table take part.
    """
    trimmed = new.withColumn(key, nonblank(key))
    fresh = first_wins(trimmed.where(F.col(key).isNotNull()), key, order)
    targets = (
        existing.select(nonblank(key).alias("_id"), order)
        .where(F.col("_id").isNotNull())
        .groupBy("_id")
        .agg(F.max(order).alias("_target"))
    )
    return fresh.join(targets, fresh[key] == targets["_id"], "left").drop("_id")


def after_stored(existing: DataFrame, additions: DataFrame, order: str = "ord") -> DataFrame:
    """Additions with order values behind those of the stored rows."""
    end = existing.agg((F.coalesce(F.max(order), F.lit(-1)) + 1).alias("end")).scalar()
    return additions.withColumn(order, F.col(order) + end)


def upsert(existing: DataFrame, new: DataFrame, key: str = "region_id", order: str = "ord") -> DataFrame:
    """Stored rows with changed ones replaced in place, plus rows of new ids.

    Rows without an id and earlier rows of a repeated id stay as they are. The join that
    rewrites rows runs on the order column, which is unique, so repeated ids cannot skew it.
    """
    return apply_marked(existing, mark_new(existing, new, key, order), order)


def apply_marked(existing: DataFrame, marked: DataFrame, order: str = "ord") -> DataFrame:
    produced = [c for c in marked.columns if c in existing.columns and c != order]
    changes = marked.where(F.col("_target").isNotNull()).select(
        "_target", *[F.col(c).alias(f"_new_{c}") for c in produced]
    )
    joined = existing.join(changes, existing[order] == changes["_target"], "left")
    changed = F.col("_target").isNotNull()
    kept = joined.select(
        *[
            F.when(changed, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in produced else F.col(c)
            for c in existing.columns
        ]
    )
    additions = marked.where(F.col("_target").isNull()).drop("_target")
    return kept.unionByName(after_stored(existing, additions, order), allowMissingColumns=True)


def upsert_table(
    spark: SparkSession,
    root: str,
    new: DataFrame,
    schema: StructType | str,
    key: str = "region_id",
    order: str = "ord",
    max_deltas: int = 16,
) -> dict[str, int]:
    """Upsert into a versioned table; returns how many rows were changed and added.

    The marked new rows are written to the scratch folder once, as counting and writing both need
    them. Changed and added rows are written as one change on top of the last version, so files of
    untouched rows stay as they are and readers see all of a change or none of it. After ``max_deltas``
    changes they are merged into a new version.
    """
    existing = read_table(spark, root, schema, order)
    marked = materialize(mark_new(existing, new, key, order))
    counts = marked.agg(
        F.count("_target").alias("changed"), (F.count(F.lit(1)) - F.count("_target")).alias("added")
    ).first()
    version = committed_version(spark, root)
    if version is None or len(committed_deltas(spark, root, version)) >= max_deltas:
        result = apply_marked(existing, marked, order)
        write_next_version(spark, result.select(*existing.columns), root)
    elif counts["changed"] or counts["added"]:
        targets = marked.where(F.col("_target").isNotNull()).select(F.col("_target").alias(order))
        touched = apply_marked(existing.join(targets, order, "left_semi"), marked.where(F.col("_target").isNotNull()), order)
        additions = after_stored(existing, marked.where(F.col("_target").isNull()).drop("_target"), order)
        empty = spark.createDataFrame([], schema)
        change = touched.select(*existing.columns).unionByName(
            empty.unionByName(additions, allowMissingColumns=True).select(*existing.columns)
        )
        write_delta(spark, change, root, version)
    return counts.asDict()


# ---- backfill ----


def backfill(rows: DataFrame, details: DataFrame, order: str | None = None) -> DataFrame:
    """Fill missing bodies from details (``Id``, ``Blocks``) and flag the outcome in
    ``fill_state``: 'kept', 'filled' or 'missing'.

    Of several details of one id that have a body the last in ``order`` counts (without an order
    the smallest body), so no row is multiplied. Rows that need nothing, or have no id to look
    up, bypass the join.
    """
    looked_up = F.when(body_missing(), article_id("region_id", "article_url"))
    marked = rows.withColumns({"_lookup": looked_up, "_missing": body_missing()})
    place = [] if order is None else [F.col(order).alias("_place")]
    found = details.select(F.col("Id").alias("_lookup"), nonempty(blocks_text("Blocks")).alias("_body"), *place)
    one = F.min("_body") if order is None else F.max_by("_body", "_place")
    bodies = found.where(F.col("_body").isNotNull()).groupBy("_lookup").agg(one.alias("_body"))
    filled = (
        marked.where(F.col("_lookup").isNotNull())
        .join(bodies, "_lookup", "left")
        .withColumn("article_text", F.coalesce("_body", "article_text"))
        .withColumn(
            "fill_state", F.when(F.col("_body").isNotNull(), F.lit("filled")).otherwise(F.lit("missing"))
        )
    )
    others = marked.where(F.col("_lookup").isNull()).withColumn(
        "fill_state", F.when(F.col("_missing"), F.lit("missing")).otherwise(F.lit("kept"))
    )
    columns = [*rows.columns, "fill_state"]
    return filled.select(*columns).unionByName(others.select(*columns))


def backfill_table(
    spark: SparkSession, root: str, details: DataFrame, schema: StructType | str, order: str = "ord", max_deltas: int = 16
) -> dict[str, int]:
    """Backfill a versioned table; returns the counts of filled rows and of rows that stay without body.

    Only filled rows are written, as one change on top of the last version; nothing is written when none was filled. More than
    ``max_deltas`` changes are merged into a new version.
    """
    seen = Observation("backfill")
    states = {s: F.count(F.when(F.col("fill_state") == s, 1)).alias(s) for s in ("filled", "missing")}
    result = backfill(read_table(spark, root, schema, order), details).observe(seen, *states.values())
    filled = materialize(result.where(~F.col("fill_state").isin("kept", "missing")).drop("fill_state"))
    counts = seen.get
    version = committed_version(spark, root)
    if counts["filled"] and version is not None:
        write_delta(spark, filled, root, version)
        if len(committed_deltas(spark, root, version)) > max_deltas:
            write_next_version(spark, read_table(spark, root, schema, order), root)
    return {"filled": counts["filled"], "missing": counts["missing"]}
