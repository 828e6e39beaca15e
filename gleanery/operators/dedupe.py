"""Row de-duplication with an explicit order.

The rank filter lets Spark cut each key to its winner inside every map task, before the
shuffle (WindowGroupLimit), so a key that holds a third of all rows costs no more than any
other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import or_empty

Order = str | Sequence[str]


def _names(value: str | Sequence[str]) -> list[str]:
    return [value] if isinstance(value, str) else list(value)


def first_n(df: DataFrame, keys: str | Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each key."""
    rank = F.row_number().over(Window.partitionBy(*_names(keys)).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def first_wins(df: DataFrame, keys: str | Sequence[str], order: Order) -> DataFrame:
    """The first row of each key in the given order, nulls of the order last. Null counts as a key."""
    return first_n(df, keys, [F.col(c).asc_nulls_last() for c in _names(order)], 1)


def last_wins(df: DataFrame, keys: str | Sequence[str], order: Order) -> DataFrame:
    """The last row of each key in the given order."""
    return first_n(df, keys, [F.col(c).desc() for c in _names(order)], 1)


def dedupe_jobs(jobs: DataFrame, order: Order = "ord") -> DataFrame:
    """First job of equal link, title, company and location, letter case ignored."""
    parts = [F.lower(or_empty(c)) for c in ("url", "title", "company", "location")]
    # A digest stands for the texts in the shuffle; lengths keep the parts apart.
    digest = F.sha2(F.concat_ws("|", *[F.length(p).cast("string") for p in parts], *parts), 256)
    return first_wins(jobs.withColumn("_digest", digest), "_digest", order).drop("_digest")


def dedupe_text(df: DataFrame, text: str, order: Order) -> DataFrame:
    """First row of each normalized text. A digest stands for the text in the shuffle."""
    normal = F.btrim(F.regexp_replace(F.lower(or_empty(text)), r"(?U)[\s\x1c-\x1f]+", " "))
    keyed = df.withColumn("_digest", F.sha2(normal, 256))
    return first_wins(keyed, "_digest", order).drop("_digest")
