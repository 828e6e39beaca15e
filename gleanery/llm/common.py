"""What the corpus operators share: column choice, row keys, stored intermediate tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gleanery.session import discard, materialize, scratch_dir

__all__ = ["discard", "gathered", "materialize", "parts", "pick", "row_key", "scratch_dir", "small_batches"]


def pick(df: DataFrame, *names: str, **renamed: str) -> DataFrame:
    """Columns by exact name, whatever else the table holds.

    Columns whose names differ only in case, or that stand twice, do not make the choice ambiguous:
    the first column of exactly that name is taken. ``renamed`` maps new names to old ones.
    """
    wanted = {n: n for n in names} | renamed
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"c{df.columns.index(old)}").alias(new) for new, old in wanted.items()])


def row_key(*columns: str | Column) -> Column:
    """A text that tells rows apart by the given columns; null differs from every value."""
    parts = []
    for c in columns:
        c = (F.col(c) if isinstance(c, str) else c).cast("string")
        parts += [F.when(c.isNull(), F.lit("n")).otherwise(F.concat(F.length(c).cast("string"), F.lit(":"))), c]
    return F.md5(F.concat_ws("", *parts))


def parts(batch: pa.RecordBatch, text: str, size: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``size`` bytes of a text column, at least one row each."""
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero(np.diff(np.cumsum(lengths, dtype=np.int64) // size)) + 1 if batch.num_rows else np.empty(0, int)
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
        if b > a:
            yield batch.slice(a, b - a)
    pa.default_memory_pool().release_unused()


def gathered(batches: Iterator[pa.RecordBatch], text: str, size: int) -> Iterator[pa.RecordBatch]:
    """Batches of about ``size`` bytes of a text column, put together from smaller ones or cut from larger ones."""
    held, total = [], 0
    for batch in batches:
        for part in parts(batch, text, size):
            held.append(part)
            total += pc.sum(pc.binary_length(part.column(text))).as_py() or 0
            if total >= size:
                yield pa.concat_batches(held)
                held, total = [], 0
    if held:
        yield pa.concat_batches(held)


def small_batches(spark: SparkSession) -> SparkSession:
    """Send at most this many rows at once to Python: rows with whole texts are wide, and workers are reused."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark

