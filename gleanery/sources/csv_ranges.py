"""CSV files with quoted line breaks, read by many tasks.

Whether a line break ends a record depends on how many quotes stand before it in the file. Spark splits the file
into ranges of lines; each range reports the parity of its quotes and where records may begin under either state, the parities are
added up range by range, and then each range cuts its own lines into records. Only a record that
crosses ranges is put together from their pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .. import fixed_values as fv
from ..session import discard, materialize
from .tables_csv import parse_csv_tolerant

_PIECES = "file string, range long, place long, kind int, value string"
# Kinds of pieces: a whole record, the end of one that began in an earlier range, the begin of one that goes on, a range that lies
# within one record.
_WHOLE, _END, _BEGIN, _WITHIN = 0, 1, 2, 3


_RANGE_BYTES = "spark.sql.files.maxPartitionBytes"


def _lines(spark: SparkSession, path: str | list[str], range_bytes: int | None) -> DataFrame:
    """(file, range, at, value), stored: the lines of the files, without their line feeds, and the byte at which their range begins."""
    text = spark.read.option("lineSep", "\n").text(path)
    meta = F.col("_metadata")
    lines = text.select(
        meta["file_path"].alias("file"), meta["file_block_start"].alias("range"), F.monotonically_increasing_id().alias("at"), "value"
    )
    before = spark.conf.get(_RANGE_BYTES)
    spark.conf.set(_RANGE_BYTES, before if range_bytes is None else str(range_bytes))
    try:
        # Stored, as another read of the files might cut them into other ranges.
        return materialize(lines)
    finally:
        spark.conf.set(_RANGE_BYTES, before)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of each range as records and pieces of records; ``odd`` tells whether a quote is open before the range."""
    key, open_, held, place, began = None, False, [], 0, False
    rows: list[tuple] = []

    def close() -> None:
        """The lines left over at the end of a range."""
        if key is not None and held:
            rows.append((*key, place, _BEGIN if began else _WITHIN, "\n".join(held)))

    for batch in batches:
        odd_lines = pc.equal(pc.bit_wise_and(pc.count_substring(batch.column("value"), '"'), 1), 1)
        columns = (batch.column("file"), batch.column("range"), batch.column("odd"), batch.column("value"), odd_lines)
        for file, start, odd, line, turns in zip(*(c.to_pylist() for c in columns)):
            if (file, start) != key:
                close()
                # Lines up to the end of a record that began in an earlier range are that record's end.
                key, open_, held, place, began = (file, start), odd, [], 0, not odd
            held.append(line)
            open_ ^= turns
            if not open_:
                rows.append((*key, place, _WHOLE if began else _END, "\n".join(held)))
                held, began, place = [], True, place + 1
        yield _batch(rows)
        rows = []
    close()
    yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string())
    columns = zip(*rows) if rows else ((),) * 5
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["file", "range", "place", "kind", "value"])


def csv_records(
    spark: SparkSession, path: str | list[str], header: bool = True, range_bytes: int | None = None
) -> DataFrame:
    """The records of CSV files as texts: file, range, place (their order within a file is by range, then place), value.

    Quotes stand around whole fields and are doubled inside them; line breaks between quotes belong to the record. A quote
    that is never closed takes in the rest of its file. Empty lines are no records; with ``header`` the first record of
    each file is left out. A carriage return before a line feed belongs to the line break.

    The lines of a range (``range_bytes`` at most, or what the session reads at once) are handled in order by one task; the
    table of ranges has a row for each.
    """
    lines = _lines(spark, path, range_bytes)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    parity = lines.groupBy("file", "range").agg(F.sum(quotes.cast("long")).alias("quotes"))
    before = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    odd = (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("odd")
    states = parity.select("file", "range", odd)
    ordered = lines.join(states, ["file", "range"]).repartition("file", "range").sortWithinPartitions("file", "range", "at")
    pieces = materialize(ordered.select("file", "range", "odd", "value").mapInArrow(_cut, _PIECES))
    discard(lines)
    whole = pieces.where(F.col("kind") == _WHOLE)
    # The pieces of a record belong to the last range in which one began.
    parts = pieces.where(F.col("kind") != _WHOLE)
    begun = Window.partitionBy("file").orderBy("range", "place")
    owner = F.last(F.when(F.col("kind") == _BEGIN, F.struct("range", "place")), ignorenulls=True).over(begun)
    joined = parts.withColumn("owner", owner).groupBy("file", "owner")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("range", "place", "value"))), lambda x: x["value"]), "\n")
    joined = joined.agg(text.alias("value")).select("file", "owner.range", "owner.place", "value")
    records = whole.select("file", "range", "place", "value").unionByName(joined)
    if header:
        records = records.where("range > 0 or place > 0")
    value = F.regexp_replace("value", "\r$", "")
    return records.withColumn("value", value).where("value <> ''")


def read_csv_ranges(
    spark: SparkSession, path: str | list[str], columns: list[str], max_chars: int = fv.MAX_FIELD_CHARS, header: bool = True,
    range_bytes: int | None = None,
) -> DataFrame:
    """Text columns of CSV files whose fields may span lines, a file of any size read by many tasks, with the ``bad_row`` flag
    for rows with a wrong number of fields or a field over the size limit; a missing field is ''.

    As ``tables_csv.read_csv_tolerant``, which reads such a file in one task; a line break that follows a carriage return within
    quotes keeps it.
    """
    records = csv_records(spark, path, header, range_bytes).select("value")
    return parse_csv_tolerant(records, columns, max_chars=max_chars)
