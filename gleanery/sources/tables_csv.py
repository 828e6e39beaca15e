"""CSV at rest: with quoted newlines, and tolerant of malformed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import fixed_values as fv

CORRUPT = "_corrupt_record"
_CSV = {"escape": '"', "maxCharsPerColumn": "-1"}


def _text_schema(columns: list[str], corrupt: bool = False) -> StructType:
    names = [*columns, CORRUPT] if corrupt else columns
    return StructType([StructField(c, StringType()) for c in names])


def read_csv(
    spark: SparkSession, path: str | list[str], columns: list[str] | None = None, multi_line: bool = True
) -> DataFrame:
    """Text columns of CSV files with a header; quotes are doubled inside quoted fields, which
    may span lines; a missing field is ''.

    A file whose fields may span lines is read by one task; without ``multi_line`` it is split.
    """
    reader = spark.read.options(header="true", multiLine=str(multi_line).lower(), **_CSV)
    if columns:
        reader = reader.schema(_text_schema(columns))
    return reader.csv(path).fillna("")


def _is_bad(columns: list[str], max_chars: int):
    too_long = None
    for c in columns:
        test = F.length(F.col(c)) > max_chars
        too_long = test if too_long is None else too_long | test
    return F.col(CORRUPT).isNotNull() | F.coalesce(too_long, F.lit(False))


def read_csv_tolerant(
    spark: SparkSession, path: str, columns: list[str], max_chars: int = fv.MAX_FIELD_CHARS, multi_line: bool = True, header: bool = True,
    limited: list[str] | None = None,
) -> DataFrame:
    """Like ``read_csv``, with a ``bad_row`` flag for rows with a wrong number of fields or a
    field over the size limit, which holds for all columns or only for the ``limited`` ones."""
    rows = spark.read.options(
        header=str(header).lower(), mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, multiLine=str(multi_line).lower(), **_CSV
    ).schema(_text_schema(columns, corrupt=True)).csv(path)
    return _flagged(rows, columns, max_chars, limited)


def parse_csv_tolerant(
    lines: DataFrame, columns: list[str], raw: str = "value", max_chars: int = fv.MAX_FIELD_CHARS
) -> DataFrame:
    """The same for a column of CSV records; other columns are kept."""
    kept = [c for c in lines.columns if c != raw]
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "escape": '"', "multiLine": "true"}
    ddl = ", ".join(f"`{c}` string" for c in [*columns, CORRUPT])
    rows = lines.select(*kept, F.from_csv(F.col(raw), F.lit(ddl), options).alias("r"))
    return _flagged(rows.select(*kept, "r.*"), columns, max_chars)


def _flagged(rows: DataFrame, columns: list[str], max_chars: int, limited: list[str] | None = None) -> DataFrame:
    flagged = rows.withColumn("bad_row", _is_bad(columns if limited is None else limited, max_chars)).drop(CORRUPT)
    return flagged.fillna("", subset=columns)


def good_rows(rows: DataFrame) -> DataFrame:
    return rows.where(~F.col("bad_row")).drop("bad_row")


def bad_rows(rows: DataFrame) -> DataFrame:
    return rows.where("bad_row").drop("bad_row")
