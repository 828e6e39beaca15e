"""Job items and search terms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .. import fixed_values as fv
from ..functions.text import nonblank, strip
from ..operators.dedupe import first_wins

_ITEM_FIELDS = [
    "title",
    "companyName",
    "company",
    "location",
    "companyLocation",
    "publishedAt",
    "listedAt",
    "jobUrl",
    "url",
    "link",
    "description",
    "jobDescription",
    "jobDescriptionText",
    "companyId",
    "workType",
    "contractType",
    "experienceLevel",
]
JOB_ITEM_TYPE = StructType(
    [StructField("search_query", StringType())]
    + [StructField(n, StringType()) for n in _ITEM_FIELDS]
    + [StructField("ord", LongType())]
)


def read_jobs(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Job items from JSON lines, with every alternative field name in the schema. Many paths
    (one per search term, say) are read as one."""
    return spark.read.schema(JOB_ITEM_TYPE).json(path)


def parse_jobs(docs: DataFrame, raw: str = "raw") -> DataFrame:
    """Job items from a column of JSON texts; other columns are kept."""
    kept = [c for c in docs.columns if c != raw]
    return docs.select(*kept, F.from_json(raw, JOB_ITEM_TYPE).alias("j")).select(
        *kept, *[F.col(f"j.{f.name}") for f in JOB_ITEM_TYPE.fields if f.name not in kept]
    )


def tag_query(items: DataFrame, query: str | Column) -> DataFrame:
    """Mark items with the search term that found them."""
    return items.withColumn("search_query", query if isinstance(query, Column) else F.lit(query))


def clean_terms(lines: DataFrame, text: str = "value", order: str = "ord", keys: tuple[str, ...] = ()) -> DataFrame:
    """Search terms from lines: trimmed, comments and blanks dropped, the first of equal ones
    (by lower case) kept, within ``keys``."""
    terms = lines.select(*keys, F.col(order).alias("ord"), strip(text).alias("term")).where(
        (F.col("term") != "") & ~F.col("term").startswith("#")
    )
    keyed = terms.withColumn("term_key", F.lower("term"))
    return first_wins(keyed, [*keys, "term_key"], "ord").drop("term_key")


def read_terms(spark: SparkSession, path: str, default: str = fv.DEFAULT_TITLE_QUERY) -> DataFrame:
    """Terms of a text file, or the default term when it has none."""
    text = spark.read.text(path, wholetext=True)
    lines = text.select(F.posexplode(F.split("value", r"\r\n|\r|\n", -1)).alias("ord", "value"))
    terms = clean_terms(lines)
    fallback = spark.range(1).select(F.lit(0).alias("ord"), F.lit(default).alias("term"))
    return terms.unionByName(fallback.where(~terms.exists()))


def quoted_phrases(expression: str | Column) -> Column:
    """Lower-case quoted phrases of a boolean expression; the whole text when none is
    quoted."""
    text = F.lit(expression) if isinstance(expression, str) else expression
    quoted = F.transform(
        F.regexp_extract_all(text, F.lit('"([^"]+)"'), F.lit(1)), lambda p: F.lower(strip(p))
    )
    whole = F.lower(nonblank(text))
    return F.when(F.size(quoted) > 0, quoted).otherwise(F.array_compact(F.array(whole)))
