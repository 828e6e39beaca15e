"""Repeated text searches over a stored index of trigrams.

A search for a substring has to read every text. Where many searches run over one table, an index pays: a table of all
pieces of three characters with the rows they stand in. A search reads the few postings of its own pieces, keeps the rows
that have all of them, and looks only into the texts of those rows to confirm the hit.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import or_empty
from .search import search_articles

#: Row numbers lie in blocks of 2^16, and a posting list covers one block, so that no list grows with the table.
BLOCK_BITS = 16
#: Pieces of one needle that are looked up; a longer needle is confirmed on the text, as all are.
PIECES = 63


def trigrams(text: Column) -> Column:
    """Distinct pieces of three characters of the lower-case text; none of null and of shorter texts."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("(?s)(?=(...))"), 1))


def postings(df: DataFrame, columns: Sequence[str], order: str = "ord") -> DataFrame:
    """(gram, block, rows): for each piece the rows it stands in, as sorted offsets in blocks of the bigint ``order``.

    Rows with a null ``order`` are left out. The pieces of a row are made distinct before they are shuffled, and a list
    holds 2^16 offsets at most, also for a piece that every text has.
    """
    pieces = F.array_distinct(F.concat(*[F.coalesce(trigrams(F.col(c)), F.array().cast("array<string>")) for c in columns]))
    number = F.col(order).cast("bigint")
    block, at = F.shiftright(number, BLOCK_BITS), F.pmod(number, F.lit(1 << BLOCK_BITS)).cast("int")
    rows = df.where(number.isNotNull()).select(block.alias("block"), at.alias("at"), F.explode(pieces).alias("gram"))
    lists = rows.groupBy("gram", "block").agg(F.array_sort(F.collect_set("at")).alias("rows"))
    return lists.select("gram", "block", "rows")


def write_index(df: DataFrame, folder: str, columns: Sequence[str], order: str = "ord", append: bool = False) -> None:
    """Store the index of some text columns; with ``append``, add new rows to it.

    ``order`` tells rows apart. Files are sorted by piece, so that a search skips the row groups of other pieces.
    """
    lists = postings(df, columns, order).sortWithinPartitions("gram", "block")
    lists.write.mode("append" if append else "errorifexists").parquet(folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("gram string, block bigint, rows array<int>").parquet(folder)


def needle_pieces(spark: SparkSession, needles: Sequence[str]) -> dict[str, list[str]]:
    """The pieces of each needle, cut as those of the texts are."""
    frame = spark.createDataFrame([(n,) for n in dict.fromkeys(needles)], "needle string")
    return {r.needle: r.pieces[:PIECES] for r in frame.select("needle", trigrams(F.col("needle")).alias("pieces")).collect()}


def candidates(index: DataFrame, pieces: dict[str, list[str]], order: str = "ord") -> DataFrame:
    """(needle, ``order``): rows that have all pieces of a needle.

    Each piece of a needle sets a bit of the row, so the rows are put together by a plain aggregate with map-side
    combining, and postings that stand twice count once.
    """
    wanted: dict[str, list[tuple[str, int, int]]] = {}
    for needle, own in pieces.items():
        for i, gram in enumerate(own):
            wanted.setdefault(gram, []).append((needle, 1 << i, (1 << len(own)) - 1))
    spark = index.sparkSession
    listed = [(gram, *use) for gram, uses in wanted.items() for use in uses]
    uses = spark.createDataFrame(listed, "gram string, needle string, bit bigint, whole bigint")
    found = index.where(F.col("gram").isin(list(wanted))).join(uses, "gram")
    rows = found.select("needle", "whole", "bit", "block", F.explode("rows").alias("at"))
    row = (F.shiftleft("block", BLOCK_BITS) + F.col("at")).alias(order)
    have = rows.groupBy("needle", "whole", row).agg(F.bit_or("bit").alias("have"))
    return have.where(F.col("have") == F.col("whole")).select("needle", order)


def _contains(columns: Sequence[str], needle: Column) -> Column:
    return reduce(or_, [F.contains(F.lower(or_empty(c)), F.lower(needle)) for c in columns])


def find_texts(df: DataFrame, index: DataFrame, needles: Sequence[str], columns: Sequence[str], order: str = "ord") -> DataFrame:
    """Rows of ``df`` with each needle that one of the columns contains, in any case, as a first column ``needle``.

    The result is that of a scan: every candidate is confirmed on its whole texts. Needles of fewer than three characters
    have no piece and take a scan. Rows with a null ``order`` are not in the index and are found by no needle; blank
    needles are as good as any, an empty one stands in every row.
    """
    known = df.where(F.col(order).isNotNull())
    pieces = needle_pieces(df.sparkSession, needles)
    long = {n: p for n, p in pieces.items() if p}
    short = [n for n, p in pieces.items() if not p]
    out = []
    if long:
        rows = known.join(candidates(index, long, order), order)
        out.append(rows.where(_contains(columns, F.col("needle"))).select("needle", *df.columns))
    if short:
        hits = F.array_compact(F.array(*[F.when(_contains(columns, F.lit(n)), F.lit(n)) for n in short]))
        out.append(known.select(F.explode(hits).alias("needle"), *df.columns))
    return reduce(DataFrame.unionByName, out) if out else known.select(F.lit("").alias("needle"), "*").where(F.lit(False))


def search_indexed(articles: DataFrame, index: DataFrame, *, text: str, order: str = "ord", **criteria) -> DataFrame:
    """``search_articles`` over the rows that an index of title and article_text proposes: same criteria, same rows.

    A ``text`` of fewer than three characters takes the scan.
    """
    pieces = needle_pieces(articles.sparkSession, [text])
    if pieces[text]:
        articles = articles.join(candidates(index, pieces, order).select(order), order, "left_semi")
    return search_articles(articles, text=text, order=order, **criteria)
