"""Keyword tables: any number of keywords looked for in all texts, without comparing each text with each keyword.

A short list is best matched by ``search.match_keywords``, one expression for each keyword. A table of thousands
would make that plan, or a join of all texts with all keywords, far too costly. A table that fits one Aho-Corasick automaton
goes to the workers, which read every text once. A larger one stays distributed: the distinct words of the texts meet the
keywords in a join, and the texts' words meet what was found.
"""

from __future__ import annotations

import uuid

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import as_col, let, strip
from ..session import discard, materialize

#: Characters of keywords (with a share for each keyword) in an automaton. What is collected, broadcast and held by a
#: worker is bounded by it; a larger table is matched by joins.
AUTOMATON_CHARS = 16 << 20
_SHARE = 16
_SPACE = r"\s+"
_HITS = "array<struct<place: bigint, keyword: string>>"
_WORD = regex.compile(r"[\p{Alphabetic}\p{M}\p{Nd}\p{Pc}\p{Join_Control}]")

# Automata of this Python worker, by the name of their keyword list.
_AUTOMATA: dict[str, ahocorasick.Automaton] = {}


def _automaton(name: str, keywords: list[tuple[int, str]]) -> ahocorasick.Automaton:
    found = _AUTOMATA.get(name)
    if found is None:
        found = ahocorasick.Automaton()
        for i, (_, keyword) in enumerate(keywords):
            found.add_word(keyword, (i, len(keyword)))
        found.make_automaton()
        while len(_AUTOMATA) >= 2:
            del _AUTOMATA[next(iter(_AUTOMATA))]
        _AUTOMATA[name] = found
    return found


def _found(automaton: ahocorasick.Automaton, text: str, whole_word: bool) -> list[int]:
    """Numbers of the keywords in a text, in order."""
    if not whole_word:
        return sorted({i for _, (i, _) in automaton.iter(text)})
    free = lambda at: not 0 <= at < len(text) or not _WORD.match(text[at])
    return sorted({i for end, (i, size) in automaton.iter(text) if free(end + 1) and free(end - size)})


def _hits(lowered: Column, keywords: list[tuple[int, str]], context, whole_word: bool) -> Column:
    """The (place, keyword) pairs of one automaton that stand in a lower-case text."""
    name, shared = uuid.uuid4().hex, context.broadcast(keywords)

    def find(texts: pa.Array) -> pa.Array:
        known = shared.value
        own = _automaton(name, known)
        rows = [[dict(zip(("place", "keyword"), known[i])) for i in _found(own, x.as_py() or "", whole_word)] for x in texts]
        return pa.array(rows, pa.list_(pa.struct([("place", pa.int64()), ("keyword", pa.string())])))

    return F.arrow_udf(find, _HITS)(lowered)


def clean_keywords(keywords: DataFrame, keyword: str = "keyword", order: str | None = None) -> DataFrame:
    """(place, keyword): keywords trimmed and in lower case, blank and null ones dropped, of equal ones the first in ``order``
    (bigint; without one all have place 0)."""
    place = F.lit(0) if order is None else F.col(order)
    rows = keywords.select(place.cast("bigint").alias("place"), strip(F.lower(keyword)).alias("keyword"))
    return rows.where("keyword <> ''").groupBy("keyword").agg(F.min("place").alias("place")).select("place", "keyword")


def match_keyword_table(
    df: DataFrame, text: str, keywords: DataFrame, *, keyword: str = "keyword", order: str | None = None, whole_word: bool = False
) -> DataFrame:
    """Rows whose text contains a keyword of a table, with the hits upper-cased in ``matched_keywords``.

    Keywords match as substrings of the lower-case text, or, with ``whole_word``, where no letter, digit or underscore stands
    beside them. Hits stand in the order of ``order`` (a bigint column of the table), those of one place by the keyword itself.
    Null texts, and an empty table of keywords, give no row.

    The keywords are read when this is called. Up to ``AUTOMATON_CHARS`` they are broadcast as one automaton, the texts are
    read once and not shuffled. Of a larger table nothing is collected or broadcast: see ``_hits_by_words``.
    """
    session = df.sparkSession
    table = materialize(clean_keywords(keywords, keyword, order))
    chars = table.agg(F.sum(F.length("keyword") + _SHARE)).first()[0] or 0
    if chars > AUTOMATON_CHARS:
        found = _hits_by_words(df, text, table, whole_word)
    else:
        listed = [tuple(r) for r in table.orderBy("place", "keyword").collect()]
        discard(table)
        hits = _hits(F.lower(as_col(text)), listed, session.sparkContext, whole_word) if listed else F.array().cast(_HITS)
        found = df.withColumn("_hits", hits).where(F.size("_hits") > 0)
    return found.select(*df.columns, F.transform("_hits", lambda x: F.upper(x["keyword"])).alias("matched_keywords"))


def _hits_by_words(df: DataFrame, text: str, table: DataFrame, whole_word: bool) -> DataFrame:
    """Rows with ``_hits``, the (place, keyword) pairs of a table of any size, by joins whose rows grow with the input.

    A keyword without white space can only stand inside a word (a run without white space). Every distinct word of the texts
    is cut into its pieces of the lengths that keywords have; the pieces that are keywords are found by a join, and so are the
    rows that hold the word. A keyword with white space is looked for by its longest part first, and then in the row's text.
    """
    parts = F.split("keyword", _SPACE)
    longest = F.array_max(F.transform(parts, lambda p: F.struct(F.length(p).alias("n"), p.alias("part"))))["part"]
    table = materialize(table.withColumns({"_part": longest, "_phrase": F.size(parts) > 1}))
    seen = table.agg(F.array_sort(F.collect_set(F.length("_part"))).alias("sizes"), F.bool_or("_phrase").alias("phrases")).first()
    sizes = F.lit(seen["sizes"])

    stored = materialize(df.withColumn("_row", F.monotonically_increasing_id()))
    cut = F.array_distinct(F.split(F.lower(as_col(text)), _SPACE))
    words = stored.select("_row", F.explode(cut).alias("_word")).where(F.length("_word") >= seen["sizes"][0])

    word = F.col("_word")
    fitting = F.filter(sizes, lambda n: n <= F.length(word))
    pieces = words.select("_word").distinct().select("_word", F.explode(fitting).alias("_n"))
    pieces = pieces.select("_word", "_n", F.explode(F.sequence(F.lit(1), F.length(word) - F.col("_n") + 1)).alias("_at"))
    pieces = pieces.select("_word", F.substring(word, F.col("_at"), F.col("_n")).alias("_part"), *_free_sides(word))
    met = pieces.join(table, "_part")
    if whole_word:
        met = met.where(F.col("_phrase") | F.col("_free"))
    met = met.select("_word", "place", "keyword", "_phrase").distinct()

    pairs = words.join(met, "_word").groupBy("_row").agg(F.collect_set(F.struct("place", "keyword", "_phrase")).alias("_hits"))
    found = stored.join(pairs, "_row")
    if seen["phrases"]:
        lowered = F.lower(as_col(text))
        found = found.withColumn("_hits", let(lowered, lambda x: F.filter("_hits", lambda h: ~h["_phrase"] | _stands(x, h["keyword"], whole_word))))
        found = found.where(F.size("_hits") > 0)
    return found.withColumn("_hits", F.array_sort("_hits"))


def _free_sides(word: Column) -> list[Column]:
    """``_free``: whether no letter, digit or underscore stands beside the piece of ``_n`` characters from ``_at`` on."""
    before = F.when(F.col("_at") > 1, F.substring(word, F.col("_at") - 1, F.lit(1))).otherwise(F.lit(""))
    after = F.substring(word, F.col("_at") + F.col("_n"), F.lit(1))
    return [(~before.rlike(r"(?U)\w") & ~after.rlike(r"(?U)\w")).alias("_free")]


def _stands(lowered: Column, keyword: Column, whole_word: bool) -> Column:
    if not whole_word:
        return F.contains(lowered, keyword)
    quoted = F.concat(F.lit(r"\Q"), F.replace(keyword, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
    return F.rlike(lowered, F.concat(F.lit(r"(?U)(?<!\w)"), quoted, F.lit(r"(?!\w)")))
