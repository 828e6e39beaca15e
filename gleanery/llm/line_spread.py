"""Line dedup by distinct-site spread.

A line that stands on many sites is page furniture. The sites of a line are counted by HyperLogLog
sketches that merge in the aggregation; only where the estimate is too near the threshold to decide
are the sites counted exactly, so the outcome equals that of exact counting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import materialize, pick, row_key

#: Sketches of 2^12 registers: standard error about 1.6 %.
LOG_REGISTERS = 12
#: Estimates within this share of the threshold are settled by exact counts (over five standard errors).
BAND = 0.1


def normal_line(line: Column) -> Column:
    """The form in which lines are compared: trimmed, white space collapsed, lower case."""
    return F.lower(F.trim(F.regexp_replace(line, r"\s+", " ")))


def _hashed(docs: DataFrame) -> DataFrame:
    """A row (row, site, c, d, at, a, b) for each line that is not blank; a and b are a 128-bit hash of the line,
    c and d one of the text in its normal form."""
    # Hashes of whole texts are taken before the lines are laid out, once for each text.
    texts = docs.select(
        row_key("doc_id", "site", "text").alias("row"),
        "site",
        F.xxhash64(normal_line(F.col("text"))).alias("c"),
        F.xxhash64(F.lit("second"), normal_line(F.col("text"))).alias("d"),
        F.split(F.coalesce("text", F.lit("")), "\n").alias("lines"),
    )
    lines = texts.select("row", "site", "c", "d", F.posexplode("lines").alias("at", "line"))
    lines = lines.withColumn("line", normal_line(F.col("line")))
    return lines.where("line <> ''").select(
        "row", "site", "c", "d", "at", F.xxhash64("line").alias("a"), F.xxhash64(F.lit("second"), "line").alias("b")
    )


def widespread(pairs: DataFrame, min_sites: int) -> DataFrame:
    """Line hashes (a, b) that stand on at least ``min_sites`` sites.

    ``pairs`` has one row (a, b, site) for each line and site.
    """
    sketches = pairs.groupBy("a", "b").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", LOG_REGISTERS)).alias("estimate")
    )
    sketches = materialize(sketches.where(F.col("estimate") >= min_sites * (1 - BAND)))
    sure = F.col("estimate") > min_sites * (1 + BAND)
    near = pairs.join(sketches.where(~sure).select("a", "b"), ["a", "b"], "left_semi")
    exact = near.groupBy("a", "b").agg(F.count("*").alias("sites")).where(F.col("sites") >= min_sites)
    return sketches.where(sure).select("a", "b").unionByName(exact.select("a", "b"))


def drop_widespread_lines(
    docs: DataFrame, min_sites: int = 10, site: str = "source", keep: tuple[str, ...] = ()
) -> DataFrame:
    """``docs`` with lines that stand on ``min_sites`` or more sites taken out of ``text``.

    Result: doc_id, text (kept lines joined by newlines), the ``keep`` columns, n_lines, n_removed, for each row of ``docs``.
    Lines are compared in their normal form; blank lines are never removed and belong to no count of
    removed lines. Copies of a text do not spread its lines: texts that are equal in the normal form count
    with one site, the smallest. Widespread lines go from every document, copies included.

    Texts that are nearly equal count as different ones, so a text that stands on ``min_sites`` sites in
    versions of its own loses the lines that the versions share.

    Defined cases: a null text has no line and stays null; an empty text has one blank line; a null
    site is no site; rows that repeat come back as often as they went in; an empty table gives an
    empty result; other columns, also with clashing names, play no part.

    At scale: the first aggregation has a row per line and text, the second leaves a row per line and site in
    the map tasks, so a line that a third of all rows carry costs a row per task and site there. The join of
    lines with the widespread ones has one row per line on its right side; Spark splits its large partitions.
    """
    docs = pick(docs, "doc_id", "text", *keep, site=site)
    hashed = _hashed(docs)
    sited = hashed.where("site is not null").groupBy("a", "b", "c", "d").agg(F.min("site").alias("site"))
    pairs = materialize(sited.select("a", "b", "site").distinct())
    bad = widespread(pairs, min_sites).withColumn("bad", F.lit(True))
    flags = hashed.join(bad, ["a", "b"]).groupBy("row").agg(
        F.array_sort(F.collect_set("at")).alias("places")
    )
    joined = docs.withColumn("row", row_key("doc_id", "site", "text")).join(flags, "row", "left")
    lines = F.split("text", "\n")
    marked = joined.withColumn("lines", lines).withColumn(
        "drop",
        F.when(F.col("places").isNotNull(), _flags(F.size("lines"), F.col("places"))),
    )
    kept = F.expr("transform(filter(arrays_zip(lines, drop), x -> not x.drop), x -> x.lines)")
    marked = marked.withColumn("kept", F.when(F.col("drop").isNull(), F.col("lines")).otherwise(kept))
    text = F.array_join("kept", "\n")
    marked = marked.withColumn("cut", F.coalesce(text, F.lit("")))
    return marked.select(
        "doc_id",
        F.when(F.col("drop").isNull(), F.col("text")).otherwise(F.col("cut")).alias("text"),
        *keep,
        F.greatest(F.coalesce(F.size("lines"), F.lit(0)), F.lit(0)).cast("long").alias("n_lines"),
        F.when(F.col("drop").isNull(), F.lit(0)).otherwise(F.size("lines") - F.size("kept")).cast("long").alias("n_removed"),
    )


def _flags(size: Column, places: Column) -> Column:
    """An array of ``size`` booleans, true at ``places`` (sorted, distinct), in linear time.

    Between two places lies a run of false: the runs are joined with the places.
    """
    before = F.concat(F.array(F.lit(-1)), places)
    after = F.concat(places, F.array(size))
    runs = F.zip_with(
        before,
        after,
        lambda x, y: F.concat(
            F.when(x >= 0, F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>")),
            F.array_repeat(F.lit(False), (y - x - 1).cast("int")),
        ),
    )
    return F.flatten(runs)


def line_spread_report(docs: DataFrame, min_sites: int = 10, site: str = "source") -> DataFrame:
    """doc_id, n_lines, n_removed, kept_sha256: the digest form of :func:`drop_widespread_lines`."""
    out = drop_widespread_lines(docs, min_sites, site)
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
