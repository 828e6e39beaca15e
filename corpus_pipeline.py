"""The corpus pipeline: five stages over documents, each on what its predecessor kept.

Each stage takes (spark, docs, sf_dir) and returns a table that is written as Parquet and read again as the next one's
docs. All but the last return the columns of documents (doc_id, text, lang, source, n_chars); the last returns the
pieces of packed sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from gleanery.llm import line_spread, minhash, packing, repeats, toxicity
from gleanery.llm.common import discard, materialize, pick, small_batches

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Bytes of a repeated passage that is removed; fifty words of the corpus' languages have more.
PASSAGE_BYTES = 240


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on all labelled ones, does not call toxic."""
    docs = pick(docs, *COLUMNS)
    model = toxicity.fit(docs, small_batches(spark).read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_clean(docs, model)


def drop_widespread_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand on many sources; n_chars is counted again."""
    small_batches(spark)
    out = line_spread.drop_widespread_lines(docs, keep=("lang", "source"))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, the one of the smallest doc_id.

    A doc_id that stands on different texts keeps one row of each of them that is kept; of rows that repeat doc_id and text,
    one stays. Documents without words and rows without doc_id are in no class and stay.
    """
    small_batches(spark)
    docs = pick(docs, *COLUMNS).withColumns(dict(zip(("t1", "t2"), minhash.text_hash("text"))))
    row = ["doc_id", "t1", "t2"]
    found = materialize(minhash.near_duplicate_rows(docs, width=5, per_cent=80).where("doc_id is not null"))
    # Texts of one doc_id with the same shingles are copies of one another.
    one = found.where("kept and n_shingles > 0").groupBy("doc_id", "d1", "d2")
    chosen = one.agg(F.min(F.struct("t1", "t2")).alias("t"), F.count("*").alias("rows")).select("doc_id", "t.*", "rows")
    without_words = found.where("n_shingles = 0").groupBy(*row).agg(F.count("*").alias("rows"))
    named = docs.join(chosen.unionByName(without_words), row)
    # Almost every doc_id stands once; only the others need a choice among their rows.
    repeated = named.where("rows > 1").dropDuplicates(row)
    kept = named.where("rows = 1").unionByName(repeated).select(*COLUMNS)
    return kept.unionByName(docs.where("doc_id is null").select(*COLUMNS))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that stand more than once in the corpus; n_chars is counted again."""
    small_batches(spark)
    out = repeats.remove_repeats(docs, PASSAGE_BYTES, keep=("lang", "source"), whole_characters=True)
    text = F.col("kept").cast("string")
    return out.select("doc_id", text.alias("text"), "lang", "source", F.length(text).cast("long").alias("n_chars"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens: a row for each piece of a document and its place."""
    small_batches(spark)
    return packing.best_fit_packing(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_widespread_lines),
    ("near_dedup", drop_near_copies),
    ("passage_dedup", drop_repeated_passages),
    ("packing", pack),
]

#: The stages train, hash and tokenize: SQL cannot express them. The tests compare the operators, not the stages, with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; each result is written to the shared scratch folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        before, docs = docs, materialize(stage(spark, docs, sf_dir))
        if i:
            discard(before)
    return docs
