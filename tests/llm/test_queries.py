"""The corpus queries against their DuckDB twins, and the pipeline stage by stage."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
import corpus_pipeline
from gleanery.llm import queries
from tests.oracle import compare, make_duckdb

from .helpers import documents

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_twin(spark, name):
    problem, rows = compare(spark, make_duckdb(SF), queries.QUERIES[name], queries.SQL[name], SF)
    assert problem == "" and rows > 0


def test_all_are_registered():
    names = set(registered.queries())
    assert {f"op{n}" for n in range(1, 11)} <= {x.split("_")[0] for x in names} and "pipeline" in names


def test_stages_return_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == corpus_pipeline.COLUMNS
        assert docs.where("n_chars <> length(text)").count() == 0
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_stages_on_odd_and_empty_tables(spark):
    rows = [(1, None), (2, ""), (3, "one two three four five six " * 20), (3, "one two three four five six " * 20), (None, "x"), (4, "y " * 60_000)]
    odd = documents(spark, rows).withColumn("TEXT2", F.lit(1))
    for docs in (odd, odd.limit(0)):
        found = docs
        for _, stage in corpus_pipeline.STAGES:
            found = stage(spark, found, SF)
        kept = {r.doc_id for r in found.collect()}
        assert kept == ({1, 2, 3, 4, None} if docs is odd else set())


def test_near_copies_leave_one(spark):
    base = [f"word{i}" for i in range(120)]
    copies = [(i, " ".join(base[:i] + ["other"] + base[i + 1 :])) for i in range(1, 6)]
    rows = [*copies, (9, "quite another text of its own"), (10, copies[0][1])]
    kept = corpus_pipeline.drop_near_copies(spark, documents(spark, rows), SF).collect()
    assert sorted(r.doc_id for r in kept) == [1, 9]


def test_repeated_passages_go(spark):
    passage = " ".join(f"päss{i}" for i in range(60))
    rows = [(i, f"beginning {i * 7919} {passage} end {i * 104729}") for i in range(4)] + [(9, "own text " + "abc " * 10)]
    found = {r.doc_id: r.text for r in corpus_pipeline.drop_repeated_passages(spark, documents(spark, rows), SF).collect()}
    assert all("päss30" not in found[i] and str(i * 7919) in found[i] for i in range(4))
    assert found[9] == rows[-1][1]


def test_no_text_of_a_shared_doc_id_is_lost(spark):
    a, b, c = ("".join(f"{x}{i} " for i in range(40)) for x in "abc")
    rows = [(1, a), (1, b), (2, c), (3, b), (1, a), (4, ""), (4, ""), (4, " ")]
    kept = corpus_pipeline.drop_near_copies(spark, documents(spark, rows), SF).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(1, a), (1, b), (2, c), (4, ""), (4, " ")]
