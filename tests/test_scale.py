"""Plans that must hold at scale, and hot keys."""

import io
from collections import Counter
from contextlib import redirect_stdout

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
from gleanery.functions.skills import tagged_lines
from gleanery.operators import dedupe, joins, limits, tables
from gleanery.session import materialize, scratch_dir
from registry.base import job_docs

SF = "/root/testdata/sf0.001"


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_dedupe_is_cut_before_the_shuffle(spark):
    text = plan(dedupe.first_wins(spark.range(100).withColumn("k", F.col("id") % 3), "k", "id"))
    assert text.count("WindowGroupLimit") >= 2


def test_scans_read_only_needed_columns(spark):
    text = plan(registered.queries()["d4_first_per_key"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:" in text
    assert "l_comment" not in text and "l_extendedprice" not in text


def test_filters_reach_the_scan(spark):
    text = plan(registered.queries()["l5_stop_at_empty_page"](spark, SF))
    assert "EqualTo(event_type,purchase)" in text


@pytest.mark.parametrize("name", sorted(registered.registry.QUERIES))
def test_no_cartesian_or_nested_loop(spark, name):
    if name.startswith(("t1", "t2", "t3", "flow_blog", "flow_posts", "flow_press_run", "flow_jobs_external", "k1_csv_files", "k2", "l1", "m2_versioned", "m3_backfill_table", "s8_csv_files", "s9_default", "s10_stored")):
        pytest.skip("runs jobs while it is built; covered elsewhere")
    text = plan(registered.registry.QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize(
    "name",
    ["x2_description_sections", "x7_local_insight", "p8_keyword_hits", "m2_upsert", "p3_flow_press_rows", "flow_jobs_heuristic"],
)
def test_text_work_stays_in_the_jvm(spark, name):
    text = plan(registered.registry.QUERIES[name](spark, SF))
    assert not any(step in text for step in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas"))


def test_costly_expression_is_computed_once(spark):
    text = plan(registered.queries()["p8_keyword_hits"](spark, SF))
    assert text.count("(?U)[\\s\\x1c-\\x1f]+") == 1


def hot(spark, n=30_000):
    """A table in which one key holds a third of the rows."""
    return spark.range(n).select(
        F.col("id").alias("ord"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("region_id"),
        F.lit("").alias("article_text"),
    )


def test_hot_key_keeps_results_whole(spark):
    df = hot(spark)
    assert dedupe.first_wins(df, "region_id", "ord").count() == 20_001
    assert dedupe.last_wins(df, "region_id", "ord").where("region_id = 'hot'").first().ord == 29_997
    assert joins.not_completed(df, df.limit(0)).count() == 30_000
    numbered = limits.row_index(df.withColumn("k", F.lit(1)), "ord", "i", ["k"])
    assert numbered.where("i <> ord").count() == 0
    new = spark.createDataFrame([(0, "hot", "x"), (1, "new", "y")], "ord bigint, region_id string, article_text string")
    done = tables.upsert(df, new)
    assert done.count() == 30_001
    assert [r.ord for r in done.where("article_text <> ''").orderBy("ord").collect()] == [29_997, 30_001]


def test_results_do_not_depend_on_partitioning(spark):
    for parts in (1, 7):
        df = hot(spark, 999).repartition(parts)
        got = sorted(tuple(r) for r in limits.batch_ids(df, 20).select("ord", "batch_id").collect())
        assert got == [(i, i // 20) for i in range(999)]


def test_row_index_never_windows_over_all_rows(spark):
    text = plan(limits.row_index(spark.range(10).withColumnRenamed("id", "ord"), "ord"))
    # The only unpartitioned window runs over group totals.
    assert text.count("SinglePartition") == 1


def test_materialize_and_scratch(spark):
    df = materialize(spark.range(5))
    assert df.count() == 5 and scratch_dir(spark)
    assert "Scan parquet" in plan(df)


def test_scratch_folder_named_by_the_cluster_comes_first():
    class Cluster:
        class conf:
            @staticmethod
            def get(name, default=None):
                return "/shared/folder" if name == "spark.checkpoint.dir" else default

    assert scratch_dir(Cluster) == "/shared/folder"


def test_a_cluster_without_a_shared_folder_is_told_so():
    class Cluster:
        class conf:
            @staticmethod
            def get(name, default=None):
                return default

        class sparkContext:
            master = "yarn"

            @staticmethod
            def getCheckpointDir():
                return None

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Cluster)


def test_feed_dates_are_parsed_once(spark):
    def months(name):
        return plan(registered.registry.QUERIES[name](spark, SF)).count("jan(?:uary)")

    # Reading the year off the finished date takes four patterns; the feed dates are not parsed again.
    assert months("flow_feeds_scan_and_clean") == months("p15_feed_match_rows") + 4


def test_numbered_rows_are_spread_over_tasks(spark):
    """Dense order values: the rows, which carry whole texts, do not meet in one task."""
    df = spark.range(20_000).select(F.col("id").alias("ord"), F.repeat(F.lit("x"), 50).alias("text"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = limits.row_index(df, "ord").groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) > 1 and max(r["count"] for r in sizes) < 15_000
    wrong = limits.row_index(df, "ord").where("row_idx <> ord")
    assert wrong.count() == 0


def test_pages_travel_to_python_in_small_batches(spark, tmp_path):
    """Whatever batches the session had: a worker holds few pages at once."""
    rows = spark.range(2000).selectExpr("id as page_id", "'u' as url", "concat('<p>', repeat('three words here ', 1000), id) as html")
    rows.coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    held = {k: spark.conf.get(k) for k in ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch")}
    try:
        for k in held:
            spark.conf.set(k, "2000000000")
        pages = registered.registry.base.table(spark, str(tmp_path), "pages")
        sizes = F.arrow_udf(lambda x: pa.array([sum(len(v) for v in x.to_pylist())] * len(x), pa.int64()), "long")
        most = pages.select(sizes("html").alias("n")).agg(F.max("n"), F.count("*")).first()
        assert most[0] < 16 << 20 and most[1] == 2000
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


def job_rows(spark, folder, rows):
    spark.createDataFrame(rows, "doc_id bigint, source string, lang string, text string").write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def test_section_lines_are_counted_in_their_rows(spark, tmp_path):
    rows = [(i, "web", "en", f"One {i}, two. Two {i}, one") for i in range(200)]
    found = registered.queries()["l7_section_state"](spark, job_rows(spark, tmp_path, rows))
    assert found.count() > 200
    # The only aggregation by lines is that of rows that share their doc_id.
    text = found._jdf.queryExecution().optimizedPlan().toString()
    alone, together = text.split("LeftAnti")[0], text.split("LeftAnti")[1].split("LeftSemi")[0]
    assert "Aggregate" not in alone and "Aggregate" in together


def test_section_lines_of_shared_and_missing_ids(spark, tmp_path):
    text = "Same line. Same line, other\n\nSame line"
    rows = [(1, "web", "en", text), (1, "web", "en", text), (1, "net", "en", "Same line"), (2, "web", "en", text)]
    rows += [(None, "web", "en", text), (None, "web", "en", text), (None, "web", None, text), (None, "web", "de", "Same line")]
    rows += [(3, "web", "en", None), (4, "web", "en", "")]
    folder = job_rows(spark, tmp_path, rows)
    found = [tuple(r) for r in registered.queries()["l7_section_state"](spark, folder).collect()]
    lines = job_docs(spark, folder).select("doc_id", tagged_lines("descr").alias("tagged")).collect()
    wanted = Counter((d, t.line, t.code or "-") for d, tagged in lines for t in tagged or [])
    assert len(found) == len(wanted) and {r[:3]: r[3] for r in found} == wanted
    assert max(n for d, *_, n in found if d is None) > 2
