"""Replayed batches and counters of streams."""

from pyspark.sql import functions as F

from gleanery.operators import tables
from gleanery.streaming import streams

DDL = "id bigint, v string"


def folder_stream(spark, folder, files):
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, DDL).coalesce(1).write.mode("append").parquet(str(folder))
    return spark.readStream.schema(DDL).option("maxFilesPerTrigger", 1).parquet(str(folder))


def test_a_replayed_batch_counts_once(spark, tmp_path):
    root = str(tmp_path / "rows")
    assert tables.read_batches(spark, root, DDL).collect() == []
    first = spark.createDataFrame([(1, "a"), (2, "b")], DDL)
    tables.append_batch(first, root, 0)
    tables.append_batch(first, root, 1)
    tables.append_batch(first, root, 0)
    assert sorted(r.id for r in tables.read_batches(spark, root, DDL).collect()) == [1, 1, 2, 2]


def test_a_stream_that_fails_half_way_appends_each_batch_once(spark, tmp_path):
    stream = folder_stream(spark, tmp_path / "in", [[(i, "x"), (i + 10, "y")] for i in range(3)])
    root, state, failed = str(tmp_path / "rows"), str(tmp_path / "state"), []

    def rows(batch):
        return batch.where("v = 'x'")

    def fail_once(batch):
        if batch.where("id = 1").count() and not failed:
            failed.append(1)
            tables.append_batch(rows(batch), root, 1)  # written, but never committed by the stream
            raise ValueError("lost")
        return rows(batch)

    query = streams.append_batches(stream, root, state, fail_once)
    try:
        query.awaitTermination()
    except Exception as error:  # noqa: BLE001
        assert "lost" in str(error)
    streams.append_batches(stream, root, state, fail_once).awaitTermination()
    assert sorted(r.id for r in tables.read_batches(spark, root, DDL).collect()) == [0, 1, 2] and failed


def test_counters_add_up_over_batches(spark, tmp_path):
    files = [[(i, "x"), (i + 10, "y"), (i + 20, None)] for i in range(4)]
    stream = folder_stream(spark, tmp_path / "in", files)
    counters = streams.StreamCounters("made")
    spark.streams.addListener(counters)
    try:
        seen = streams.counted(stream, "made", rows=F.lit(True), xs=F.col("v") == "x", nulls=F.col("v").isNull())
        query = streams.append_stream(seen, str(tmp_path / "out"), str(tmp_path / "state"))
        assert counters.after(query) == {"rows": 12, "xs": 4, "nulls": 4}
    finally:
        spark.streams.removeListener(counters)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 12
