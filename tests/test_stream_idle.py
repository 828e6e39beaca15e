"""The idle stop on streams against the one over tables."""

import random

import pytest
from pyspark.sql import functions as F

from gleanery.operators import limits
from gleanery.streaming import idle, streams

DDL = "feed string, pass bigint, post string, when string"


@pytest.fixture
def rocksdb(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", idle.STATE_STORE)
    yield spark
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def put(spark, folder, rows):
    spark.createDataFrame([(*r, "x") for r in rows], DDL).coalesce(1).write.mode("append").parquet(str(folder))


def passes(spark, folder, per_batch=1, **kw):
    stream = spark.readStream.schema(DDL).option("maxFilesPerTrigger", per_batch).parquet(str(folder))
    return idle.passes_until_idle(stream, run="feed", pass_col="pass", key="post", buckets=4, **kw)


def run(df, root):
    streams.append_stream(df, str(root / "out"), str(root / "state")).awaitTermination()
    return sorted(tuple(r) for r in df.sparkSession.read.parquet(str(root / "out")).collect())


def at_rest(spark, rows, **kw):
    out = []
    for feed in {r[0] for r in rows if r[0] is not None}:
        mine = spark.createDataFrame([(*r, "x") for r in rows if r[0] == feed], DDL)
        seen = mine.where("post is not null")
        found = limits.passes_until_idle(seen, mine.select("pass").distinct(), key="post", pass_col="pass", **kw)
        out += [(feed, r["pass"], r["new_keys"], r["idle_run"]) for r in found.collect()]
    return sorted(out)


def sightings(seed):
    rng = random.Random(seed)
    rows = []
    for p in range(8):
        for feed in ("a", "b", "c"):
            rows += [(feed, p, None)] + [(feed, p, str(rng.randrange(4 + 2 * p if feed == "c" else 6))) for _ in range(3)]
    return rows


@pytest.mark.parametrize("stop", [{}, {"max_idle": 2}, {"max_passes": 4}])
def test_a_stream_with_a_restart_equals_the_tables(rocksdb, tmp_path, stop):
    rows = sightings(5)
    for part in (rows[:48], rows[48:]):  # the stream is stopped and started again between them
        for p in sorted({r[1] for r in part}):
            put(rocksdb, tmp_path / "in", [r for r in part if r[1] == p])
        found = run(passes(rocksdb, tmp_path / "in", **stop), tmp_path)
    assert [r[:4] for r in found] == at_rest(rocksdb, rows, **stop)
    ends = {r[0]: r for r in found if r[4]}
    assert all(r[1] == max(f[1] for f in found if f[0] == r[0]) for r in ends.values())


def test_all_passes_in_one_batch(rocksdb, tmp_path):
    rows = sightings(9)
    put(rocksdb, tmp_path / "in", rows)
    assert [r[:4] for r in run(passes(rocksdb, tmp_path / "in"), tmp_path)] == at_rest(rocksdb, rows)


def test_odd_rows(rocksdb, tmp_path):
    put(rocksdb, tmp_path / "in", [("a", 2, "x"), ("a", 2, "x"), (None, 2, "y"), ("a", None, "z"), ("b", 5, None)])
    put(rocksdb, tmp_path / "in", [("a", 1, "w"), ("a", 3, "w"), ("a", 3, "z")])  # pass 1 comes late
    assert run(passes(rocksdb, tmp_path / "in"), tmp_path) == [("a", 2, 1, 0, False), ("a", 3, 1, 0, False), ("b", 5, 0, 1, False)]


def test_ids_are_forgotten_when_a_time_is_given(rocksdb, tmp_path):
    put(rocksdb, tmp_path / "in", [("a", 1, "x")])
    assert run(passes(rocksdb, tmp_path / "in", forget_ms=1), tmp_path) == [("a", 1, 1, 0, False)]
    put(rocksdb, tmp_path / "in", [("a", 2, "x")])
    assert run(passes(rocksdb, tmp_path / "in", forget_ms=1), tmp_path)[-1] == ("a", 2, 1, 0, False)


def test_an_idle_run_ends_the_query(rocksdb, tmp_path):
    for p in range(12):
        put(rocksdb, tmp_path / "in", [("a", p, "x")])
    counters = streams.StreamCounters("idle")
    rocksdb.streams.addListener(counters)
    try:
        seen = streams.counted(passes(rocksdb, tmp_path / "in"), "idle", ended=F.col("ended"))
        query = streams.append_stream(seen, str(tmp_path / "out"), str(tmp_path / "state"), available_now=False)
        idle.stop_after(query, counters, "ended")
    finally:
        rocksdb.streams.removeListener(counters)
    assert not query.isActive
    assert [r["pass"] for r in rocksdb.read.parquet(str(tmp_path / "out")).orderBy("pass").collect()] == [0, 1, 2, 3]


def test_the_state_store_is_named(spark, tmp_path):
    put(spark, tmp_path / "in", [("a", 1, "x")])
    with pytest.raises(ValueError, match="RocksDB"):
        passes(spark, tmp_path / "in")
