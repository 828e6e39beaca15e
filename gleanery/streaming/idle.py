"""The idle stop on a stream: runs of passes that end once several passes in a row bring no new id."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from .. import fixed_values as fv
from .streams import StreamCounters

#: The state store that keeps each id as a record of its own, on disk.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


class _NewKeys(StatefulProcessor):
    """For one bucket of the ids of a run: of each pass, how many ids it is the first to bring."""

    def __init__(self, forget_ms: int | None):
        self.forget_ms = forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", "id string", "pass bigint", self.forget_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first: dict[str, int] = {}
        fresh: Counter[int] = Counter()
        for batch in rows:
            for made in batch["made"].unique().tolist():
                fresh[made] += 0
            for found, made in batch.dropna(subset=["id"]).groupby("id")["made"].min().items():
                first[found] = min(made, first.get(found, made))
        for found, made in first.items():
            if not self.seen.containsKey((found,)):
                self.seen.updateValue((found,), (int(made),))
                fresh[made] += 1
        yield pd.DataFrame({"run": key[0], "made": list(fresh), "new_keys": list(fresh.values())})


class _IdleRun(StatefulProcessor):
    """For one run: numbers its passes, counts idle ones in a row, ends it."""

    def __init__(self, max_idle: int, max_passes: int | None):
        self.max_idle, self.max_passes = max_idle, max_passes

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "pass bigint, turn bigint, idle bigint, ended boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        fresh: Counter[int] = Counter()
        for batch in rows:
            for made, n in zip(batch["made"].tolist(), batch["new_keys"].tolist()):
                fresh[made] += n
        last, turn, idle, ended = self.last.get() or (None, 0, 0, False)
        out = []
        for made in sorted(fresh):
            if ended or (last is not None and made <= last):
                continue
            last, turn, idle = made, turn + 1, 0 if fresh[made] else idle + 1
            ended = idle >= self.max_idle or turn == self.max_passes
            out.append((key[0], made, fresh[made], idle, ended))
        if out:
            self.last.update((last, turn, idle, ended))
        yield pd.DataFrame(out, columns=["run", "made", "new_keys", "idle_run", "ended"])


def passes_until_idle(
    sightings: DataFrame,
    *,
    run: str,
    pass_col: str,
    key: str,
    max_idle: int = fv.MAX_IDLE_PASSES,
    max_passes: int | None = None,
    buckets: int = 64,
    forget_ms: int | None = None,
) -> DataFrame:
    """The passes each run makes, as :func:`gleanery.operators.limits.passes_until_idle` finds them at rest.

    ``sightings`` streams (run, pass, id); a row with a null id says that the pass was made, so a pass that saw nothing counts
    too. Rows with a null run or pass play no part. Passes of a run arrive in ascending order, and all rows of a pass in
    one micro-batch (a file per pass, say); what arrives for a pass at or before the last one counted changes no count.
    Result: run, pass, new_keys, idle_run (passes without a new id up to here), ended (true in the last row of a run).
    Columns keep the names given for run and pass; run is a string.

    The ids of a run are spread over ``buckets``, each of which sends one row per pass on, so a run with most of the rows
    is the work of many tasks and its counter sees no ids. ``forget_ms`` drops ids that long after their first sighting and so
    bounds the state; by default they are kept for good.
    """
    _check_store(sightings.sparkSession)
    if forget_ms is not None:
        # Spark runs a batch after every batch once state can expire, so a run over what is there would never end. Expired ids
        # are told by their time whenever they are asked for; no batch without rows is needed.
        sightings.sparkSession.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    # Spark hands rows over as named tuples, which rename columns that are Python keywords: a pass is called "made" inside.
    rows = sightings.select(
        F.col(run).cast("string").alias("run"), F.col(pass_col).cast("bigint").alias("made"), F.col(key).cast("string").alias("id")
    ).where("run is not null and made is not null")
    bucket = F.pmod(F.xxhash64("id"), F.lit(buckets))
    found = rows.withColumn("bucket", bucket).groupBy("run", "bucket").transformWithStateInPandas(
        statefulProcessor=_NewKeys(forget_ms),
        outputStructType="run string, made bigint, new_keys bigint",
        outputMode="Append",
        timeMode="None" if forget_ms is None else "ProcessingTime",
    )
    counted = found.groupBy("run").transformWithStateInPandas(
        statefulProcessor=_IdleRun(max_idle, max_passes),
        outputStructType="run string, made bigint, new_keys bigint, idle_run bigint, ended boolean",
        outputMode="Append",
        timeMode="None",
    )
    return counted.withColumnsRenamed({"run": run, "made": pass_col})


def stop_after(query: StreamingQuery, counters: StreamCounters, ended: str, runs: int = 1, poll: float = 0.2) -> None:
    """Stop a query once the observed counter ``ended`` says that so many runs have ended; return at its end."""
    while query.isActive and counters.totals.get(ended, 0) < runs:
        query.awaitTermination(poll)
    query.stop()


def _check_store(spark: SparkSession) -> None:
    if spark.conf.get(_PROVIDER, "") != STATE_STORE:
        raise ValueError(f"set {_PROVIDER} to {STATE_STORE}: the idle stop keeps its ids there")
