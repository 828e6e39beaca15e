"""The same work on streams: seen-id filter, incremental ingestion, continuous feed scan."""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from .. import fixed_values as fv
from ..operators.rows import feed_match_rows, with_entry_text
from ..operators.search import match_keywords
from ..operators.tables import append_batch, upsert_table
from ..sources.feeds import parse_feeds


def unseen_ids(
    stream: DataFrame, key: str, *, time_col: str | None = None, delay: str | None = None
) -> DataFrame:
    """Rows whose id was not seen before.

    Without a time column every id is remembered for good. With one, ids are forgotten
    ``delay`` after their time, which bounds the state.
    """
    if time_col is None:
        return stream.dropDuplicates([key])
    timed = stream.withColumn(time_col, F.col(time_col).cast("timestamp"))
    return timed.withWatermark(time_col, delay).dropDuplicatesWithinWatermark([key])


def ingest(
    stream: DataFrame,
    to_rows: Callable[[DataFrame, DataFrame], DataFrame],
    read_existing: Callable[[], DataFrame],
    *,
    root: str,
    schema: StructType | str,
    checkpoint: str,
    key: str = "region_id",
    available_now: bool = True,
) -> StreamingQuery:
    """Feed micro-batches into a versioned table.

    ``to_rows(batch, existing)`` builds the rows of a batch. A batch that is replayed after a
    failure finds its ids stored and only rewrites them with the same values.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        upsert_table(batch.sparkSession, root, to_rows(batch, read_existing()), schema, key)

    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def feed_documents(spark: SparkSession, path: str) -> DataFrame:
    """Stream of feed documents stored as Parquet files with ``xml_url, raw``."""
    return spark.readStream.schema("xml_url string, raw string").parquet(path)


def scan_feed_stream(
    docs: DataFrame,
    feeds: DataFrame,
    keywords: Sequence[str] = tuple(fv.DEFAULT_KEYWORDS),
    *,
    max_items: int | None = None,
) -> DataFrame:
    """Keyword matches of arriving feed documents; the feed list is a static table."""
    entries = parse_feeds(docs, max_items=max_items)
    matches = match_keywords(with_entry_text(entries), "article_text", keywords)
    return feed_match_rows(matches.join(feeds, "xml_url"))


def append_batches(
    stream: DataFrame, root: str, checkpoint: str, to_rows: Callable[[DataFrame], DataFrame] | None = None, available_now: bool = True
) -> StreamingQuery:
    """Append what ``to_rows`` makes of each micro-batch to a folder of batches (``tables.read_batches``).

    For work that a streaming plan cannot express. A batch that is replayed after a failure replaces its first try.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        append_batch(batch if to_rows is None else to_rows(batch), root, batch_id)

    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


class StreamCounters(StreamingQueryListener):
    """Adds up, over all micro-batches, the counters that streams observe under one name (see :func:`counted`).

    Register it with ``spark.streams.addListener`` before the stream starts. Counters of a batch that failed are not
    reported, so they are those of the rows that were written.
    """

    def __init__(self, name: str):
        self.name = name
        self.totals: dict[str, int] = {}
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _event(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._event(str(event.runId))

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(self.name)
        if seen is not None:
            with self._lock:
                for key, n in seen.asDict().items():
                    self.totals[key] = self.totals.get(key, 0) + (n or 0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._event(str(event.runId)).set()

    def after(self, query: StreamingQuery, seconds: float = 60) -> dict[str, int]:
        """The totals once a query has ended and its last batch was reported."""
        query.awaitTermination()
        if not self._event(str(query.runId)).wait(seconds):
            raise TimeoutError("the end of the stream was not reported")
        return dict(self.totals)


def counted(stream: DataFrame, name: str, **counters: Column) -> DataFrame:
    """The stream, with the number of rows that satisfy each condition observed under ``name``."""
    return stream.observe(name, *[F.count(F.when(c, 1)).alias(k) for k, c in counters.items()])


def append_stream(df: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append a stream to a Parquet folder, each row exactly once."""
    writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
