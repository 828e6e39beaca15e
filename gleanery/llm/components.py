"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import discard, materialize


class Forest:
    """Union-find over whole numbers; the root of a set is its smallest member."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        top = x
        while (above := parent.get(top, top)) != top:
            top = above
        while x != top:
            parent[x], x = top, parent.get(x, x)
        return top

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)

    def links(self) -> list[tuple[int, int]]:
        """(member, root) of all members that are not roots."""
        return [(x, self.root(x)) for x in list(self.parent) if self.root(x) != x]


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of each batch as stars: never more rows than came in."""
    for batch in batches:
        forest = Forest()
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            forest.join(a, b)
        a, b = zip(*found) if (found := forest.links()) else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every node of ``links`` (a, b: long) that is not the smallest of its component.

    Links to itself, repeated links and links with a null count for nothing. Each round is two aggregations
    and two joins with one row per node on the right side, written to the shared scratch folder; the number of
    rounds grows with the logarithm of the longest path. No node's neighbours are ever gathered in a task.
    """
    clean = links.where("a is not null and b is not null and a <> b").mapInArrow(_local, "a long, b long").distinct()
    edges, seen = materialize(clean), None
    while True:
        state = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
        if state == seen or not state[0]:
            return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
        seen = state
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large, old = materialize(large.distinct()), edges
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialize(small.unionByName(least.withColumnRenamed("m", "b")).distinct())
        discard(old, large)
