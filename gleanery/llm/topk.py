"""Exact top-k search by inner product: columnar branch-and-bound over blocks of dimensions.

Vectors lie in vertical layout, a row of the matrix for each dimension. Scores are accumulated one block
of dimensions at a time; after each block, a candidate stays only if its sum so far plus the largest
inner product that the remaining dimensions can still add reaches the k-th best score known.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import materialize, pick
from .vectors import matrix, sound

#: Rows of one candidate block and of one query block; a task holds one of each.
ROW_BLOCK = 32_768
QUERY_BLOCK = 4_096
DIMENSIONS = 16
#: Queries whose first block of dimensions is scored together.
TOGETHER = 32
EXACT = float(2**53)


class VerticalBlock:
    """Candidates in vertical layout, with the mass that lies behind each block of dimensions."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, dimensions: int = DIMENSIONS):
        order = np.argsort(ids, kind="stable")
        self.ids, rows = ids[order], rows[order]
        # Dimensions of large spread first: bounds fall soonest.
        self.axes = np.argsort(-np.square(rows).sum(axis=0), kind="stable")
        self.columns = np.ascontiguousarray(rows[:, self.axes].T)
        self.starts = list(range(0, max(1, rows.shape[1]), dimensions))
        self.step = dimensions
        squares = np.square(self.columns)
        self.mass = [np.sqrt(squares[s + dimensions :].sum(axis=0)) for s in self.starts]

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
        """(position of the query, id, score) of the k best candidates of each query, ties to smaller ids."""
        queries = queries[:, self.axes]
        out: list[tuple[np.ndarray, ...]] = []
        first = self.columns[: self.step]
        for at in range(0, len(queries), TOGETHER):
            part = queries[at : at + TOGETHER]
            sums = part[:, : self.step] @ first
            for i in range(len(part)):
                own, score = self._one(query_ids[at + i], part[i], sums[i], k)
                out.append((np.full(len(own), at + i), self.ids[own], score))
        if not out:
            return np.empty(0, int), np.empty(0, int), np.empty(0)
        return tuple(np.concatenate(x) for x in zip(*out))

    def _rest(self, query: np.ndarray, at: np.ndarray, begin: int) -> np.ndarray:
        return query[begin:] @ self.columns[begin:, at] if begin < len(query) else np.zeros(len(at))

    def _one(self, query_id: int, query: np.ndarray, sums: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and scores of the k best, without the rows of the query's own id."""
        left, right = np.searchsorted(self.ids, [query_id, query_id + 1])
        alive = np.arange(len(self.ids))
        if left < right:
            alive = np.delete(alive, slice(left, right))
            sums = np.delete(sums, slice(left, right))
        floor = -np.inf
        for n, start in enumerate(self.starts):
            if n:
                sums = sums + query[start : start + self.step] @ self.columns[start : start + self.step, alive]
            if len(alive) <= k:
                sums = sums + self._rest(query, alive, start + self.step)
                break
            rest = np.sqrt(np.square(query[start + self.step :]).sum())
            if rest == 0:
                continue
            mass = self.mass[n][alive] * rest
            if n == 0:
                # The most promising candidates are scored in full: their k-th best is a floor.
                likely = np.argpartition(-sums, min(4 * k, len(sums)) - 1)[: 4 * k]
                full = sums[likely] + self._rest(query, alive[likely], start + self.step)
                floor = np.sort(full)[-k]
            else:
                floor = max(floor, np.partition(sums - mass, len(sums) - k)[len(sums) - k])
            # The bound is rounded; one part in a billion and one unit cover that.
            keep = sums + mass * (1 + 1e-9) + 1 >= floor
            alive, sums = alive[keep], sums[keep]
        if len(alive) > k:
            edge = np.partition(sums, len(sums) - k)[len(sums) - k]
            keep = sums >= edge
            alive, sums = alive[keep], sums[keep]
        best = np.lexsort((alive, -sums))[:k]
        return alive[best], sums[best]


def _exact_search(ids, rows, query_ids, queries, k):
    """The same by whole-number arithmetic, for values beyond exact doubles."""
    rows = [[int(v) for v in x] for x in rows]
    out = []
    for at, (own, query) in enumerate(zip(query_ids.tolist(), queries)):
        query = [int(v) for v in query]
        scored = ((-sum(a * b for a, b in zip(query, x)), i) for i, x in zip(ids.tolist(), rows) if i != own)
        out += [(at, i, -s) for s, i in sorted(scored)[:k]]
    return tuple(zip(*out)) if out else ((), (), ())


SCHEMA = "query_id long, vec_id long, score decimal(38,0)"


def _search_block(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    queries, rows = left, right
    width = 0
    for table in (queries, rows):
        if table.num_rows:
            sizes = np.diff(table["vector"].combine_chunks().offsets.to_numpy())
            width = max(width, int(sizes.max()))
    kind = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.decimal128(38, 0))])
    if not (queries.num_rows and rows.num_rows):
        return kind.empty_table()
    q, x = matrix(queries["vector"], width), matrix(rows["vector"], width)
    query_ids, ids = queries["id"].to_numpy(), rows["id"].to_numpy()
    if max(1, width) * np.abs(q).max(initial=0) * np.abs(x).max(initial=0) < EXACT:
        at, found, score = VerticalBlock(ids, x).search(query_ids, q, k)
        score = score.astype(np.int64).tolist()
    else:
        at, found, score = _exact_search(ids, x, query_ids, q, k)
    most = 10**38 - 1
    return pa.Table.from_arrays(
        [
            pa.array(query_ids[np.asarray(at, int)]),
            pa.array(found, pa.int64()),
            pa.array([min(max(int(s), -most), most) for s in score], pa.decimal128(38, 0)),
        ],
        schema=kind,
    )


def scaled(vectors: DataFrame, scale: float = 64.0) -> DataFrame:
    """(id, vector): whole numbers floor(scale * x), as doubles; of rows that share an id the smallest vector.

    Rows with a null id and vectors that are null or hold null or non-finite components are left out.
    """
    rows = pick(vectors, id="vec_id", vector="embedding").where(F.col("id").isNotNull() & sound(F.col("vector")))

    def whole_number(x):
        # Doubles of 2^53 and more are whole numbers, and beyond 2^63 no bigint.
        x = F.lit(scale) * x.cast("double")
        x = F.greatest(F.least(x, F.lit(sys.float_info.max)), F.lit(-sys.float_info.max))
        return F.when(F.abs(x) < EXACT, F.floor(x).cast("double")).otherwise(x)

    whole = F.transform("vector", whole_number)
    return rows.select(F.col("id").cast("long"), whole.alias("vector")).groupBy("id").agg(F.min("vector").alias("vector"))


def top_k(
    vectors: DataFrame,
    k: int = 20,
    every: int = 20,
    scale: float = 64.0,
    row_block: int = ROW_BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """The k best rows by integer inner product for each row whose vec_id is divisible by ``every``.

    Result: query_id, rank (from 1), vec_id, score; ties go to the smaller vec_id; fewer rows where there are
    fewer candidates.

    Defined cases: vectors that are null or hold null or non-finite components and rows without vec_id take no
    part; of rows that share a vec_id the smallest vector counts; vectors of different lengths are compared over
    the components both have; scores beyond 64 bits are ranked exactly and shown as the nearest 64-bit number,
    those of more than 38 digits count as equal; components that are no longer finite when scaled count as the largest double; an
    empty table gives an empty result; other columns play no part.

    At scale: queries and rows are cut into blocks of fixed size by a hash of their id, and a task holds one block
    of each, so memory does not grow with the data. Each pair of blocks returns at most k rows per query, cut
    further to k per query inside the map tasks of the last shuffle.
    """
    rows = materialize(scaled(vectors, scale))
    count = rows.agg(F.count("*"), F.count(F.when(F.col("id") % every == 0, 1))).first()
    row_blocks, query_blocks = -(-count[0] // row_block) or 1, -(-count[1] // query_block) or 1
    spot = F.xxhash64("id")
    queries = rows.where(F.col("id") % every == 0).select(
        "id", "vector",
        F.pmod(spot, F.lit(query_blocks)).alias("qb"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(row_blocks - 1).cast("long"))).alias("rb"),
    )
    candidates = rows.select(
        "id", "vector",
        F.pmod(spot, F.lit(row_blocks)).alias("rb"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(query_blocks - 1).cast("long"))).alias("qb"),
    )

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        return _search_block(left, right, k)

    found = queries.groupBy("qb", "rb").cogroup(candidates.groupBy("qb", "rb")).applyInArrow(search, SCHEMA)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    low, high = F.lit(-(2**63)).cast("decimal(38,0)"), F.lit(2**63 - 1).cast("decimal(38,0)")
    score = F.least(F.greatest("score", low), high).cast("long")
    return ranked.select("query_id", "rank", "vec_id", score.alias("score"))
