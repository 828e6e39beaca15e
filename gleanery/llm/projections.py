"""Embedding near-dedup by collision counting over one-dimensional projections.

Vectors of length one are projected on orthonormal directions, and each projection is sorted. Around a
query's value lies a window of fixed width; a row collides with the query in every projection in which it lies
in that window. Only rows with enough collisions are verified by their cosine.

The count is calibrated for full recall: two vectors of cosine c are sqrt(2 - 2c) apart, the squares of
the differences along orthonormal directions add up to at most that distance squared, so only
(2 - 2c) / window^2 directions can differ by more than the window.

A label of many vectors is first cut into cells: each of its first projections is cut at its mean, once for each
doubling of the label, and the sides name the cell. By the same sum of squares a vector can only be linked into
cells whose cuts lie within that distance of it, so it visits those and no others, and no pair is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from .common import discard, materialize, pick
from .components import Forest, components
from .vectors import matrix, sound

#: Vectors of one block; a task compares a block with at most VISITORS times as many visitors.
BLOCK = 4096
VISITORS = 4
#: Projections that can be cut at most.
CUTS = 20
#: Share of the directions in which a pair at the threshold may miss the window.
MISSES = 0.25


def directions(width: int, seed: int = 7) -> np.ndarray:
    """Orthonormal directions, as columns, the same in every task."""
    return np.linalg.qr(np.random.default_rng(seed).standard_normal((width, width)))[0]


def unit_rows(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by the largest component first, so that squares neither vanish nor overflow."""
    rows = rows / np.abs(rows).max(axis=1, initial=1e-320, keepdims=True)
    return rows / np.sqrt(np.square(rows).sum(axis=1, keepdims=True))


def squared_reach(threshold: float) -> float:
    """The largest squared distance of two unit vectors that can be linked, with room for rounding."""
    return max(0.0, 2 - 2 * threshold) * (1 + 1e-9) + 1e-12


class SortedProjections:
    """A block of unit vectors with each of its projections sorted."""

    def __init__(self, units: np.ndarray, threshold: float):
        self.units = units
        self.axes = directions(units.shape[1])
        values = units @ self.axes
        self.order = np.argsort(values, axis=0, kind="stable")
        self.values = np.take_along_axis(values, self.order, axis=0)
        apart = squared_reach(threshold)
        self.window = np.sqrt(apart / max(1.0, MISSES * units.shape[1]))
        self.least = units.shape[1] - int(apart / self.window**2 + 1e-9)
        self.threshold = threshold

    def links(self, units: np.ndarray):
        """For each query the positions of the rows in this block whose cosine reaches the threshold."""
        values = units @ self.axes
        width = values.shape[1]
        begin = [np.searchsorted(self.values[:, j], values[:, j] - self.window, "left").tolist() for j in range(width)]
        end = [np.searchsorted(self.values[:, j], values[:, j] + self.window, "right").tolist() for j in range(width)]
        order = np.ascontiguousarray(self.order.T)
        for i in range(len(units)):
            hits = [order[j, begin[j][i] : end[j][i]] for j in range(width)]
            counts = np.bincount(np.concatenate(hits), minlength=len(self.units))
            likely = np.flatnonzero(counts >= self.least)
            if len(likely):
                cosine = self.units[likely] @ units[i]
                yield i, likely[cosine >= self.threshold]


def visited_cells(values: np.ndarray, cuts: np.ndarray, used: np.ndarray, reach: float) -> tuple[np.ndarray, ...]:
    """(row, cell, home): the cells in which a row can have links, its own (home) and those of a higher number.

    The first ``used`` projections of a row are cut at ``cuts``. Two rows within the squared distance ``reach`` meet in
    the cell of the one of the higher number, or in the cell that is home to both.
    """
    count = values.shape[1]
    cut = np.arange(count) < used[:, None]
    gaps = np.where(cut, np.square(values - cuts), np.inf)
    own = ((cut & (values >= cuts)) << np.arange(count)).sum(axis=1)
    row, cell, far = np.arange(len(values)), own, np.zeros(len(values))
    # The highest cuts come first: a row that is on the upper side there can never reach a higher number by leaving it.
    for i in reversed(range(count)):
        crossed = far + gaps[row, i]
        over = crossed <= reach
        over &= (cell >> i > own[row] >> i) | (own[row] >> i & 1 == 0)
        row = np.concatenate([row, row[over]])
        cell = np.concatenate([cell, cell[over] ^ (1 << i)])
        far = np.concatenate([far, crossed[over]])
    return row, cell, cell == own[row]


def _project(batches):
    """Adds the length of each vector and its first projections."""
    for batch in batches:
        vectors = batch.column("vector")
        sizes = np.diff(vectors.offsets.to_numpy())
        values = np.zeros((batch.num_rows, CUTS))
        for width in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == width)
            first = directions(width)[:, :CUTS]
            values[at, : first.shape[1]] = unit_rows(matrix(vectors.take(pa.array(at)), width)) @ first
        lists = pa.FixedSizeListArray.from_arrays(pa.array(values.ravel()), CUTS).cast(pa.list_(pa.float64()))
        columns = [*batch.columns, pa.array(sizes, pa.int64()), lists]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "width", "spots"])


def _visit(batches, names: list[str], reach: float):
    """A row for each cell that a row visits."""
    for batch in batches:
        used = np.diff(batch.column("cuts").offsets.to_numpy())
        step = max(1, 2**16 >> int(used.max(initial=0)))
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            cuts = matrix(part.column("cuts"), CUTS)
            row, cell, home = visited_cells(matrix(part.column("spots"), CUTS), cuts, used[at : at + step], reach)
            taken = part.select(names).take(pa.array(row))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(cell), pa.array(home)], names=[*names, "cell", "home"])


SCHEMA = "a long, b long, links long"


def _compare(left: pa.Table, right: pa.Table, threshold: float) -> pa.Table:
    """For each class its links in a block, and links (a, b) that span the components of visitors and block.

    Visitors at home meet each other from both sides and count their own links only.
    """
    kind = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64())])
    if not (left.num_rows and right.num_rows):
        return kind.empty_table()
    width = right["width"][0].as_py()
    queries, rows = unit_rows(matrix(left["vector"], width)), unit_rows(matrix(right["vector"], width))
    ids, own, home = right["id"].to_numpy(), left["id"].to_numpy(), left["home"].to_numpy()
    weights, own_weights = right["copies"].to_numpy(), left["copies"].to_numpy()
    forest, links = Forest(), {}
    for i, found in SortedProjections(rows, threshold).links(queries):
        if home[i]:
            found = found[ids[found] != own[i]]
        if not len(found):
            continue
        mine = int(own[i])
        links[mine] = links.get(mine, 0) + int(weights[found].sum())
        for other in ids[found].tolist():
            if not home[i]:
                links[other] = links.get(other, 0) + int(own_weights[i])
            forest.join(mine, other)
    rows = [(a, None, n) for a, n in links.items()] + [(a, b, 0) for a, b in forest.links()]
    return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=kind) if rows else kind.empty_table()


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.98, block: int = BLOCK, label: str = "label"
) -> DataFrame:
    """Links between vectors of equal label and cosine >= ``threshold`` (over 0), and their components.

    Result, a row for each row of ``vectors``: vec_id, n_links (rows linked directly), component_id (smallest
    vec_id reachable by links, itself included), kept (vec_id = component_id).

    Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and rows with a null
    label or a null vec_id, link with nothing (component_id = vec_id, kept true); vectors of different lengths
    link with nothing; rows with equal label and vector are one class with so many copies, each linked with the
    others; rows of one vec_id with different vectors are one node, to which the links of all its vectors
    belong; an empty table gives an empty result; other columns
    play no part.

    At scale: copies are counted in the map tasks and compared once. A label of more than ``block`` vectors is cut into
    cells, and a vector is copied only to the cells that can hold its links. A task compares one block of a cell with
    a bounded number of visitors, however large the label or the cell; it returns link counts and at most one spanning
    link per vector, never all pairs. The tables of cut labels and of crowded cells have a row for at least ``block``
    vectors each.
    """
    rows = pick(vectors, "vec_id", label=label, vector="embedding")
    rows = rows.select(F.col("vec_id").cast("long"), "label", F.col("vector").cast("array<double>").alias("vector"))
    usable = (
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & sound(F.col("vector"))
        & F.exists("vector", lambda x: x != 0)
    )
    good = rows.where(usable)
    classes = good.groupBy("label", "vector").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"))
    added = [StructField("width", LongType()), StructField("spots", ArrayType(DoubleType()))]
    classes = materialize(classes.mapInArrow(_project, StructType([*classes.schema.fields, *added])))
    # Labels of more than one block, with a cut for each time their blocks double.
    wide = ("label", "width")
    means = F.array(*[F.avg(F.col("spots")[i]) for i in range(CUTS)])
    large = classes.groupBy(*wide).agg(F.count("*").alias("n"), means.alias("means")).where(F.col("n") > block)
    needed = F.least(F.ceil(F.log2(F.col("n") / block)), F.lit(CUTS), "width").cast("int")
    large = materialize(large.select(*wide, F.slice("means", 1, needed).alias("cuts")))
    marked = classes.join(large, list(wide), "left")
    reach = squared_reach(threshold) + 1e-9

    def visits(*names: str) -> DataFrame:
        fields = [*classes.select(*names).schema.fields, *StructType.fromDDL("cell long, home boolean").fields]
        return marked.mapInArrow(lambda batches: _visit(batches, list(names), reach), StructType(fields))

    # Cells that hold more than a block, or have more visitors than one task compares.
    place = [*wide, "cell"]
    crowded = visits(*wide).groupBy(*place).agg(
        F.ceil(F.count_if("home") / block).cast("long").alias("blocks"),
        F.ceil(F.count("*") / (VISITORS * block)).cast("long").alias("parties"),
    )
    crowded = materialize(crowded.where("blocks > 1 or parties > 1"))
    met = visits(*wide, "id", "vector", "copies").join(crowded, place, "left")
    met = met.withColumn("spot", F.xxhash64("id", "vector"))
    blocks, parties = (F.coalesce(F.col(c), F.lit(1)).cast("long") for c in ("blocks", "parties"))
    columns = [F.col(c).alias(c) for c in (*place, "id", "vector", "copies", "home")]

    def each(n):
        return F.explode(F.sequence(F.lit(0).cast("long"), n - 1))

    left = met.where(blocks > 0).select(*columns, each(blocks).alias("block"), F.pmod("spot", parties).alias("party"))
    right = met.where("home").select(*columns, F.pmod("spot", blocks).alias("block"), each(parties).alias("party"))

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        return _compare(left, right, threshold)

    keys = [*place, "block", "party"]
    found = materialize(left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(compare, SCHEMA))
    discard(large, crowded)
    counts = found.where("links > 0").groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    members = components(found.where("b is not null").select("a", "b"))
    known = classes.select("id", "label", "vector", "copies").join(counts, "id", "left").join(members, "id", "left")
    known = known.select(
        "label", "vector",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
    )
    out = good.join(known, ["label", "vector"])
    rest = rows.where(~F.coalesce(usable, F.lit(False))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
    )
    out = out.select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))
    return out.unionByName(rest)
