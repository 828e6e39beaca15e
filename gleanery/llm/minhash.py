"""MinHash near-dedup by a multi-index Hamming join, confirmed on full shingle sets.

Every distinct set of word shingles has a signature of 16-bit symbols. The signature is split into chunks; two
signatures that differ in fewer than twice as many symbols as there are chunks have, by the pigeonhole principle, a
chunk in which at most one symbol differs. So a row is filed under each chunk with each symbol left out in turn, and
rows that share a key are candidates. Links are confirmed on the full sets.

Near copies come in large groups, so candidates are never listed pair by pair. Each row is first compared with the pivot
of its keys. Where a key still holds several components, its rows outside the largest one (the anchor) are
compared, block against block, with all rows of the anchor and with one another.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import discard, materialize, parts, pick
from .components import Forest, components

#: Symbols of a signature, at most, and the chance at which a pair right at the threshold may be missed.
SYMBOLS = 48
MISS = 1e-5
#: Shingles of one block of sets; a task compares two blocks.
BLOCK = 1_000_000
TOGETHER = 4 << 20
#: Remembered word hashes in each task.
REMEMBERED = 200_000


class _Hashes(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


def shingle_set(text: str, width: int, hashes: _Hashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles: A-Z in lower case, words between ASCII white space.

    With fewer words than ``width`` the whole sequence is one shingle; without words the set is empty.
    """
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(width, len(h))
    n = len(h) - width + 1
    total = np.full(n, width, np.uint64)
    for i in range(width):
        total = (total ^ h[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(29)
    return np.unique(total)


def chunk_size(similarity: float, symbols: int = SYMBOLS) -> int:
    """The longest chunk with which a pair at the similarity shares a key but for a chance of ``MISS``."""
    for size in range(8, 2, -1):
        near = similarity**size + size * (1 - similarity) * similarity ** (size - 1)
        if (1 - near) ** (symbols // size) <= MISS:
            return size
    return 2


class Signer:
    """Signatures of sets, and their keys by chunk and left-out symbol."""

    def __init__(self, similarity: float, seed: int = 5):
        self.size = chunk_size(similarity)
        self.chunks = SYMBOLS // self.size
        rng = np.random.default_rng(seed)
        n = self.size * self.chunks
        self.flip = rng.integers(0, 2**64, n, dtype=np.uint64)
        self.factor = rng.integers(0, 2**64, n, dtype=np.uint64) | np.uint64(1)

    def signature(self, found: np.ndarray) -> np.ndarray:
        least = np.full(len(self.flip), np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(found), 4096):
            part = (found[at : at + 4096, None] ^ self.flip) * self.factor
            np.minimum(least, part.min(axis=0), out=least)
        return ((least * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(48)).astype(np.uint16)

    def keys(self, signatures: np.ndarray) -> np.ndarray:
        """One column for each chunk and left-out symbol."""
        s = signatures.astype(np.uint64).reshape(-1, self.chunks, self.size)
        out = np.empty((len(s), self.chunks, self.size), np.uint64)
        for left_out in range(self.size):
            key = np.arange(self.chunks, dtype=np.uint64)[None] * np.uint64(16) + np.uint64(left_out)
            key = np.broadcast_to(key, s.shape[:2])
            for i in range(self.size):
                if i != left_out:
                    key = (key ^ s[:, :, i]) * np.uint64(0xBF58476D1CE4E5B9)
                    key = key ^ (key >> np.uint64(30))
            out[:, :, left_out] = key
        return out.reshape(len(s), -1).view(np.int64)


def linked(left: list[np.ndarray], right: list[np.ndarray], per_cent: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each set on the left the positions of the sets on the right that reach the similarity."""
    sizes = np.array([len(x) for x in right])
    flat = np.concatenate(right)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], np.repeat(np.arange(len(right)), sizes)[order]
    for i, own in enumerate(left):
        begin, end = np.searchsorted(flat, own, "left"), np.searchsorted(flat, own, "right")
        count = end - begin
        total = int(count.sum())
        if not total:
            continue
        at = np.arange(total) + np.repeat(begin - np.concatenate([[0], np.cumsum(count)[:-1]]), count)
        shared = np.bincount(owner[at], minlength=len(right))
        found = np.flatnonzero(100 * shared >= per_cent * (len(own) + sizes - shared))
        if len(found):
            yield i, found


def _sets(table: pa.Table) -> tuple[list[int], list[np.ndarray]]:
    return table["id"].to_pylist(), [np.frombuffer(x.as_py(), np.uint64) for x in table["found"]]


def _compare(left: pa.Table, right: pa.Table, per_cent: int) -> pa.Table:
    """Links that span the components of two blocks."""
    forest = Forest()
    if left.num_rows and right.num_rows:
        ids, sets = _sets(right)
        own, own_sets = _sets(left)
        for i, found in linked(own_sets, sets, per_cent):
            for j in found.tolist():
                forest.join(own[i], ids[j])
    a, b = zip(*found) if (found := forest.links()) else ((), ())
    return pa.Table.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def compare_groups(left: DataFrame, right: DataFrame, sets: DataFrame, sizes: DataFrame, per_cent: int) -> DataFrame:
    """Links (a, b) between the sets that ``left`` and ``right`` (group, id: distinct rows) name in each group.

    Each side of a group is cut into blocks of about ``BLOCK`` shingles by the ``sizes`` (id, n) of its sets, so a group of
    any size is compared by tasks of bounded memory; they return spanning links, not pairs. The ``sets`` (id, found)
    are joined once, when the rows are dealt.
    """

    def blocks(side: DataFrame, name: str) -> DataFrame:
        sized = side.join(sizes, "id").groupBy("group")
        return sized.agg(F.ceil(F.sum("n") / BLOCK).cast("long").alias(name))

    counts = materialize(blocks(left, "lefts").join(blocks(right, "rights"), "group"))

    def dealt(side: DataFrame, is_left: bool) -> DataFrame:
        own, other = ("lefts", "rights") if is_left else ("rights", "lefts")
        block = F.pmod(F.xxhash64("id"), F.col(own)).alias("l" if is_left else "r")
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)).alias("r" if is_left else "l")
        rows = side.join(counts, "group").select("group", "id", block, every)
        return rows.select("group", "l", "r", "id", F.lit(is_left).alias("left"))

    rows = dealt(left, True).unionByName(dealt(right, False)).join(sets, "id")

    def compare(table: pa.Table) -> pa.Table:
        return _compare(table.filter(table["left"]), table.filter(pc.invert(table["left"])), per_cent)

    return rows.groupBy("group", "l", "r").applyInArrow(compare, "a long, b long")


def signatures(docs: DataFrame, width: int, signer: Signer) -> DataFrame:
    """doc_id, hash of the text (t1, t2), n_shingles, digest (d1, d2) and signature of the shingle set of each whole text."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            for part in parts(batch, "text", TOGETHER):
                found = [shingle_set(x.as_py() or "", width, hashes) for x in part.column("text")]
                digests = np.array([_digest(x) for x in found], np.uint64).view(np.int64).reshape(-1, 2)
                signed = [signer.signature(x).tobytes() if len(x) else None for x in found]
                columns = [
                    *[part.column(c) for c in ("doc_id", "t1", "t2")], pa.array([len(x) for x in found], pa.int64()),
                    pa.array(digests[:, 0]), pa.array(digests[:, 1]), pa.array(signed, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "t1", "t2", "n_shingles", "d1", "d2", "signature"])

    named = docs.select("doc_id", *text_hash("text"), "text")
    return named.mapInArrow(sign, "doc_id long, t1 long, t2 long, n_shingles long, d1 long, d2 long, signature binary")


def text_hash(text: str) -> tuple[Column, Column]:
    """t1 and t2, a hash of a text; null counts as empty."""
    whole = F.coalesce(text, F.lit(""))
    return F.xxhash64(whole).alias("t1"), F.xxhash64(F.lit("second"), whole).alias("t2")


def _digest(found: np.ndarray) -> tuple[int, int]:
    whole = xxhash.xxh3_128_intdigest(found.tobytes())
    return whole >> 64, whole & (2**64 - 1)


def full_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(id, found): the sets of the classes that ``wanted`` (id, doc_id, d1, d2, copies) names, each taken from the rows of a doc_id."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            for part in parts(batch, "text", TOGETHER):
                rows = []
                for name, text, d1, d2 in zip(*(part.column(c).to_pylist() for c in ("id", "text", "d1", "d2"))):
                    found = shingle_set(text or "", width, hashes)
                    if _digest(found) == (d1 % 2**64, d2 % 2**64):
                        rows.append((name, found.tobytes()))
                names, sets = zip(*rows) if rows else ((), ())
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(sets, pa.binary())], names=["id", "found"])

    joined = docs.join(wanted, "doc_id").select("id", "text", "d1", "d2", "copies")
    once, more = (joined.where(x).mapInArrow(build, "id long, found binary") for x in ("copies = 1", "copies > 1"))
    # Only a class of several rows can come from several rows of its doc_id.
    return once.unionByName(more.dropDuplicates(["id"]))


def near_duplicates(docs: DataFrame, width: int = 5, per_cent: int = 80) -> DataFrame:
    """Near-duplicate classes of whole texts: word shingle sets with 100 * shared >= ``per_cent`` * union are linked.

    Result, a row for each row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id reachable by links, itself
    included), kept (doc_id = component_id).

    Defined cases: texts without words and null texts have no shingle and link with nothing; a row with a null
    doc_id links with nothing and is kept (component_id null); rows that share a doc_id but not the set are nodes of their own,
    which bear the same name; equal sets are linked; an empty table gives an empty result; other columns play no part.

    All pairs whose signatures differ in fewer than twice as many symbols as there are chunks are found; a pair at the
    threshold is missed with a chance of at most ``MISS``, a closer one far less.
    """
    return near_duplicate_rows(docs, width, per_cent).select("doc_id", "n_shingles", "component_id", "kept")


def near_duplicate_rows(docs: DataFrame, width: int, per_cent: int) -> DataFrame:
    """:func:`near_duplicates`, with the hash of each text (t1, t2) and the digest of its set (d1, d2)."""
    docs = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    signer = Signer(per_cent / 100)
    signed = materialize(signatures(docs, width, signer))
    usable = signed.where("n_shingles > 0 and doc_id is not null")
    # A class is a distinct set; it has a number of its own, as a doc_id may stand on rows of different sets.
    classes = usable.groupBy("d1", "d2").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("signature").alias("signature"), F.count("*").alias("copies")
    )
    classes = materialize(classes.withColumn("id", F.monotonically_increasing_id()))
    sizes = classes.select("id", "n")

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = signer.size * signer.chunks
        for batch in batches:
            if batch.num_rows:
                s = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint16).reshape(-1, n)
                ids = np.repeat(batch.column("id").to_numpy(), n)
                yield pa.RecordBatch.from_arrays([pa.array(signer.keys(s).ravel()), pa.array(ids)], names=["key", "id"])

    keys = classes.select("id", "signature").mapInArrow(file, "key long, id long")
    shared = keys.groupBy("key").agg(F.min("id").alias("pivot"), F.max("id").alias("last")).where("pivot < last")
    filed = materialize(keys.join(shared.select("key", "pivot"), "key"))
    wanted = filed.select("id").distinct().join(classes.select("id", "doc_id", "d1", "d2", "copies"), "id")
    sets = materialize(full_sets(docs, wanted, width))
    # First each row with the pivot that most of its keys have, of those whose sets are not too unlike in size.
    votes = filed.where("id <> pivot").groupBy("id", "pivot").agg(F.count("*").alias("votes"))
    votes = votes.join(sizes, "id").join(sizes.select(F.col("id").alias("pivot"), F.col("n").alias("m")), "pivot")
    votes = votes.where(100 * F.least("n", "m") >= per_cent * F.greatest("n", "m"))
    stars = materialize(votes.groupBy("id").agg(F.max(F.struct("votes", -F.col("pivot"), "pivot"))["pivot"].alias("group")))
    pivots = stars.select("group").distinct().select("group", F.col("group").alias("id"))
    first = materialize(compare_groups(stars, pivots, sets, sizes, per_cent))
    members = components(first)
    rows = filed.select("key", "id").join(members, "id", "left")
    rows = materialize(rows.select("key", "id", F.coalesce("component", "id").alias("component")))
    discard(filed, stars, members)
    anchors = anchors_of(rows)
    outside = rows.join(anchors, "key").where(F.col("component") != F.col("group")).select("group", "id").distinct()
    outside = materialize(outside)
    inside = rows.select(F.col("component").alias("group"), "id").distinct().join(outside.select("group").distinct(), "group", "left_semi")
    second = compare_groups(outside, inside.unionByName(outside).distinct(), sets, sizes, per_cent)
    found = components(first.unionByName(second))
    discard(sets, first, rows, outside)
    named = classes.select("d1", "d2", "id", "doc_id").join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = materialize(named.join(least, "component").select("d1", "d2", "component_id"))
    discard(classes, found)
    linked_rows = usable.drop("signature").join(named, ["d1", "d2"])
    alone = signed.where("n_shingles = 0 or doc_id is null").drop("signature").withColumn("component_id", F.col("doc_id"))
    return linked_rows.unionByName(alone).withColumn("kept", _same("doc_id", "component_id"))


def anchors_of(rows: DataFrame) -> DataFrame:
    """(key, group): the component with most rows of each key that holds several."""
    counts = rows.groupBy("key", "component").agg(F.count("*").alias("n"))
    best = F.max(F.struct("n", -F.col("component"), "component"))["component"]
    return counts.groupBy("key").agg(best.alias("group"), F.count("*").alias("several")).where("several > 1").drop("several")


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))
