"""Suffix-array dedup over a run-length index: removal of long byte strings that occur more than once.

A string of ``length`` bytes is filed under the smallest hash of its ``GRAM``-byte substrings, so equal strings
are filed together wherever they stand, and neighbouring strings mostly share their key: a document falls into
contexts, runs of string starts with one key. Only contexts whose key occurs again can hold repeats.
The distinct contexts of some keys form a collection, highly repetitive by construction, for which a run-compressed
Burrows-Wheeler transform with sampled run ends is built; streaming the texts through it from right to left
gives their matching statistics, and string starts that match at least ``length`` bytes elsewhere are marked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import discard, materialize, parts, pick

#: Bytes of the substrings whose smallest hash is a key.
GRAM = 32
#: Bytes of text in one index, unless a single key has more; a key with more than four times as many bytes of distinct
#: contexts is settled string by string.
INDEX_BYTES = 1 << 20
#: String starts of one context at most.
STARTS = 1 << 16
#: Bytes of documents searched for keys together.
TOGETHER = 1 << 20

_M = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A 64-bit hash of the ``gram`` (a power of two) bytes that begin at each position."""
    h = (data.astype(np.uint64) + np.uint64(1)) * _M
    h ^= h >> np.uint64(29)
    size = 1
    while size < gram:
        h = (h[:-size] * _M) ^ h[size:]
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(31)
        size *= 2
    return h


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    """The smallest of ``width`` neighbours from each position on."""
    size = 1
    while size * 2 <= width:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    rest = width - size
    return np.minimum(h[: len(h) - rest], h[rest:]) if rest else h


def contexts_of(texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """(text, start, number of string starts, key, whether it may repeat a string itself) of the contexts of some texts.

    Equal strings within one context have the key's substring at two places; contexts of more than ``STARTS`` string
    starts (which only periodic text has) are cut.
    """
    none = (*[np.empty(0, np.int64)] * 4, np.empty(0, bool))
    sizes = np.array([len(x) for x in texts], np.int64)
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(texts), np.uint8)
    gram = min(GRAM, 1 << (length.bit_length() - 1))
    if len(data) < length:
        return none
    hashes, width = gram_hashes(data, gram), length - gram + 1
    key = sliding_min(hashes, width)
    owner = np.repeat(np.arange(len(texts)), sizes)[: len(key)]
    inside = np.arange(len(key)) + length <= ends[owner]
    at = np.flatnonzero(inside)
    if not len(at):
        return none
    # Places that are the smallest of some string: where the hash is the largest key of the strings around.
    around = np.concatenate([np.zeros(width - 1, np.uint64), key, np.zeros(width - 1, np.uint64)])
    smallest = np.flatnonzero(hashes == ~sliding_min(~around, width))
    key, owner = key[at], owner[at]
    change = np.r_[True, (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])]
    place = np.arange(len(at)) - np.maximum.accumulate(np.where(change, np.arange(len(at)), 0))
    new = np.flatnonzero(place % STARTS == 0)
    count = np.diff(np.r_[new, len(at)])
    first, begin, value = owner[new], at[new], key[new]
    low = np.searchsorted(smallest, begin)
    many = np.searchsorted(smallest, begin + count - 1 + width) - low
    context = np.repeat(np.arange(len(new)), many)
    inside = smallest[np.arange(len(context)) + np.repeat(low - np.cumsum(many) + many, many)]
    same = np.bincount(context[hashes[inside] == value[context]], minlength=len(new))
    return first, begin - (ends - sizes)[first], count, value.view(np.int64), same > 1


def _digest(data: bytes) -> bytes:
    return xxhash.xxh3_128_digest(data)


def _longs(digests: list[bytes]) -> tuple[pa.Array, pa.Array]:
    two = np.frombuffer(b"".join(digests), ">i8").reshape(-1, 2).astype(np.int64)
    return pa.array(two[:, 0]), pa.array(two[:, 1])


class RunIndex:
    """A run-compressed Burrows-Wheeler transform of some texts, with the suffixes sampled at run ends."""

    CHARS = 7  # text bytes in one 63-bit word of 9 bits each; 0 is the end of a text

    def __init__(self, texts: list[bytes]):
        self.sizes = np.array([len(x) for x in texts], np.int64)
        self.stops = np.cumsum(self.sizes + 1) - 1  # place of each text's end mark
        self.starts = self.stops - self.sizes
        n = int(self.stops[-1]) + 1
        # Places and counts fit into 32 bits: an index holds a few megabytes.
        self.left = np.repeat(self.stops.astype(np.int32), self.sizes + 1) - np.arange(n, dtype=np.int32)  # bytes before the end mark
        data = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8).astype(np.int16) + np.int16(1)
        data[self.stops] = 0
        self.words = self._words(data, n)
        order = self._suffixes(n, int(self.sizes.max(initial=0)))
        before = data[order - 1].astype(np.int32)  # the transform
        first = np.zeros(n, bool)
        first[self.starts] = True
        before[first[order]] = -1 - np.arange(len(texts), dtype=np.int32)  # the end marks are all different
        heads = np.flatnonzero(np.r_[True, before[1:] != before[:-1]])
        self.chars = before[heads]
        self.head_suffix = order[heads]
        self.tail_suffix = order[np.r_[heads[1:], n] - 1]

    def _words(self, data: np.ndarray, n: int) -> np.ndarray:
        padded = np.concatenate([data, np.zeros(self.CHARS, data.dtype)])
        words = np.zeros(n, np.int64)
        for j in range(self.CHARS):
            words <<= 9
            words |= np.where(self.left >= j, padded[j : j + n], 0)
        return words

    def _suffixes(self, n: int, longest: int) -> np.ndarray:
        """Suffixes in order by prefix doubling; equal tails of texts in the order of the texts."""
        order = np.argsort(self.words).astype(np.int32)
        sorted_ = self.words[order]
        new = np.r_[True, sorted_[1:] != sorted_[:-1]]
        del sorted_
        rank = np.empty(n, np.int32)
        group = np.flatnonzero(new).astype(np.int32)
        rank[order] = np.repeat(group, np.diff(np.r_[group, n]))
        width = self.CHARS
        # Rows of groups with several suffixes, which go on being sorted.
        rows = np.flatnonzero(~(new & np.r_[new[1:], True]))
        while len(rows) and width <= longest:
            suffix = order[rows]
            far = suffix + width
            # Behind the end of its own text a suffix has nothing: the smallest rank.
            second = np.where(self.left[suffix] >= width, rank[np.minimum(far, n - 1)] + 1, 0)
            first = rank[suffix].astype(np.int64)
            # One sort: rows of a group stay in the group's own rows.
            pair = first * (n + 2) + second
            at = np.argsort(pair)
            suffix, pair, first = suffix[at], pair[at], first[at]
            order[rows] = suffix
            new = np.r_[True, pair[1:] != pair[:-1]]
            begin = np.flatnonzero(new)
            count = np.diff(np.r_[begin, len(rows)])
            rank[suffix] = np.repeat(rows[begin], count)
            rows = rows[np.repeat(count > 1, count)]
            width *= 2
        if len(rows):
            order[rows] = order[rows][np.argsort(rank[order[rows]].astype(np.int64) * n + order[rows])]
        return order

    def common(self, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
        """Bytes that the suffixes at a and b have in common, up to ``most``."""
        total = np.zeros(len(a), np.int64)
        alive = np.arange(len(a))
        n = len(self.words)
        while len(alive):
            x = self.words[np.minimum(a[alive] + total[alive], n - 1)]
            y = self.words[np.minimum(b[alive] + total[alive], n - 1)]
            differ = x ^ y
            same = np.zeros(len(alive), np.int64)
            for j in range(self.CHARS):
                same += (differ >> (9 * (self.CHARS - 1 - j))) == 0
            total[alive] += same
            alive = alive[(same == self.CHARS) & (total[alive] < np.minimum(most, np.minimum(self.left[a[alive]], self.left[b[alive]])))]
        return np.minimum(np.minimum(total, most), np.minimum(self.left[a], self.left[b]))

    def matching_statistics(self, most: int) -> np.ndarray:
        """For each place of the texts, how many bytes (up to ``most``) from there on occur elsewhere.

        A text is streamed from right to left. Within a run the transform's neighbour stays the neighbour, and the
        match grows by the byte that was read; only where the text passes a run's head (or tail) is the match counted
        anew, against the sampled end of the run of the same byte above (or below).
        """
        n = len(self.words)
        best, place = np.zeros(n, np.int32), np.arange(n, dtype=np.int32)
        order = np.argsort(self.chars, kind="stable")  # runs by byte, in their order
        for ends, others, step in ((self.head_suffix, self.tail_suffix, -1), (self.tail_suffix, self.head_suffix, 1)):
            partner = np.full(len(self.chars), -1, np.int64)
            near = order[1:], order[:-1]
            run, other = near if step < 0 else near[::-1]
            pair = self.chars[run] == self.chars[other]
            partner[run[pair]] = others[other[pair]] - 1
            # A reset at place p is found where suffix p + 1 ends a run; the last place of a text resets too.
            match = np.zeros(n, np.int32)
            reset = np.zeros(n, bool)
            reset[self.stops] = True
            has = ends > 0
            places = ends[has] - 1
            reset[places] = True
            found = partner[has]
            good = (found >= 0) & (self.chars[has] > 0)
            match[places[good]] = self.common(places[good], found[good], most)
            # Between resets each step to the left adds one byte.
            at = np.flatnonzero(reset).astype(np.int32)
            to = np.repeat(at, np.diff(np.r_[np.int32(-1), at]))
            np.maximum(best, np.minimum(match[to] + (to - place), most), out=best)
        return np.minimum(best, self.left)


def repeated_starts(texts: list[bytes], copies: list[int], length: int) -> list[np.ndarray]:
    """For each of some distinct texts (each standing so many times) the runs (start, end) of starts of
    ``length``-byte strings that stand more than once, as rows."""
    index = RunIndex(texts)
    repeated = index.matching_statistics(length) >= length
    out = []
    for start, size, n in zip(index.starts.tolist(), index.sizes.tolist(), copies):
        mine = repeated[start : start + size - length + 1]
        if n > 1:
            mine = np.ones(len(mine), bool)
        edge = np.flatnonzero(np.diff(np.r_[0, mine.view(np.int8), 0]))
        out.append(edge.reshape(-1, 2))
    return out


MARKS = "c1 long, c2 long, spans binary"


def _index_batches(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Marks of the contexts of a partition, sorted by key: whole keys are gathered up to an index's size, a key that
    has more has an index of its own."""
    held: list[tuple] = []
    size, last, whole, before = 0, None, 0, 0  # the first `whole` rows, of `before` bytes, are of other keys than the last
    names = ("key", "c1", "c2", "copies", "context")

    def marked(held: list[tuple]) -> pa.RecordBatch:
        spans = repeated_starts([x[4] for x in held], [x[3] for x in held], length)
        # Contexts that stand several times are repeated as a whole and need no marks.
        rows = [(x[1], x[2], s.astype("<i4").tobytes()) for x, s in zip(held, spans) if len(s) and x[3] == 1]
        columns = zip(*rows) if rows else ((), (), ())
        kinds = (pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["c1", "c2", "spans"])

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in names)):
            if row[0] != last:
                whole, before, last = len(held), size, row[0]
            if whole and size + len(row[4]) > INDEX_BYTES:
                yield marked(held[:whole])
                held, size, whole, before = held[whole:], size - before, 0, 0
            held.append(row)
            size += len(row[4])
    if held:
        yield marked(held)


def repeated_spans(docs: DataFrame, length: int) -> DataFrame:
    """(r1, r2, spans): for each row of ``docs`` (r1, r2, data) with repeats, the strings that stand more than once,
    as a list of (at, starts, spans) of its contexts; null spans are all of the context's string starts."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, "data", TOGETHER):
                texts = [x.as_py() for x in part.column("data")]
                text, at, count, key, own = contexts_of(texts, length)
                stops = at + count - 1 + length
                digests = [_digest(texts[t][a:b]) for t, a, b in zip(text.tolist(), at.tolist(), stops.tolist())]
                rows = part.select(["r1", "r2"]).take(pa.array(text))
                columns = [*rows.columns, pa.array(at), pa.array(count), pa.array(key), pa.array(own), *_longs(digests)]
                yield pa.RecordBatch.from_arrays(columns, names=["r1", "r2", "at", "starts", "key", "own", "c1", "c2"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                wanted = row["wanted"]
                pieces = [row["data"][w["at"] : w["at"] + w["starts"] - 1 + length] for w in wanted]
                columns = [pa.array([w[c] for w in wanted], pa.int64()) for c in ("key", "c1", "c2", "copies")]
                large = pa.array([w["large"] for w in wanted], pa.bool_())
                names = ["key", "c1", "c2", "copies", "large", "context"]
                yield pa.RecordBatch.from_arrays([*columns, large, pa.array(pieces, pa.binary())], names=names)

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c1, c2, copies, text in zip(*(batch.column(c).to_pylist() for c in ("c1", "c2", "copies", "context"))):
                n = len(text) - length + 1
                w1, w2 = _longs([_digest(text[i : i + length]) for i in range(n)])
                columns = [pa.array([v] * n, pa.int64()) for v in (c1, c2, copies)]
                start = pa.array(np.arange(n, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([*columns, start, w1, w2], names=["c1", "c2", "copies", "start", "w1", "w2"])

    every = materialize(docs.mapInArrow(find, "r1 long, r2 long, at long, starts long, key long, own boolean, c1 long, c2 long"))
    again = every.groupBy("key").agg(F.count("*").alias("n"), F.max("own").alias("own")).where("n > 1 or own").select("key")
    again = materialize(again)  # stored, so that both sides of the join are plain shuffles, which Spark can split
    found = materialize(every.join(again, "key", "left_semi").drop("own"))
    discard(every, again)
    distinct = materialize(
        found.groupBy("key", "c1", "c2").agg(
            F.count("*").alias("copies"), F.min(F.struct("r1", "r2", "at", "starts")).alias("place")
        )
    )
    # Few keys are large; where all contexts stand several times, all strings are repeated, and no text is needed.
    size, least = F.sum(F.col("place.starts") + (length - 1)), F.min("copies")
    kinds = distinct.groupBy("key").agg((size > 4 * INDEX_BYTES).alias("large"), (least > 1).alias("settled"))
    kinds = materialize(kinds.where("large or settled"))
    wanted = distinct.join(kinds, "key", "left").where("settled is null or not settled")
    wanted = wanted.select("place.*", "key", "c1", "c2", "copies", F.coalesce("large", F.lit(False)).alias("large"))
    wanted = wanted.groupBy("r1", "r2").agg(F.collect_list(F.struct("at", "starts", "key", "c1", "c2", "copies", "large")).alias("wanted"))
    texts = docs.join(wanted, ["r1", "r2"]).select("data", "wanted")
    texts = texts.mapInArrow(cut, "key long, c1 long, c2 long, copies long, large boolean, context binary")
    texts = materialize(texts)
    indexed = texts.where("not large").select("key", "c1", "c2", "copies", "context")
    indexed = indexed.repartition("key").sortWithinPartitions("key")
    marks = indexed.mapInArrow(lambda batches: _index_batches(batches, length), MARKS)
    # Keys with very many distinct contexts: each string by its own digest.
    single = texts.where("large").dropDuplicates(["c1", "c2"]).mapInArrow(
        strings, "c1 long, c2 long, copies long, start int, w1 long, w2 long"
    )
    often = single.groupBy("w1", "w2").agg(F.sum("copies").alias("n")).where("n > 1").select("w1", "w2")
    hits = single.where("copies = 1").join(often, ["w1", "w2"], "left_semi").groupBy("c1", "c2").agg(F.collect_set("start").alias("at"))
    hits = hits.mapInArrow(_runs, MARKS)
    whole = distinct.where("copies > 1").select("c1", "c2", F.lit(None).cast("binary").alias("spans"))
    marks = materialize(marks.unionByName(hits).unionByName(whole))
    discard(distinct, kinds, texts)
    spans = found.join(marks, ["c1", "c2"]).select("r1", "r2", F.struct("at", "starts", "spans").alias("span"))
    return spans.groupBy("r1", "r2").agg(F.collect_set("span").alias("spans"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets of starts as runs (start, end)."""
    for batch in batches:
        spans = []
        for x in batch.column("at").to_pylist():
            at = np.sort(np.array(x, np.int64))
            first = np.flatnonzero(np.r_[True, at[1:] != at[:-1] + 1])
            last = np.r_[first[1:], len(at)] - 1
            spans.append(np.stack([at[first], at[last] + 1], axis=1).astype("<i4").tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("c1"), batch.column("c2"), pa.array(spans, pa.binary())], names=["c1", "c2", "spans"])


def removed_runs(spans: list[dict] | None, length: int) -> np.ndarray:
    """Maximal runs (start, end) of bytes covered by repeated strings, from the marks of a document's contexts."""
    if not spans:
        return np.empty((0, 2), np.int64)
    # No marks: all strings of the context are repeated.
    marks = [np.array([0, s["starts"]], "<i4") if s["spans"] is None else np.frombuffer(s["spans"], "<i4") for s in spans]
    rows = np.concatenate([m.reshape(-1, 2).astype(np.int64) + s["at"] for m, s in zip(marks, spans)])
    rows = rows[np.argsort(rows[:, 0], kind="stable")]
    rows[:, 1] += length - 1
    reach = np.maximum.accumulate(rows[:, 1])
    first = np.flatnonzero(np.r_[True, rows[1:, 0] > reach[:-1]])
    return np.stack([rows[first, 0], reach[np.r_[first[1:], len(rows)] - 1]], axis=1)


REMOVED = "n_bytes long, n_removed long, n_spans long, kept binary, removed binary"


def remove_repeats(
    docs: DataFrame, length: int = 400, keep: tuple[str, ...] = (), whole_characters: bool = False
) -> DataFrame:
    """Whole texts as UTF-8 bytes without those covered by a ``length``-byte string that starts anywhere else too.

    Result, a row for each row of ``docs``: doc_id, the ``keep`` columns, n_bytes, n_removed, n_spans (maximal removed runs),
    kept (the remaining bytes), removed (the runs as pairs of little-endian 64-bit integers: start, end). Every copy is
    removed, the first one too; strings may overlap, may stand in the same document, and never cross documents; they are
    judged on the input. With ``whole_characters`` a run gives up a character at its edge of which it does not cover
    all bytes, so the remaining bytes are text.

    Defined cases: a null text is empty; texts shorter than ``length`` stay whole; a row that repeats is a document of its
    own, so its strings of ``length`` bytes stand more than once; an empty table gives an empty result; other columns
    play no part.

    At scale: keys and digests are shuffled, a few for each ``length`` bytes; of text, one representative of each
    distinct context whose key occurs again, and each document twice, by its row. An index holds a bounded number of
    bytes; a key with more (a passage in very many different documents) is settled by the digests of its strings.
    """
    docs = pick(docs, "doc_id", "text", *keep).withColumn("text", F.coalesce("text", F.lit("")))
    docs = docs.select(
        F.col("doc_id").cast("long"), *keep, F.col("text").cast("binary").alias("data"),
        F.xxhash64("doc_id", "text").alias("r1"), F.xxhash64(F.lit("row"), "text", "doc_id").alias("r2"),
    )
    spans = repeated_spans(docs.select("r1", "r2", "data"), length)
    names = ["doc_id", *keep]

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, "data", 8 * TOGETHER):
                both = zip(*(part.column(c).to_pylist() for c in ("data", "spans")))
                rows = [_without(data, removed_runs(found, length), whole_characters) for data, found in both]
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                given = [part.column(c) for c in names]
                yield pa.RecordBatch.from_arrays(given + columns, names=[*names, *("n_bytes n_removed n_spans kept removed".split())])

    joined = docs.join(spans, ["r1", "r2"], "left").select(*names, "data", "spans")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in joined.select(*names).schema.fields)
    return joined.mapInArrow(remove, f"{ddl}, {REMOVED}")


def _without(data: bytes, runs: np.ndarray, whole_characters: bool) -> tuple:
    if whole_characters and len(runs):
        runs = _aligned(data, runs)
    kept, at = [], 0
    for a, b in runs.tolist():
        kept.append(data[at:a])
        at = b
    kept.append(data[at:])
    return len(data), int((runs[:, 1] - runs[:, 0]).sum()), len(runs), b"".join(kept), runs.astype("<i8").tobytes()


def _aligned(data: bytes, runs: np.ndarray) -> np.ndarray:
    """Runs that begin and end between characters, within the given ones."""
    out = []
    for a, b in runs.tolist():
        while a < b and data[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(data) and data[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return np.array(out, np.int64).reshape(-1, 2)


def repeats_report(docs: DataFrame, length: int = 400) -> DataFrame:
    """doc_id, n_bytes (of the whole text), n_removed, n_spans, kept_sha256 of :func:`remove_repeats`, and text, what remains;
    as strings begin and end at any byte, bytes of a cut character stand there as U+FFFD."""
    out = remove_repeats(docs, length)
    text = F.make_valid_utf8(F.col("kept").cast("string"))
    return out.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), text.alias("text")
    )
