"""Periodic run detection by online dyadic square catching.

A square of period p, of which 2 * B <= p < 4 * B for a power of two B, holds a block of B words that begins at a multiple of B in
its first half. When such a block is complete, a catcher waits for its content to come again at a distance from 2 * B
to below 4 * B; as words are appended, the newest B words are compared with the catchers whose distance they have.
Where successive blocks are caught at one distance, the words are compared one by one to both sides: the squares found merge into
maximal runs, and an open run goes on with the next words.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import parts, pick

#: Words that are appended together.
CHUNK = 1 << 16
#: Bytes of documents handled together.
TOGETHER = 2 << 20
#: Remembered words in each task.
REMEMBERED = 500_000
_BASE = np.uint64(0x9E3779B97F4A7C15)


class SquareCatchers:
    """Runs of a growing sequence of whole numbers: at least ``least`` long and ``exponent`` (3 or more) times their period."""

    def __init__(self, least: int = 24, exponent: int = 3, room: int = 1024):
        self.least, self.exponent = least, exponent
        self.n = 0
        self.words = np.zeros(room, np.int64)
        self.prefix = np.zeros(room + 1, np.uint64)  # hash of the words before each place
        self.power = np.cumprod(np.r_[np.uint64(1), np.full(room, _BASE)], dtype=np.uint64)
        self.caught: list[int] = []  # by level: words whose catchers have been asked
        self.runs: dict[tuple[int, int], int] = {}  # (start, period): end
        self.open: set[tuple[int, int]] = set()  # the runs that reach the last word
        self.closed: list[tuple[int, int, int]] = []  # (end, start, period) of the others, in order

    def append(self, words: np.ndarray) -> None:
        """Take more words; a level looks at them once they complete a block of its own."""
        old, self.n = self.n, self.n + len(words)
        self._grow(old, words)
        for start, period in list(self.open):
            self._keep(start, old + self._forward(old - period, old), period)
        self._catch(last=False)

    def finish(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of all runs, by start, then period."""
        self._catch(last=True)
        least: dict[tuple[int, int], int] = {}
        # A run of period p is one of 2 * p and so on too, over the same words: the smallest period names it.
        for (start, period), end in self.runs.items():
            least[start, end] = min(period, least.get((start, end), period))
        return sorted((a, b - a, p) for (a, b), p in least.items() if b - a >= self._need(p))

    def _keep(self, start: int, end: int, period: int) -> None:
        key = start, period
        if end == self.n:
            self.open.add(key)
        elif self.runs.get(key, -1) < end or key in self.open:
            self.open.discard(key)
            insort(self.closed, (end, *key))
        self.runs[key] = end

    def _need(self, period: int) -> int:
        return max(self.least, self.exponent * period)

    def _grow(self, old: int, words: np.ndarray) -> None:
        n = self.n
        if n > len(self.words):
            room = max(n, 2 * len(self.words))
            self.words = np.concatenate([self.words, np.zeros(room - len(self.words), np.int64)])
            self.prefix = np.concatenate([self.prefix, np.zeros(room + 1 - len(self.prefix), np.uint64)])
            more = np.full(room + 1 - len(self.power), _BASE, np.uint64)
            self.power = np.concatenate([self.power, self.power[-1] * np.cumprod(more, dtype=np.uint64)])
        self.words[old:n] = words
        # The hash of words[a:b] is prefix[b] - prefix[a], up to the factor power[a]; all of it wraps at 2^64.
        mixed = words.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(29)
        self.prefix[old + 1 : n + 1] = self.prefix[old] + np.cumsum(mixed * self.power[old:n], dtype=np.uint64)

    def _catch(self, last: bool) -> None:
        level = 0
        # The shortest period of a level has to fit ``exponent`` times.
        while (size := 1 << level) and self.exponent * (1 if level == 0 else 2 * size) <= self.n:
            if level == len(self.caught):
                self.caught.append(0)
            done = self.caught[level]
            if self.n - done >= size or (last and self.n > done):
                # A run may have begun up to four blocks before the words that are new.
                self._level(size, max(0, done - 5 * size))
                self.caught[level] = self.n
            level += 1

    def _level(self, size: int, begin: int) -> None:
        """Runs of periods from 2 * ``size`` (or 1) to below 4 * ``size`` that the words from ``begin`` on belong to."""
        n, prefix = self.n, self.prefix
        # Words that equal those a period before lie, but for the edges, in so many whole blocks at least.
        low, high = (1, 3) if size == 1 else (2 * size, 4 * size - 1)
        blocks = -(-(max(self.least - high, (self.exponent - 1) * low) - 2 * (size - 1)) // size)
        places, periods = [], []
        for back in (2, 3) if size > 1 else (1, 2, 3):
            first = max(0, begin // size - back)  # the first catcher's block
            start = (first + back) * size
            m = n - size + 1 - start
            if m <= 0:
                continue
            stop = first - (-m // size)
            own = prefix[first * size + size : stop * size + 1 : size] - prefix[first * size : stop * size : size]
            sought = (own[:, None] * self.power[back * size : back * size + size]).ravel()[:m]
            hit = prefix[start + size : start + size + m] - prefix[start : start + m] == sought
            row, steps = hit, 1
            while 2 * steps <= blocks and len(row):
                row, steps = row[: -steps * size] & row[steps * size :], 2 * steps
            if row.any():
                at = np.flatnonzero(hit)
                places.append(at + start)
                periods.append(back * size + at % size)
        if places:
            for start, end, p in self._long(np.concatenate(places), np.concatenate(periods), size):
                self._settle(start, end, p)

    def _long(self, at: np.ndarray, period: np.ndarray, size: int) -> list[tuple[int, int, int]]:
        """(start, end, period) of hits in successive blocks at one distance that may belong to a run not known yet."""
        known = self._known(at, period, size)
        at, period = at[~known], period[~known]
        order = np.lexsort((at, period))
        at, period = at[order], period[order]
        first = np.flatnonzero(np.r_[True, (at[1:] != at[:-1] + size) | (period[1:] != period[:-1])]) if len(at) else np.empty(0, int)
        stop = np.r_[first[1:], len(at)] if len(at) else first
        start, end, p = at[first], at[stop - 1] + size, period[first]
        needed = np.maximum(self.least, self.exponent * p) - p - 2 * (size - 1)
        good = end - start >= needed
        return list(zip(start[good].tolist(), end[good].tolist(), p[good].tolist()))

    def _known(self, at: np.ndarray, period: np.ndarray, size: int) -> np.ndarray:
        """Which hits lie within a run that is known already and whose period divides their distance."""
        if not len(at) or not self.runs:
            return np.zeros(len(at), bool)
        low = max(0, int(at.min()) - 4 * size)
        near = self.closed[bisect_left(self.closed, (low,)) :] + [(self.runs[k], *k) for k in self.open]
        near.sort(key=lambda x: (x[0] - x[1], -x[2]))
        end, start, p = np.array([*near, (0, 0, 1)]).T
        longest = np.full(self.n - low, len(near), np.int32)  # the longest known run at each word, of the smallest period
        for i, (b, a, _) in enumerate(near):
            longest[max(0, a - low) : b - low] = i
        own = longest[at - low]
        return (at - period >= start[own]) & (at + size <= end[own]) & (period % p[own] == 0)

    def _settle(self, start: int, end: int, p: int) -> None:
        """Compare the words themselves and keep the run, if it is one."""
        w = self.words
        same = w[start:end] == w[start - p : end - p]
        edge = np.flatnonzero(np.diff(np.r_[0, same.view(np.int8), 0])).reshape(-1, 2) + start
        for a, b in edge.tolist():
            if a == start:
                a -= self._back(a - p, a)
            if b == end:
                b += self._forward(b - p, b)
            if b - a + p >= self._need(p):
                self._keep(a - p, b, p)

    def _forward(self, a: int, b: int) -> int:
        """How many words from a and b (a < b) on are the same."""
        w, n, step, total = self.words, self.n, 64, 0
        while b + total < n:
            m = min(step, n - b - total)
            differ = w[a + total : a + total + m] != w[b + total : b + total + m]
            if differ.any():
                return total + int(differ.argmax())
            total, step = total + m, min(2 * step, CHUNK)
        return total

    def _back(self, a: int, b: int) -> int:
        """How many words before a and b (a < b) are the same."""
        w, step, total = self.words, 64, 0
        while a - total > 0:
            m = min(step, a - total)
            differ = w[a - total - m : a - total] != w[b - total - m : b - total]
            if differ.any():
                return total + int(differ[::-1].argmax())
            total, step = total + m, min(2 * step, CHUNK)
        return total


def find_runs(words: np.ndarray, least: int = 24, exponent: int = 3) -> list[tuple[int, int, int]]:
    """(start, length, period) of the maximal runs of a sequence, by start, then period."""
    if len(words) < least:
        return []
    catchers = SquareCatchers(least, exponent, len(words))
    for at in range(0, len(words), CHUNK):
        catchers.append(words[at : at + CHUNK])
    return catchers.finish()


def dropped(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words stand in a run after its first period."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:n]) > 0


class _Numbers(dict):
    """A number for each word."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def periodic_runs(docs: DataFrame, least: int = 24, exponent: int = 3) -> DataFrame:
    """The periodic runs of whole texts, and the texts with every run cut to its first period.

    Words are what stands between ASCII white space, numbered from 0. A run is a stretch of words with smallest period
    ``period`` (words that far apart are the same), at least ``least`` words and ``exponent`` (3 or more) periods long, which neither
    neighbouring word extends. Result, a row for each row of ``docs``: doc_id, n_words, runs (start, length, period; by start, then
    period), collapsed (the words that no run contains after its first period, joined by one space).

    Defined cases: null, empty and blank texts have no words, no runs and an empty ``collapsed``; words are compared as they stand;
    a null doc_id is kept; rows that repeat come back as often as they went in; an empty table gives an empty result; other
    columns play no part.

    At scale: narrow map work without a shuffle. A document takes time n * log(n) in its words whatever they repeat, and
    memory in proportion to its own length.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = _Numbers()
        for batch in batches:
            for part in parts(batch, "text", TOGETHER):
                rows = []
                if len(numbers) > REMEMBERED:
                    numbers.clear()
                for text in part.column("text"):
                    words = (text.as_py() or "").encode().split()
                    runs = find_runs(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)), least, exponent)
                    if runs:
                        gone = dropped(len(words), runs)
                        kept = [w for w, g in zip(words, gone.tolist()) if not g]
                    else:
                        kept = words
                    rows.append((len(words), [dict(zip(("start", "length", "period"), r)) for r in runs], b" ".join(kept).decode()))
                kinds = (pa.int64(), pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])), pa.string())
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names=["doc_id", "n_words", "runs", "collapsed"])

    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(find, f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def runs_report(found: DataFrame) -> DataFrame:
    """Digests of :func:`periodic_runs`: doc_id, n_runs, the run of the greatest exact length / period (of equal ones the first),
    exponent_milli, runs_sha256 (lines ``start,length,period``), collapsed_sha256."""
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    # Runs stand in order, so a later one wins only if it is really greater; products of words fit a decimal.
    wide = lambda x: x.cast("decimal(19,0)")
    greater = lambda a, r: wide(r["length"]) * wide(a["period"]) > wide(a["length"]) * wide(r["period"])
    best = F.aggregate("runs", none, lambda a, r: F.when(a.isNull() | greater(a, r), r).otherwise(a))
    line = lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")])
    lines = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    top = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), lines.alias("lines"), "collapsed")
    milli = F.expr("best.length * 1000 div best.period")
    return top.select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period", milli.alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text), a tenth of them with periodic ends: with h the crc32 of the decimal doc_id and g = h div 10, of n words
    those from a = g % n on become the words a + (i - a) % p, p = 1 + (n - a) div (3 + g % 8), if h % 10 is 0."""
    docs = pick(docs, "doc_id", "text").withColumn("h", F.crc32(F.col("doc_id").cast("string").cast("binary")))
    words: Column = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    chosen = docs.withColumn("words", F.when(F.col("h") % 10 == 0, words))
    places = chosen.withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, F.expr("(h div 10) % n")))
    places = places.withColumn("p", F.expr("1 + (n - a) div (3 + (h div 10) % 8)"))
    planted = F.expr("concat(slice(words, 1, int(a)), transform(sequence(a, n - 1L), i -> words[int(a + (i - a) % p)]))")
    text = F.when(F.col("n") > 0, F.array_join(planted, " ")).otherwise(F.col("text"))
    return places.select("doc_id", text.alias("text"))
