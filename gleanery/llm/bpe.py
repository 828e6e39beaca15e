"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

The tokens of a pre-token form a linked list. Every merge rank has a bucket of list positions, and a bitmap of
three levels (64 bits a word) marks the buckets that are not empty: find-first-set from the top gives
the next rank in constant time, however long the pre-token. Entries that a merge made stale are skipped when they
come up.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from .common import gathered, pick

#: Remembered pre-tokens in each Python worker; beyond that, only those of the last texts stay.
REMEMBERED = 400_000
#: Pre-tokens up to this many bytes are encoded many at a time; longer ones alone, and not remembered.
SHORT = 64
#: Bytes of text that are encoded together, over several batches.
TOGETHER = 8 << 20


class RankQueue:
    """Ranks with a bucket of list positions each; ``first`` gives the lowest rank that has a bucket."""

    def __init__(self, ranks: int):
        self.buckets: dict[int, list] = {}
        self.low = [0] * ((ranks >> 6) + 1)
        self.middle = [0] * ((ranks >> 12) + 1)
        self.top = 0

    def bucket(self, rank: int) -> list:
        """The bucket of a rank, which is marked as not empty."""
        found = self.buckets.get(rank)
        if found is None:
            found = self.buckets[rank] = []
            word = rank >> 6
            self.low[word] |= 1 << (rank & 63)
            self.middle[word >> 6] |= 1 << (word & 63)
            self.top |= 1 << (word >> 6)
        return found

    def first(self) -> int:
        """The lowest rank with a bucket, by find-first-set on three levels; -1 if there is none."""
        top = self.top
        if not top:
            return -1
        high = (top & -top).bit_length() - 1
        bits = self.middle[high]
        word = (high << 6) + (bits & -bits).bit_length() - 1
        bits = self.low[word]
        return (word << 6) + (bits & -bits).bit_length() - 1

    def remove(self, rank: int) -> list:
        """Take a rank's bucket out of the queue."""
        word = rank >> 6
        self.low[word] &= ~(1 << (rank & 63))
        if not self.low[word]:
            self.middle[word >> 6] &= ~(1 << (word & 63))
            if not self.middle[word >> 6]:
                self.top &= ~(1 << (word >> 6))
        return self.buckets.pop(rank)


class Codec:
    """Encoder and decoder for a rank file: a token's id is its merge rank."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.size = max(ranks.values()) + 1
        self.tokens: list[bytes] = [b""] * self.size
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        # Every way to cut a token into two tokens; the last key is no pair and ends searches.
        pairs = [
            (ranks[token[:i]] * self.size + ranks[token[i:]], rank)
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        ]
        self.pair_of = dict(pairs)
        keys = np.array([k for k, _ in pairs] + [self.size**2], np.int64)
        order = np.argsort(keys)
        self.keys, self.values = keys[order], np.array([r for _, r in pairs] + [-1], np.int64)[order]
        self.words: dict[str, bytes] = {}

    def merge(self, word: bytes) -> list[int]:
        """Ids of one pre-token of any length: always the leftmost pair of the lowest rank is merged."""
        pair, size, queue = self.pair_of.get, self.size, RankQueue(self.size)
        token = self.single[np.frombuffer(word, np.uint8)].tolist()
        n = len(token)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        for i in range(n - 1):
            rank = pair(token[i] * size + token[i + 1])
            if rank is not None:
                queue.bucket(rank).append(i)  # in order, so each bucket is a heap
        while (rank := queue.first()) >= 0:
            bucket = queue.buckets[rank]
            i = heappop(bucket)
            if not bucket:
                queue.remove(rank)
            j = after[i]
            # A position whose token is gone (-1), or whose pair changed, is a stale entry.
            if token[i] < 0 or j >= n or pair(token[i] * size + token[j]) != rank:
                continue
            token[i], token[j] = rank, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                new = pair(rank * size + token[k])
                if new is not None:
                    heappush(queue.bucket(new), i)
            h = before[i]
            if h >= 0:
                new = pair(token[h] * size + rank)
                if new is not None:
                    heappush(queue.bucket(new), h)
        return [t for t in token if t >= 0]

    def _lookup(self, keys: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys, keys)
        return np.where(self.keys[at] == keys, self.values[at], -1)

    def merge_many(self, words: list[bytes]) -> list[bytes]:
        """Ids of many short pre-tokens, little-endian unsigned 32-bit, all through one queue.

        The linked lists of all pre-tokens lie behind one another. When a rank comes up, the leftmost
        entry of each pre-token is merged at once; its further entries wait for the next turn, so every
        pre-token sees its own merges in the order of :meth:`merge`.
        """
        sizes = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(sizes)
        token = self.single[np.frombuffer(b"".join(words), np.uint8)]
        n = len(token)
        owner = np.repeat(np.arange(len(words)), sizes)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[ends - 1] = -1
        before[ends - sizes] = -1
        rank_at = np.full(n, -1, np.int64)  # rank of the pair that begins here; an entry of another rank is stale
        begin = np.flatnonzero(after >= 0)
        rank_at[begin] = self._lookup(token[begin] * self.size + token[begin + 1])
        queue = RankQueue(self.size)
        self._push(queue, begin, rank_at[begin])
        while (rank := queue.first()) >= 0:
            found = queue.remove(rank)
            at = found[0] if len(found) == 1 else np.unique(np.concatenate(found))
            at = at[rank_at[at] == rank]
            if not len(at):
                continue
            if len(at) > 1:
                own = owner[at]
                later = np.flatnonzero(own[1:] == own[:-1]) + 1
                if len(later):
                    queue.bucket(rank).append(at[later])
                    at = np.delete(at, later)
            gone = after[at]
            right = after[gone]
            token[at], token[gone] = rank, -1
            rank_at[at] = rank_at[gone] = -1
            after[at] = right
            has_right, left = right >= 0, before[at]
            before[right[has_right]] = at[has_right]
            has_left = left >= 0
            begin = np.concatenate([at[has_right], left[has_left]])
            new = self._lookup(token[begin] * self.size + token[after[begin]])
            rank_at[begin] = new
            self._push(queue, begin, new)
        kept = token >= 0
        data = token[kept].astype("<u4").tobytes()
        stops = (4 * np.cumsum(kept)[ends - 1]).tolist()
        return [data[a:b] for a, b in zip([0, *stops], stops)]

    @staticmethod
    def _push(queue: RankQueue, at: np.ndarray, ranks: np.ndarray) -> None:
        good = ranks >= 0
        at, ranks = at[good], ranks[good]
        if len(at) <= 4:
            for i, r in enumerate(ranks.tolist()):
                queue.bucket(r).append(at[i : i + 1])
            return
        order = np.lexsort((at, ranks))
        at, ranks = at[order], ranks[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        for r, part in zip(ranks[np.r_[0, cuts]].tolist(), np.split(at, cuts)):
            queue.bucket(r).append(part)

    def _learn(self, words: set[str]) -> None:
        """Encode pre-tokens that are not remembered."""
        short = []
        for word in words:
            data = word.encode()
            whole = self.ranks.get(data)
            if whole is not None:
                self.words[word] = whole.to_bytes(4, "little")
            elif len(data) <= SHORT:
                short.append((word, data))
            else:
                self.words[word] = np.array(self.merge(data), "<u4").tobytes()
        if short:
            self.words.update(zip([w for w, _ in short], self.merge_many([d for _, d in short])))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        cut = [self.pattern.findall(x) for x in texts]
        seen = set().union(*cut)
        missing = seen.difference(self.words)
        self._learn(missing)
        out = [b"".join(map(self.words.__getitem__, x)) for x in cut]
        if len(self.words) > REMEMBERED:
            self.words = {w: self.words[w] for w in seen if len(w) <= SHORT}
        for word in missing:
            if len(word) > SHORT:
                self.words.pop(word, None)
        return out

    def decode(self, ids: bytes) -> bytes:
        """The bytes of little-endian unsigned 32-bit ids."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of the token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """The codec of a rank file, once for each Python worker."""
    return Codec(load_ranks(path), pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``ids``, the token ids of whole texts (little-endian unsigned 32-bit), and ``decoded``, their bytes.

    ``path`` names a rank file that every executor has; ``pattern`` cuts text into pre-tokens, each encoded on its
    own. Result: doc_id, ids, decoded for each row of ``docs``.

    Defined cases: a null or empty text has no ids; there are no special tokens, their strings are ordinary text;
    repeated rows come back as often as they went in; an empty table gives an empty result; other columns play no part.
    Narrow map work: no shuffle; the memory of a task is an Arrow batch and bounded caches.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for part in gathered(batches, "text", TOGETHER):
            ids = own.encode([x or "" for x in part.column("text").to_pylist()])
            columns = [part.column("doc_id"), pa.array(ids, pa.binary()), pa.array(map(own.decode, ids), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"])

    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(encode, "doc_id long, ids binary, decoded binary")


def encode_report(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: what :func:`encode_documents` gives, digested where it is made."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for part in gathered(batches, "text", TOGETHER):
            ids = own.encode([x or "" for x in part.column("text").to_pylist()])
            columns = [
                part.column("doc_id"),
                pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                pa.array([hashlib.sha256(own.decode(x)).hexdigest() for x in ids], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
