"""Best-fit packing with certified bin counts.

Documents are tokenized, cut into pieces of at most the capacity, and packed by best-fit decreasing within
partitions of bounded size. Lower bounds from dual-feasible functions tell how many bins a partition needs at
least: where best-fit decreasing reaches the bound, the partition is certified and done. Partitions with a gap give
the documents of their emptiest bins away; these meet documents of other partitions and are packed again.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import materialize, parts, pick

#: Remembered words in each Python worker.
REMEMBERED = 250_000
#: Punctuation that is looked up apart from the word it ends.
MARKS = ".,;:!?"
TOGETHER = 4 << 20
#: Pieces packed by one task.
GROUP = 32_768
#: Texts of these characters need no normal form beyond lower case: ASCII and Latin letters that are composed.
_PLAIN = re.compile(r"[\t\n\r -~\xa0-įĲ-ɏ]*")


class _Bytes(dict):
    """The letters that stand for the bytes of a character in the tokenizer's vocabulary."""

    def __init__(self):
        from tokenizers.pre_tokenizers import ByteLevel

        self.level = ByteLevel(add_prefix_space=False, use_regex=False)

    def __missing__(self, char: int) -> str:
        self[char] = found = self.level.pre_tokenize_str(chr(char))[0][0]
        return found


class _Words(dict):
    """Ids of lower-case words between white space, remembered."""

    def __init__(self, tokenizer):
        self.tokenizer, self.tokenize, self.bytes = tokenizer, tokenizer.model.tokenize, _Bytes()

    def __missing__(self, word: str) -> bytes:
        if word.isalpha():  # one run of letters: straight to the tokenizer's merges
            ids = [t.id for t in self.tokenize(word if word.isascii() else word.translate(self.bytes))]
            found = np.array(ids, "<u4").tobytes()
        elif word[-1] in MARKS and word[:-1].isalpha():  # a mark behind letters is a run of its own
            found = self[word[:-1]] + self[word[-1]]
        else:
            found = np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        if len(self) > REMEMBERED:
            self.clear()
        if len(word) <= 100:
            self[word] = found
        return found


class Tokens:
    """Ids of whole texts by a tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words = _Words(self.tokenizer)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers, as the tokenizer gives them for the whole text.

        White space never lies within a token of this tokenizer, so plain texts are encoded word by word. Texts with
        other characters (which may need composition) or with a special token go to the tokenizer as a whole.
        """
        if _PLAIN.fullmatch(text) and not any(s in text for s in self.special):
            return b"".join(map(self.words.__getitem__, text.lower().split()))
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@lru_cache(maxsize=2)
def tokens(path: str) -> Tokens:
    """The tokenizer of a file, once for each Python worker."""
    return Tokens(path)


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """The pieces of whole documents: doc_id, piece, start, length, ids_crc32.

    A document is its ids and ``end_id``; only documents longer than ``capacity`` are cut.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, end = tokens(path), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for part in parts(batch, "text", TOGETHER):
                rows = []
                names = part.column("doc_id").to_pylist()
                for name, text in zip(names, part.column("text")):
                    ids = own.encode(text.as_py() or "") + end
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        piece = ids[at : at + 4 * capacity]
                        rows.append((name, k, at // 4, len(piece) // 4, zlib.crc32(piece)))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """Bins that items of these sizes need at least, by dual-feasible functions.

    A dual-feasible function never maps a set that fits one bin to more than one, so the rounded-up sum of
    the images is a bound. Tried are the identity, the functions that raise sizes over C - e to a bin and drop
    those under e, and the rounding functions floor((k + 1) x) / k, for all e and for k up to 20.
    """
    if not len(sizes):
        return 0
    count = np.bincount(sizes, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1)
    best = -(-int((count * size).sum()) // capacity)
    # e from 1 to C / 2: bins for the sizes over C - e, and the total of those from e to C - e.
    over, total = np.cumsum(count[::-1])[::-1], np.cumsum(count * size)
    e = np.arange(1, capacity // 2 + 1)
    big = np.concatenate([over, [0]])[capacity - e + 1]
    middle = np.maximum(total[capacity - e] - total[e - 1], 0)
    best = max(best, int((big - (-middle // capacity)).max()))
    for k in range(1, 21):
        whole = (k + 1) * size % capacity == 0
        # In units of 1 / (k C): exact whole numbers.
        image = np.where(whole, size * k, (k + 1) * size // capacity * capacity)
        best = max(best, -(-int((count * image).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of each item and the fill of each bin.

    Open bins are kept by free room; a bitmap of the rooms in use gives the tightest bin by find-first-set.
    """
    order = np.argsort(-sizes, kind="stable")
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    used, fill = 0, []
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    for i, size in zip(order.tolist(), sizes[order].tolist()):
        fitting = used >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            bin_ = rooms[room].pop()
            if not rooms[room]:
                used &= ~(1 << room)
        else:
            room, bin_ = capacity, len(fill)
            fill.append(0)
        bins[i], offsets[i] = bin_, fill[bin_]
        fill[bin_] += size
        if room > size:
            rooms[room - size].append(bin_)
            used |= 1 << (room - size)
    return bins, offsets, np.array(fill, np.int64)


PACKED = "item long, sequence_id long, offset long, given boolean"


def _pack(table: pa.Table, capacity: int) -> pa.Table:
    """Pack one partition; where the bound is not reached, mark the items of the emptiest bins.

    A bin is named by its smallest item, so names are unique across partitions and rounds.
    """
    item, sizes = table["item"].to_numpy(), table["length"].to_numpy()
    at = np.argsort(item)
    item, sizes = item[at], sizes[at]
    bins, offsets, fill = best_fit_decreasing(sizes, capacity)
    gap = len(fill) - lower_bound(sizes, capacity)
    given = np.zeros(len(fill), bool)
    if gap:
        # Only bins with room can be packed better; the emptiest are given away.
        given[np.argsort(fill, kind="stable")[: max(16, 8 * gap, len(fill) // 20)]] = True
        given &= fill < capacity
    name = np.empty(len(fill), np.int64)
    name[bins[::-1]] = item[::-1]
    columns = [item, name[bins], offsets, given[bins]]
    return pa.Table.from_arrays([pa.array(c) for c in columns], names=["item", "sequence_id", "offset", "given"])


def best_fit_packing(
    docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, group: int = GROUP, rounds: int = 4
) -> DataFrame:
    """Pack whole documents into sequences of at most ``capacity`` tokens.

    Result, a row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Defined cases: a null or empty text is the end id alone; rows that repeat are documents of their own; equal
    lengths are packed in the order of the stored rows; an empty table gives an empty result; other columns play no part.

    At scale: only lengths are shuffled. A partition holds about ``group`` pieces, whatever the size of the table; each
    round repacks only what partitions with a gap gave away, keeps the new packing only if it needs fewer bins, and
    at most ``rounds`` rounds are made. Tokens are made once, in narrow map work.
    """
    cut = materialize(pieces(docs, path, capacity, end_id))
    cut = materialize(cut.withColumn("item", F.monotonically_increasing_id()))
    start = F.lit(0).cast("long").alias("offset")
    done = cut.where(F.col("length") == capacity).select("item", F.col("item").alias("sequence_id"), start)
    open_ = cut.where(F.col("length") < capacity).select("item", "length")
    held = None  # what the last round gave away, as it was packed there
    for number in range(rounds):
        groups = -(-open_.count() // group)
        if not groups:
            break
        dealt = open_.groupBy(F.pmod(F.xxhash64("item", F.lit(number)), F.lit(groups)))
        packed = materialize(dealt.applyInArrow(lambda table: _pack(table, capacity), PACKED))
        if held is not None and _bins(packed) >= _bins(held):
            break  # no better than the round before, which stands
        places = packed.select("item", "sequence_id", "offset")
        done = done.unionByName(places.where(~packed["given"]))
        held = places.where(packed["given"])
        open_ = cut.join(held, "item", "left_semi").select("item", "length")
    if held is not None:
        done = done.unionByName(held)
    return cut.join(done, "item").drop("item")


def _bins(packed: DataFrame) -> int:
    return packed.agg(F.count_distinct("sequence_id")).first()[0]
