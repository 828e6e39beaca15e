"""URL filters by a cascade of Bloom filters.

A rule names a host and the beginning of a path. The keys that a url asks for are the ends of its host and the beginnings
of its path in the lengths that rules have; all keys that a table asks for are the cascade's universe. The first
filter encodes the listed keys, the second one the keys of the universe that pass it without being listed, the third one
the listed keys that pass the second, and so on until none is left over: the number of filters a key passes in a row tells
exactly whether it is listed. Judging the urls is one pass over them, without a join.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, log, log2

from pyspark.sql import Column, DataFrame, functions as F

from gleanery.functions.text import let

from .common import materialize, pick

#: Listed keys in one cascade, whose filters are constants of the plan (a few hundred kilobytes); longer
#: lists are cut by key hash into cascades, each of which takes a pass over the urls.
SHARD_KEYS = 20_000
#: Hash functions of the first filter, at most.
MOST_HASHES = 30
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Filter:
    """A Bloom filter: its words of 64 bits as text, and its place in the cascade, which salts the hashes."""

    place: int
    bits: int
    hashes: int
    words: str

    def has(self, key: Column) -> Column:
        """Whether a key (host, path) may be in the encoded set."""
        words = F.split(F.lit(self.words), ",").cast("array<bigint>")
        bit = lambda at: F.bit_get(F.get(words, F.shiftright(at, 6).cast("int")), (at % 64).cast("int")) == 1
        return F.forall(_places(key, self.place, self.bits, self.hashes), bit)


def _places(key: Column, place: int, bits: int, hashes: int) -> Column:
    """The bits of a key in the filter at a place of the cascade."""
    host, path = key["host"], key["path"]
    first = F.pmod(F.xxhash64(F.lit(2 * place), host, path), F.lit(bits))
    if hashes == 1:
        return F.array(first)
    step = F.pmod(F.xxhash64(F.lit(2 * place + 1), host, path), F.lit(bits))
    turns = F.sequence(F.lit(0), F.lit(hashes - 1))
    return let(F.struct(first.alias("a"), step.alias("b")), lambda x: F.transform(turns, lambda i: (x["a"] + i * x["b"]) % bits))


def encode(keys: DataFrame, n: int, hashes: int, place: int) -> Filter:
    """The filter of ``n`` keys (key: host, path), filled to one half. Its words, bounded by ``n``, come to the driver."""
    bits = 64 * max(1, ceil(n * hashes / log(2) / 64))
    at = keys.select(F.explode(_places(F.col("key"), place, bits, hashes)).alias("at"))
    word = F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))"))
    rows = at.groupBy(F.shiftright("at", 6).alias("word")).agg(word.alias("set")).collect()
    words = ["0"] * (bits // 64)
    for row in rows:
        words[row["word"]] = str(row["set"])
    return Filter(place, bits, hashes, ",".join(words))


def cascade(listed: DataFrame, universe: DataFrame) -> list[Filter]:
    """Filters that tell listed keys from all other keys of the universe exactly.

    ``listed`` and ``universe`` hold distinct keys (key: struct of host and path). The first filter is sized so that about as many
    other keys pass it as are listed; the later ones have one hash function and halve what is left.
    """
    n, asked = listed.count(), universe.count()
    if not n or not asked:
        return []
    filters = [encode(listed, n, min(MOST_HASHES, max(1, ceil(log2(asked / n)))) if asked > n else 1, 0)]
    passed = universe.where(filters[0].has(F.col("key"))).withColumn("listed", F.lit(False))
    both = passed.unionByName(listed.select("key", F.lit(True).alias("listed")))
    left = materialize(both.groupBy("key").agg(F.bool_or("listed").alias("listed")))
    while True:
        wrong = left.where(F.col("listed") == F.lit(len(filters) % 2 == 0))
        n = wrong.count()
        if not n:
            return filters
        filters.append(encode(wrong, n, 1, len(filters)))
        left = left.where(filters[-1].has(F.col("key")))


def contains(filters: list[Filter], key: Column) -> Column:
    """Whether a key of the universe is listed: it passes an odd number of filters in a row."""
    out = F.lit(False)
    for own in reversed(filters):
        out = own.has(key) & ~out
    return out


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased) and path (from there up to ``?``,
    ``#`` or the end); both empty for null and without ``://``."""
    rest = F.when(F.contains(url, F.lit("://")), F.substr(url, F.locate("://", url) + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 1), _UPPER, _LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 2), F.lit(""))


def asked_keys(shapes: list[tuple[int, int]]) -> Column:
    """The keys that ``host`` and ``path`` ask for, in the given lengths (of host and path)."""
    host, path = F.col("host"), F.col("path")
    lengths = F.array(*[F.struct(F.lit(h).alias("h"), F.lit(p).alias("p")) for h, p in shapes])
    before = lambda s: F.substr(host, F.length(host) - s["h"], F.lit(1))
    whole = lambda s: F.length(host) == s["h"]
    fits = lambda s: (F.length(path) >= s["p"]) & (whole(s) | ((F.length(host) > s["h"]) & (before(s) == ".")))
    tail = lambda s: F.substr(host, F.length(host) - s["h"] + 1, s["h"])
    key = lambda s: F.struct(tail(s).alias("host"), F.substr(path, F.lit(1), s["p"]).alias("path"))
    return F.transform(F.filter(lengths, fits), key)


def judge_urls(pages: DataFrame, rules: DataFrame, key: str = "page_id") -> DataFrame:
    """The verdict on every url of ``pages`` by the longest rule that fits it.

    ``rules`` has host, path and verdict (allow or block). A rule fits its host and all subdomains of it, if the url's path
    starts with the rule's. The longest (host and path together; of equal ones the longer host) wins; a url that no rule
    fits is on no list and allowed. Result, a row for each row of ``pages``: the key, host, path, rule (host and path as one text,
    or null), verdict.

    Defined cases: null urls and urls without ``://`` have an empty host and path; hosts are compared in lower case (A-Z),
    paths as they stand; of two rules of one host and path a block wins; rules with a null in any column are left out;
    without rules all urls are allowed; repeated rows come back as often as they went in; an empty table gives an empty
    result; other columns play no part.

    At scale: only distinct keys in the lengths that rules have are shuffled; urls are judged where they are read. A url asks for
    at most one key for each pair of lengths, however long it is. The filters are bounded by ``SHARD_KEYS``.
    """
    host, path = host_and_path(F.col("url"))
    rows = pick(pages, key, "url").select(key, host.alias("host"), path.alias("path"), F.lit(None).cast(_HIT).alias("hit"))
    rules = pick(rules, "host", "path", "verdict").where("host is not null and path is not null and verdict is not null")
    lower = F.struct(F.translate("host", _UPPER, _LOWER).alias("host"), "path")
    listed = materialize(rules.groupBy(lower.alias("key")).agg(F.bool_or(F.col("verdict") == "block").alias("block")))
    shapes = [(r.h, r.p) for r in listed.select(F.length("key.host").alias("h"), F.length("key.path").alias("p")).distinct().collect()]
    if shapes:
        shards = ceil(listed.count() / SHARD_KEYS)
        keys = asked_keys(sorted(shapes))
        universe = materialize(rows.select(F.explode(keys).alias("key")).distinct())
        shard = lambda k: F.pmod(F.xxhash64(F.lit(-1), k["host"], k["path"]), F.lit(shards))
        for i in range(shards):
            mine = lambda df: df.where(shard(F.col("key")) == i)
            lists = [cascade(mine(listed).where(F.col("block") == b).select("key"), mine(universe)) for b in (True, False)]
            rows = rows.withColumn("hit", F.greatest("hit", _longest(keys, lists, shard, i)))
            if shards > 1:
                rows = materialize(rows)
    rule, verdict = F.concat("hit.host", "hit.path"), F.when(F.col("hit.block"), "block").otherwise("allow")
    return rows.select(key, "host", "path", rule.alias("rule"), verdict.alias("verdict"))


_HIT = "struct<n: int, h: int, host: string, path: string, block: boolean>"


def _longest(keys: Column, lists: list[list[Filter]], shard, i: int) -> Column:
    """The longest of the keys that the cascades of shard ``i`` (blocked and allowed keys) contain."""
    blocked, allowed = lists

    def hit(k: Column) -> Column:
        block = F.when(contains(blocked, k), True).when(contains(allowed, k), False)
        size = F.length(k["host"])
        found = F.struct((size + F.length(k["path"])).alias("n"), size.alias("h"), k["host"].alias("host"), k["path"].alias("path"), block.alias("block"))
        return found.cast(_HIT)

    own = F.filter(keys, lambda k: shard(k) == i)
    return F.array_max(F.filter(F.transform(own, hit), lambda x: x["block"].isNotNull()))
