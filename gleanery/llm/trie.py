"""Prefix trie of conversations by the Euler-tour technique.

A node is a sequence of first turns; its key is the exclusive or of hashes that take in each turn's place, so the keys of a
conversation are prefix sums. Nodes are numbered by their smallest conversation and depth. Every node has an
arc by which the tour of the tree enters it and one by which it leaves; each arc knows the next. Ranking that list gives the
sums from each arc to the end of the tour, and what lies between the arcs of a node is its subtree.

The list is ranked by contraction: neighbouring numbers mostly follow one another, so blocks of arcs are ranked each in
a task, and only arcs that a list enters a block by go on to the next round. A list that does not shrink so is ranked by
pointer jumping.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import materialize, pick

#: Arcs that one task ranks; blocks begin with arcs of neighbouring numbers, as a power of two.
BLOCK = 1 << 19
BLOCK_BITS = 17
#: A round of blocks has to leave at most this share of the arcs (below 1); else pointer jumping takes over.
SHRINKS = 0.7
#: Turns of a conversation, siblings of a node, and neighbouring conversation ids in one group, as powers of two.
TURN_BITS, SIBLING_BITS, ID_BITS = 10, 8, 10
_ROW_BITS = 33


def numbered(df: DataFrame, name: str, *order: str) -> DataFrame:
    """``df``, stored, with its rows numbered from 0 in the order of some columns, nulls first.

    Rows are sorted in ranges, each numbers its own and the counts of the ranges before it are added; a range is bounded, however
    many rows share a value of the first columns, as long as all ``order`` columns tell rows apart.
    """
    ranges = df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order])
    stored = materialize(ranges.sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    stored = stored.withColumn("_range", F.shiftright("_at", _ROW_BITS))
    counts = stored.groupBy("_range").agg(F.count("*").alias("_n"))  # a row for each range
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.col("_before") + F.col("_at") - F.shiftleft("_range", _ROW_BITS)
    return stored.join(starts, "_range").select(*df.columns, place.alias(name))


def _hashes(*columns: str | Column) -> tuple[Column, Column]:
    return F.xxhash64(*columns), F.xxhash64(F.lit("second"), *columns)


def plain_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), n (turns of the conversation), a, b (a hash of role and text), words."""
    rows = pick(conversations, "conv_id", "turn", "role", "text").where("conv_id is not null")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    a, b = _hashes(role, text)
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    # Rows that repeat are told apart by their place in the table, so that no group of them stays together.
    rows = rows.select(
        F.col("conv_id").cast("long"), "turn", a.alias("a"), b.alias("b"), words.alias("words"), F.monotonically_increasing_id().alias("row")
    )
    rows = materialize(numbered(rows, "at", "conv_id", "turn", "a", "b", "row"))
    starts = rows.groupBy("conv_id").agg(F.min("at").alias("start"), F.count("*").alias("n"))
    return rows.join(starts, "conv_id").select("conv_id", (F.col("at") - F.col("start") + 1).alias("place"), "n", "a", "b", "words")


def rebuilt_turns(turns: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like the first one of their ``every`` neighbours.

    Conversation c takes the first h turns of conversation c - c % ``every`` and its own turns after its first h, h = crc32 of the
    decimal c, % ``most``. Returns conversations (conv_id, n) and turns (conv_id, place, a, b, words).
    """
    turns = materialize(turns)
    first = F.struct("place", "a", "b", "words")
    heads = turns.where((F.col("conv_id") % every == 0) & (F.col("place") < most)).groupBy(F.col("conv_id").alias("base"))
    heads = heads.agg(F.array_sort(F.collect_list(first)).alias("head"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    convs = turns.groupBy("conv_id").agg(F.max("n").alias("n")).withColumns({"h": h, "base": F.col("conv_id") - F.col("conv_id") % every})
    convs = convs.join(heads, "base", "left").withColumn("head", F.slice(F.coalesce("head", F.array().cast(_HEAD)), F.lit(1), F.col("h").cast("int")))
    convs = materialize(convs.withColumn("taken", F.size("head")).drop("base"))
    taken = convs.select("conv_id", F.inline("head"))
    own = turns.join(convs.select("conv_id", "h", "taken"), "conv_id").where("place > h")
    own = own.select("conv_id", (F.col("place") - F.col("h") + F.col("taken")).alias("place"), "a", "b", "words")
    length = F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    return convs.select("conv_id", length.alias("n")), taken.unionByName(own)


_HEAD = "array<struct<place: bigint, a: bigint, b: bigint, words: bigint>>"


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, depth, key (a, b), parent's key (pa, pb) and words of the last turn, for each first turns of each conversation.

    Turns are added up in groups of 2^10, and the sums of groups of long conversations carried on.
    """
    a, b = _hashes("place", "a", "b")
    turns = turns.select("conv_id", "place", "words", a.alias("a"), b.alias("b"), F.shiftright(F.col("place") - 1, TURN_BITS).alias("group"))
    upto = Window.partitionBy("conv_id", "group").orderBy("place")
    sums = turns.withColumns({"sa": F.bit_xor("a").over(upto), "sb": F.bit_xor("b").over(upto)})
    groups = turns.groupBy("conv_id", "group").agg(F.bit_xor("a").alias("ca"), F.bit_xor("b").alias("cb"))
    before = Window.partitionBy("conv_id").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    carried = groups.withColumns({"ca": F.bit_xor("ca").over(before), "cb": F.bit_xor("cb").over(before)}).where("group > 0")
    sums = sums.join(carried, ["conv_id", "group"], "left")
    key = {c: F.col(f"s{c}").bitwiseXOR(F.coalesce(f"c{c}", F.lit(0))) for c in "ab"}
    return sums.select(
        "conv_id", F.col("place").alias("depth"), "words", key["a"].alias("a"), key["b"].alias("b"),
        key["a"].bitwiseXOR(F.col("a")).alias("pa"), key["b"].bitwiseXOR(F.col("b")).alias("pb"),
    )


# ---- list ranking ----


def _rank_block(table: pa.Table, values: list[str]) -> pa.Table:
    """For each arc the sums up to where its list leaves the block, where it leads, and whether the list enters the block by it."""
    ids = table["id"].to_numpy()
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    ahead = np.where(table["next"].is_valid().to_numpy(), table["next"].fill_null(0).to_numpy(), -1)[order]
    sums = np.stack([table[v].to_numpy()[order] for v in values])
    at = np.minimum(np.searchsorted(ids, ahead), len(ids) - 1)
    jump = np.where(ids[at] == ahead, at, -1)
    entry = np.ones(len(ids), bool)
    entry[jump[jump >= 0]] = False
    end = np.arange(len(ids))
    while len(inside := np.flatnonzero(jump >= 0)):
        to = jump[inside]
        sums[:, inside] += sums[:, to]
        end[inside] = end[to]
        jump[inside] = jump[to]
    target = ahead[end]
    columns = [pa.array(ids), pa.array(target, mask=target < 0), pa.array(entry), *map(pa.array, sums)]
    return pa.Table.from_arrays(columns, names=["id", "next", "entry", *values])


def _jump(links: DataFrame, values: list[str]) -> DataFrame:
    """Ranks by pointer jumping: every round doubles the reach of each link."""
    links = materialize(links)
    while not links.where("next is not null").isEmpty():
        far = links.select(F.col("id").alias("next"), F.col("next").alias("far"), *[F.col(v).alias(f"_{v}") for v in values])
        going = links.where("next is not null").join(far, "next")
        going = going.select("id", F.col("far").alias("next"), *[(F.col(v) + F.col(f"_{v}")).alias(v) for v in values])
        links = materialize(going.unionByName(links.where("next is null")))
    return links.select("id", *values)


def suffix_sums(links: DataFrame, values: list[str]) -> DataFrame:
    """(id, values): for each element of linked lists the sums of its values and those of all that follow it.

    ``links`` has id (numbers from 0, distinct), next (null at the end of a list) and the values (long).
    """
    types = "id long, next long, entry boolean, " + ", ".join(f"{v} long" for v in values)
    links, levels = materialize(links), []
    n = links.count()
    while n:
        blocks = links.withColumn("block", F.shiftright("id", BLOCK_BITS))
        if n > BLOCK:
            counts = blocks.groupBy("block").agg(F.count("*").alias("n"))
            before = F.coalesce(F.sum("n").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
            groups = counts.select("block", F.floor(before / BLOCK).alias("group"))
            blocks = blocks.join(groups, "block")
        else:
            blocks = blocks.withColumn("group", F.lit(0).cast("long"))
        blocks = blocks.select("group", "id", "next", *values)
        ranked = materialize(blocks.groupBy("group").applyInArrow(lambda t: _rank_block(t, values), types))
        levels.append(ranked)
        if n <= BLOCK:
            break
        links = ranked.where("entry").select("id", "next", *values)
        n, before_n = links.count(), n
        if n > SHRINKS * before_n:
            levels.append(_jump(links, values).withColumn("next", F.lit(None).cast("long")))
            break
    if not levels:
        return links.select("id", *values)
    out = levels.pop().select("id", *values)
    for level in reversed(levels):
        rest = out.select(F.col("id").alias("next"), *[F.col(v).alias(f"_{v}") for v in values])
        sums = [(F.col(v) + F.coalesce(f"_{v}", F.lit(0))).alias(v) for v in values]
        out = materialize(level.join(rest, "next", "left").select("id", *sums))
    return out


# ---- the tree ----


def euler_arcs(nodes: DataFrame) -> DataFrame:
    """The tour of a tree: arcs 2 * node (entering it) and 2 * node + 1 (leaving it), each with the next, null at the end.

    ``nodes`` has node (numbers from 0), parent (null for the root) and saved, the node's own savings. Children are visited in the
    order of their numbers.
    """
    children = nodes.where("parent is not null")
    first = children.groupBy(F.col("parent").alias("node")).agg(F.min("node").alias("first"))
    grouped = children.select("node", "parent", F.shiftright("node", SIBLING_BITS).alias("group"))
    beside = F.lead("node").over(Window.partitionBy("parent", "group").orderBy("node"))
    groups = grouped.groupBy("parent", "group").agg(F.min("node").alias("least"))
    following = F.lead("least").over(Window.partitionBy("parent").orderBy("group"))
    groups = groups.select("parent", "group", following.alias("following")).where("following is not null")
    siblings = grouped.withColumn("beside", beside).join(groups, ["parent", "group"], "left")
    siblings = siblings.select("node", F.coalesce("beside", "following").alias("sibling"))
    tour = nodes.join(first, "node", "left").join(siblings, "node", "left")
    enter, leave = F.col("node") * 2, F.col("node") * 2 + 1
    leaf = F.col("first").isNull()
    after = F.coalesce(F.col("sibling") * 2, F.col("parent") * 2 + 1)
    arc = lambda i, to, *v: F.struct(i.alias("id"), to.alias("next"), *[x.cast("long").alias(n) for x, n in zip(v, SUMS)])
    one, none = F.lit(1), F.lit(0)
    arcs = F.array(arc(enter, F.coalesce(F.col("first") * 2, leave), one, leaf, F.col("saved")), arc(leave, after, one, none, none))
    return tour.select(F.inline(arcs))


SUMS = ["arcs", "leaves", "saved"]


def _ends(steps: DataFrame, convs: DataFrame) -> DataFrame:
    """(depth, a, b, ends_sha256): SHA-256 of the ids, ascending and joined by commas, of the conversations that end at a node.

    Ids are joined in groups of neighbours; the groups of a node are digested in order as they pass, none is gathered.
    """
    node = ["depth", "a", "b"]
    last = steps.join(convs, "conv_id").where("depth = n").select(*node, "conv_id")
    empty = convs.where("n = 0").select(*[F.lit(0).cast("long").alias(c) for c in node], "conv_id")
    group = F.shiftright("conv_id", ID_BITS).alias("group")
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    groups = last.unionByName(empty).groupBy(*node, group).agg(ids.alias("ids"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, sha, done = None, None, []
        for batch in batches:
            for *key, ids in zip(*(batch.column(c).to_pylist() for c in (*node, "ids"))):
                if key == own:
                    sha.update(b",")
                else:
                    if own is not None:
                        done.append((*own, sha.hexdigest()))
                    own, sha = key, hashlib.sha256()
                sha.update(ids.encode())
            if len(done) > 1000:
                yield _digests(done)
                done = []
        if own is not None:
            done.append((*own, sha.hexdigest()))
        yield _digests(done)

    ordered = groups.repartition(*node).sortWithinPartitions(*node, "group")
    return ordered.mapInArrow(digest, "depth long, a long, b long, ends_sha256 string")


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ((), (), (), ())
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["depth", "a", "b", "ends_sha256"])


def prefix_trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """The prefix trie of conversations (conv_id, n: number of turns) with their turns (conv_id, place from 1, a, b: hash of the
    turn, words).

    Result, a row for each distinct sequence of first turns, the root without turns included: conv_id (the smallest
    conversation that begins so), depth (turns), parent_conv_id (the parent's conv_id, null for the root), n_convs,
    n_children, n_leaves (nodes without children in the subtree), saved_tokens (over the subtree, (n_convs - 1) times the words of a
    node's last turn), ends_sha256 (of the ids of conversations that end here), enter_at and leave_at (places in the
    tour). Without conversations there is no node.
    """
    steps = materialize(prefixes(turns))
    inner = steps.groupBy("depth", "a", "b").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.first("words").alias("words"), F.first("pa").alias("pa"), F.first("pb").alias("pb")
    )
    zero, null = F.lit(0).cast("long"), F.lit(None).cast("long")
    top = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = top.select(
        zero.alias("depth"), zero.alias("a"), zero.alias("b"), "conv_id", "n_convs", zero.alias("words"), null.alias("pa"), null.alias("pb")
    )
    nodes = materialize(numbered(inner.unionByName(root), "node", "conv_id", "depth"))
    # The root, the node with most children often, is number 0; only the parents of deeper nodes are looked up.
    least = root.select("conv_id").first()
    above = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id")
    ).where("depth > 1")
    deep = nodes.where("depth > 1").join(above, ["depth", "pa", "pb"])
    top_id = F.lit(least.conv_id if least else None).cast("long")
    flat = nodes.where("depth <= 1").withColumns(
        {"parent": F.when(F.col("depth") == 1, 0).cast("long"), "parent_conv_id": F.when(F.col("depth") == 1, top_id)}
    )
    family = flat.unionByName(deep).withColumn("saved", (F.col("n_convs") - 1) * F.col("words"))
    family = materialize(family.drop("pa", "pb", "words"))
    sums = suffix_sums(euler_arcs(family.select("node", "parent", "saved")), SUMS)
    # What follows a node's first arc but not its last one is its subtree.
    signed = [F.sum(F.when(F.col("id") % 2 == 0, F.col(v)).otherwise(-F.col(v))).alias(v) for v in SUMS[1:]]
    total = 2 * F.lit(nodes.count())
    enter_at = (total - F.max("arcs")).alias("enter_at")
    leave_at = (total - F.min("arcs")).alias("leave_at")
    subtree = sums.groupBy(F.shiftright("id", 1).alias("node")).agg(*signed, enter_at, leave_at)
    subtree = subtree.select("node", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), "enter_at", "leave_at")
    counts = family.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    out = family.join(counts, "node", "left").join(subtree, "node").join(_ends(steps, convs), ["depth", "a", "b"], "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"), "enter_at", "leave_at",
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """:func:`prefix_trie` of conversations (conv_id, turn, role, text) as they stand.

    Defined cases: turns are ordered by ``turn``, null first, and turns of one number by a hash of role and text; rows that repeat
    are turns of their own; null role or text is empty; rows with a null conv_id belong to no conversation; an
    empty table has no node; other columns play no part.

    At scale: texts are hashed where they are read and not shuffled. Conversations of any length, nodes with any number of
    children and nodes at which any number of conversations end are handled in groups of bounded size; the
    joins of turns with their conversation's first row and of nodes with their parents have one row per key on
    the right side, so Spark can split a hot key. Ranking takes a few rounds, each written to the shared scratch folder.
    """
    turns = materialize(plain_turns(conversations))
    return prefix_trie(turns.groupBy("conv_id").agg(F.max("n").alias("n")), turns)


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """:func:`prefix_trie` of conversations rebuilt by :func:`rebuilt_turns`; else as :func:`conversation_trie`."""
    return prefix_trie(*rebuilt_turns(plain_turns(conversations)))
