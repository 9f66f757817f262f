"""Prefix trie of conversations by vertical bitmaps (operator 13).

Index: a shard holds the conversations of one range of ids and one run of positions. For each position it
maps each turn to the bitset of the conversations that have it there. Depth-first, a node's bitset is
intersected with the posting of the turn that its lowest conversation has next; the intersection is a child,
its popcount the child's members, its lowest bit the smallest member, and what is left gives the next child,
so that only postings which meet the node are touched. Conversations that end at a node form its end list in
the shard, in order of their ids.

A node is named by 128 bits: the XOR of a position-salted hash of each of its turns. XOR runs over a
conversation's segments as a plain aggregate, so a shard knows the node at which its run of positions starts
and never needs the turns before it: a conversation of any length spreads over many shards. Nodes of several
shards are merged by an aggregate on their names.

Only nodes with two members or more (the shared top of the trie) need sums over subtrees: below them each
conversation is a path with one leaf and nothing to save. Those sums run by pointer doubling over parents, as
many rounds as the logarithm of the shared depth, each a join and an aggregate.

Edge cases: rows with a null conv_id belong to no conversation and are left out; a null turn comes first, a
null role or text is empty; equal turn numbers are ordered by role and text; repeated rows are turns of
their own. A conversation without rebuilt turns is a member of the root and ends there. A negative conv_id
takes the remainder toward zero. An empty table has no conversation, hence no root and no rows. Columns other
than the four named are not read.

The digest of one node's end list is sequential by its definition: its packed lists meet in one task, in
order and in a stream, so memory stays bounded even where a third of all conversations end at one node.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoforge.llm.common import scratch, small, table_of
from chronoforge.operators.sequence import positional_index
from chronoforge.session import checkpoint_dir

#: ids of a shard (a power of two), positions of a shard
SHARD_BITS = 11
SHARD_TURNS = 64
#: conversations borrow the head of the one whose id is the last multiple of this
FAMILY, HEADS = 100, 6

_NODE = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("depth", pa.int64()), ("p1", pa.int64()), ("p2", pa.int64()),
                   ("n", pa.int64()), ("conv_id", pa.int64()), ("chars", pa.int64()), ("block", pa.int64()), ("ends", pa.binary())])
_NODE_SQL = "k1 long, k2 long, depth long, p1 long, p2 long, n long, conv_id long, chars long, block long, ends binary"
_NOBODY = hashlib.sha256(b"").hexdigest()


def _turns(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, pos, t1, t2, chars): original turns in order, as hashes."""
    rows = conversations.select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    ).where("conv IS NOT NULL")
    placed = positional_index(rows, ["conv"], "turn", ["role", "text"], idx_col="pos")
    return scratch(placed.select("conv", "pos", F.xxhash64("role", "text").alias("t1"), F.xxhash64("text", F.lit(7), "role").alias("t2"),
                                 F.length("text").cast("long").alias("chars")))


def rebuilt_turns(turns: DataFrame) -> DataFrame:
    """(conv, pos, t1, t2, chars): the first h turns of the conversation at the last multiple of ``FAMILY``,
    then the own turns after the first h; a row without turn for each conversation besides."""
    convs = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("own"))
    convs = convs.select("conv", (F.col("conv") - F.col("conv") % FAMILY).alias("base"),
                         (F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS).alias("h"))
    first = turns.where((F.col("pos") < HEADS - 1) & (F.col("conv") % FAMILY == 0))
    heads = first.groupBy(F.col("conv").alias("base")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "t1", "t2", "chars"))).alias("head"))  # at most HEADS - 1
    lent = convs.join(heads, "base", "left").withColumn(
        "head", F.coalesce(F.filter("head", lambda x: x["pos"] < F.col("h")), F.array().cast(heads.schema["head"].dataType)))
    lent = scratch(lent.select("conv", "h", "head", (F.size("head") - F.col("h")).alias("shift")))
    borrowed = lent.select("conv", F.inline("head"))
    shifts = lent.select("conv", "h", "shift").where("h > 0")
    own = turns.join(small(shifts, lent.count()), "conv", "left").where("h IS NULL OR pos >= h")
    own = own.select("conv", (F.col("pos") + F.coalesce("shift", F.lit(0))).alias("pos"), "t1", "t2", "chars")
    marks = lent.select("conv", F.lit(0).cast("long").alias("pos"), *[F.lit(None).cast("long").alias(c) for c in ("t1", "t2", "chars")])
    return borrowed.unionByName(own).unionByName(marks)


def _shards(rebuilt: DataFrame) -> DataFrame:
    """(block, seg, conv, turns, e1, e2, last): one row for each conversation and run of positions, with the
    name of the node at which it starts."""
    seg = F.col("pos").bitwiseAND(F.lit(-SHARD_TURNS).cast("long"))
    turn = F.when(F.col("t1").isNotNull(), F.struct(
        F.col("pos"), F.xxhash64("pos", "t1", "t2").alias("a"), F.xxhash64("t2", "pos", F.lit(3), "t1").alias("b"), F.col("chars")))
    runs = rebuilt.select("conv", seg.alias("seg"), turn.alias("turn")).groupBy("conv", "seg").agg(
        F.array_sort(F.collect_list("turn")).alias("turns"),  # at most SHARD_TURNS
        F.coalesce(F.bit_xor("turn.a"), F.lit(0)).alias("x1"), F.coalesce(F.bit_xor("turn.b"), F.lit(0)).alias("x2"))
    w = Window.partitionBy("conv").orderBy("seg")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    return runs.select(
        F.shiftright("conv", SHARD_BITS).alias("block"), "seg", "conv", "turns",
        F.coalesce(F.bit_xor("x1").over(before), zero).alias("e1"), F.coalesce(F.bit_xor("x2").over(before), zero).alias("e2"),
        F.lead("seg").over(w).isNull().alias("last"))


def _walk(key: tuple, table: pa.Table) -> pa.Table:
    """The nodes of one shard, depth-first over bitsets."""
    block, seg = key[0].as_py(), key[1].as_py()
    table = table.sort_by("conv")
    convs, turns = table.column("conv").to_pylist(), table.column("turns").to_pylist()
    posting: list[dict] = [defaultdict(int) for _ in range(max(map(len, turns), default=0))]
    path, ended, entries = [], [0] * (len(posting) + 1), defaultdict(int)
    for i, (run, e1, e2, last) in enumerate(zip(turns, table.column("e1").to_pylist(), table.column("e2").to_pylist(), table.column("last").to_pylist())):
        bit = 1 << i
        path.append([(t["a"], t["b"], t["chars"]) for t in run])
        for d, t in enumerate(path[i]):
            posting[d][t] |= bit
        if last:
            ended[len(run)] |= bit
        entries[e1, e2] |= bit
    out: dict[str, list] = {f.name: [] for f in _NODE}

    def emit(name: tuple, depth: int, parent: tuple, members: int, chars: int, ends: int) -> None:
        done = []
        while ends:
            low = ends & -ends
            done.append(convs[low.bit_length() - 1])
            ends ^= low
        row = (*name, seg + depth, *parent, members.bit_count(), convs[(members & -members).bit_length() - 1], chars, block,
               np.array(done, "<i8").tobytes() if done else None)
        for column, value in zip(out.values(), row):
            column.append(value)

    stack = []
    for name, members in entries.items():
        if seg == 0:
            emit(name, 0, (None, None), members, 0, members & ended[0])
        stack.append((name, 0, members & ~ended[0]))
    while stack:
        name, depth, rest = stack.pop()
        while rest:
            turn = path[(rest & -rest).bit_length() - 1][depth]
            child = rest & posting[depth][turn]
            rest ^= child
            node = (name[0] ^ turn[0], name[1] ^ turn[1])
            ends = child & ended[depth + 1]
            emit(node, depth + 1, name, child, turn[2], ends)
            # who does not end here has a next turn, in this run of positions or, after its last, in the next shard
            if child ^ ends and depth + 1 < len(posting):
                stack.append((node, depth + 1, child ^ ends))
    return table_of(_NODE, out)


def _ends(shards: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256) of the nodes at which conversations end: lists of the shards in order of ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, digest, done = None, None, []
        for b in batches:
            for k1, k2, ids in zip(*(b.column(c).to_pylist() for c in ("k1", "k2", "ends"))):
                line = ",".join(map(str, np.frombuffer(ids, "<i8").tolist())).encode()
                if (k1, k2) == name:
                    digest.update(b"," + line)
                    continue
                if name is not None:
                    done.append((*name, digest.hexdigest()))
                name, digest = (k1, k2), hashlib.sha256(line)
            if len(done) > 100_000:
                yield _digests(done)
                done = []
        if name is not None:
            done.append((*name, digest.hexdigest()))
        yield _digests(done)

    lists = shards.where("ends IS NOT NULL").select("k1", "k2", "block", "ends")
    return lists.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "block").mapInArrow(run, "k1 long, k2 long, ends_sha256 string")


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("ends_sha256", pa.string())])
    return pa.RecordBatch.from_pydict({f.name: [r[i] for r in rows] for i, f in enumerate(schema)}, schema=schema)


def _named(prefix: str) -> list[Column]:
    return [F.col("k1").alias(f"{prefix}1"), F.col("k2").alias(f"{prefix}2")]


def subtree_sums(nodes: DataFrame, values: list[str]) -> DataFrame:
    """(k1, k2, values): each of ``nodes(k1, k2, depth, p1, p2, values)`` with the sums over its subtree, by pointer
    doubling: after round r a node holds its descendants of less than 2^r levels and points 2^r levels up."""
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    now = scratch(nodes.select("k1", "k2", "p1", "p2", *values))
    for _ in range(deepest.bit_length()):
        up = now.where("p1 IS NOT NULL").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(*[F.sum(v).alias(f"{v}_below") for v in values])
        above = now.select(*_named("p"), F.col("p1").alias("q1"), F.col("p2").alias("q2"))
        now = now.join(up, ["k1", "k2"], "left").join(above, ["p1", "p2"], "left")
        now = scratch(now.select("k1", "k2", F.col("q1").alias("p1"), F.col("q2").alias("p2"),
                                 *[(F.col(v) + F.coalesce(f"{v}_below", F.lit(0))).alias(v) for v in values]))
    return now.select("k1", "k2", *values)


def prefix_trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), one row for each
    distinct sequence of first turns of the rebuilt conversations; conv_id and depth name it."""
    checkpoint_dir(conversations.sparkSession)
    rebuilt = rebuilt_turns(_turns(conversations, conv_col, turn_col, role_col, text_col))
    local = scratch(_shards(rebuilt).groupBy("block", "seg").applyInArrow(_walk, _NODE_SQL))
    nodes = scratch(local.groupBy("k1", "k2", "depth").agg(
        F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.sum("n").alias("n"), F.min("conv_id").alias("conv_id"), F.max("chars").alias("chars")))
    # a node with one member has at most one child, and its members' paths below it are its own
    shared = scratch(nodes.where("n > 1"))
    n_shared = shared.count()
    tops = shared.select(*_named("p"), F.col("conv_id").alias("top"))
    under = scratch(nodes.join(small(tops, n_shared, 500_000), ["p1", "p2"], "left"))
    children = under.where("p1 IS NOT NULL").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
        F.count(F.lit(1)).alias("n_children"), F.count_if(F.col("n") == 1).alias("lone"))
    counted = scratch(under.join(children, ["k1", "k2"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
                      .withColumn("lone", F.coalesce("lone", F.lit(0))))
    own = counted.where("n > 1").withColumn("leaves", F.col("lone") + (F.col("n_children") == 0).cast("long")).withColumn(
        "saved", (F.col("n") - 1) * F.col("chars"))
    sums = subtree_sums(own, ["leaves", "saved"])
    out = counted.join(small(sums, n_shared, 500_000), ["k1", "k2"], "left").join(_ends(local), ["k1", "k2"], "left")
    parent = F.when(F.col("depth") > 0, F.coalesce("top", "conv_id"))
    return out.select("conv_id", "depth", parent.alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children",
                      F.coalesce("leaves", F.lit(1)).cast("long").alias("n_leaves"), F.coalesce("saved", F.lit(0)).cast("long").alias("saved_tokens"),
                      F.coalesce("ends_sha256", F.lit(_NOBODY)).alias("ends_sha256"))
