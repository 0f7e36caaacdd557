"""Prefix trie of conversations, as a burst trie.

A conversation is the sequence of its turns. Each distinct sequence of first turns is a node of a trie; its
members are the conversations that start with it. Turns are told apart by 128-bit ids of role and text, so texts
are read once and never moved; a sequence is a string of such ids.

1. *Collapse.* Equal sequences become one, with the number of conversations, the smallest id, and the digest of all their
   ids. Ids are sorted over all partitions and packed into blocks; only the digest itself, which is sequential,
   reads a group's blocks one after the other.
2. *Burst.* All sequences start in one suffix container. A container with more than ``container_turns`` turns
   and more than one sequence bursts: its longest common prefix (of its first and last sequence) becomes a trie head, a chain of
   nodes, and what follows is dealt by the next turn id into containers below it. Every burst splits a container, so
   rounds follow the branching of what is frequent, not the length of what is shared. Bursts are grouped aggregates and a join on
   the container; only containers that burst take part.
3. *Sweep.* The remaining containers are spread over shards (partitions), sorted by sequence, and swept once: neighbours'
   common prefix says which nodes close and which open. A task holds the open path and the nodes of one container.
4. *Up.* Leaves and savings of containers are summed up at their heads, last round first.

Edge cases: a null role or text is empty; a null turn comes first; turns of one number come in the order of their ids, and
repeated rows stay separate turns; rows with a null ``conv_id`` belong to no conversation and are left out; a
conversation without turns ends at the root; an empty table has no conversation and no node; a text of any length is one turn. A
conversation is one row of 20 bytes per turn, so it may have up to about 100 million turns. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import discard, map_arrow, stored, to_arrow

WIDTH = 16  # bytes of a turn id
NOTHING = hashlib.sha256(b"").digest()
IDS_IN_BLOCK = 50_000


@dataclass(frozen=True)
class Settings:
    container_turns: int = 4096  # more turns than that, of several sequences, burst
    shared_every: int = 100  # the conversation whose first turns a conversation begins with
    shared_most: int = 6


def rebuilt(conversations: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Per conversation ``conv``: ``seq`` (ids of its turns) and ``sizes`` (code points of their texts). It begins with the
    first turns of conversation ``conv - conv % shared_every``, as many as its id's checksum says, and goes on with its own."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turn = F.struct("turn", F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("id"),
                    F.char_length(text).alias("size"))
    own = (conversations.filter("conv_id is not null").groupBy(F.col("conv_id").alias("conv"))
           .agg(F.array_sort(F.collect_list(turn)).alias("t")))
    own = stored(own.select("conv", F.transform("t", lambda x: F.struct(x.id.alias("id"), x.size.alias("size"))).alias("t")), "turns")
    first = own.filter(F.col("conv") % s.shared_every == 0).select(
        F.col("conv").alias("base"), F.slice("t", 1, s.shared_most).alias("shared"))
    n = (F.crc32(F.col("conv").cast("string").cast("binary")) % s.shared_most).cast("int")
    both = own.withColumn("base", F.col("conv") - F.col("conv") % s.shared_every).join(first, "base", "left")
    none = F.array().cast("array<struct<id:string,size:int>>")
    turns = F.concat(F.slice(F.coalesce("shared", none), F.lit(1), n), F.slice("t", n + 1, F.greatest(F.size("t") - n, F.lit(0))))
    out = both.select("conv", turns.alias("t")).select(
        "conv", F.unhex(F.array_join("t.id", "")).alias("seq"), F.col("t.size").alias("sizes"))
    return stored(out, "sequences")


# -- collapse ----------------------------------------------------------------------

def _ends(rows: DataFrame) -> DataFrame:
    """Per ``key``: the number ``n`` of its ``conv`` ids, the smallest, and the digest ``ends`` of all in order."""
    ordered = rows.repartitionByRange("key", "conv").sortWithinPartitions("key", "conv")

    def pack(batches):
        key, ids = None, []

        def told():
            return pa.RecordBatch.from_pydict({"key": [key], "first": [ids[0]], "n": [len(ids)],
                                               "ids": [",".join(map(str, ids))]})
        for b in batches:
            for k, c in zip(b.column("key").to_pylist(), b.column("conv").to_pylist()):
                if k != key or len(ids) == IDS_IN_BLOCK:
                    if ids:
                        yield told()
                    key, ids = k, []
                ids.append(c)
        if ids:
            yield told()
    blocks = map_arrow(ordered, pack, "key binary, first bigint, n bigint, ids string")

    def digest(batches):
        key, conv, n, sha = None, None, 0, None

        def told():
            return pa.RecordBatch.from_pydict({"key": [key], "conv": [conv], "n": [n], "ends": [sha.digest()]})
        for b in batches:
            for k, first, m, ids in zip(*(b.column(c).to_pylist() for c in ("key", "first", "n", "ids"))):
                if k != key:
                    if sha:
                        yield told()
                    key, conv, n, sha = k, first, 0, hashlib.sha256()
                sha.update(((n > 0) * "," + ids).encode())
                n += m
        if sha:
            yield told()
    return map_arrow(blocks.repartition("key").sortWithinPartitions("key", "first"), digest,
                     "key binary, conv bigint, n bigint, ends binary")


def collapsed(sequences: DataFrame) -> DataFrame:
    """One row per distinct sequence: ``seq``, ``sizes``, the smallest ``conv``, their number ``n`` and their ``ends``."""
    keyed = sequences.select("conv", F.unhex(F.md5("seq")).alias("key"))
    return stored(sequences.join(_ends(keyed).drop("key"), "conv"), "collapsed")


# -- burst -------------------------------------------------------------------------

def _turns(c: str | Column = "seq") -> Column:
    return (F.octet_length(c) / WIDTH).cast("int")


def _prefix(depth: Column) -> Column:
    """Name of the container of the sequences that share their first ``depth`` turns."""
    return F.unhex(F.md5(F.substring(F.col("seq"), F.lit(1), depth * WIDTH)))


def _common(rows: DataFrame) -> DataFrame:
    """``rows`` with ``common``: how many first turns ``low`` and ``high`` share."""
    def run(batches):
        for b in batches:
            n = [shared(x, y, 0) for x, y in zip(b.column("low").to_pylist(), b.column("high").to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(n, pa.int32())], names=[*b.schema.names, "common"])
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return map_arrow(rows, run, schema + ", common int")


def shared(a: bytes, b: bytes, start: int) -> int:
    """How many first turns two sequences share, ``start`` of them known."""
    most, i = min(len(a), len(b)) // WIDTH, start
    while i < most and a[i * WIDTH:(i + 1) * WIDTH] == b[i * WIDTH:(i + 1) * WIDTH]:
        i += 1
    return i


def burst(sequences: DataFrame, s: Settings) -> tuple[list[DataFrame], list[DataFrame]]:
    """Per round: the heads that burst, and the sequences of containers that did not. A container is named by ``box``; ``depth``
    is its prefix, ``up`` and ``up_conv`` its head and that node's conversation."""
    heads, rest = [], []
    none = F.lit(None)
    now = sequences.select("seq", "sizes", "conv", "n", "ends", _prefix(F.lit(0)).alias("box"), F.lit(0).alias("depth"),
                           none.cast("binary").alias("up"), none.cast("bigint").alias("up_conv"))
    while True:
        sized = now.groupBy("box").agg(
            F.count(F.lit(1)).alias("rows"), F.sum(_turns() - F.col("depth")).alias("turns"))
        large = stored(sized.filter((F.col("rows") > 1) & (F.col("turns") > s.container_turns)).select("box"), "large-boxes")
        if large.isEmpty():
            discard(large)
            rest.append(now)
            return heads, rest
        rest.append(stored(now.join(large, "box", "left_anti"), "settled-boxes"))
        inner = now.join(large, "box")
        ends = inner.groupBy("box").agg(
            F.min("seq").alias("low"), F.max("seq").alias("high"), F.min("conv").alias("head_conv"), F.sum("n").alias("total"),
            F.min("depth").alias("depth"), F.min("up").alias("up"), F.min("up_conv").alias("up_conv"))
        head = stored(_common(ends), "trie-heads")
        split = inner.join(head.select("box", "common", "head_conv"), "box")
        # the low sequence tells the sizes of the chain's texts; if one ends at the head, it is this one
        low = inner.join(head.select("box", F.col("low").alias("seq")), ["box", "seq"]).select("box", "sizes", "ends", _turns().alias("len"))
        heads.append(stored(head.drop("low", "high").join(low, "box").select(
            "box", "depth", "up", "up_conv", "head_conv", "total", "common", F.slice("sizes", F.lit(1), F.col("common")).alias("sizes"),
            F.when(F.col("len") == F.col("common"), F.col("ends")).otherwise(F.lit(NOTHING)).alias("ends")), "trie-heads"))
        deeper = split.filter(_turns() > F.col("common")).select(
            "seq", "sizes", "conv", "n", "ends", _prefix(F.col("common") + 1).alias("box"), (F.col("common") + 1).alias("depth"),
            F.col("box").alias("up"), F.col("head_conv").alias("up_conv"))
        before, now = now, stored(deeper, "boxes")
        discard(large, head)
        if len(heads) > 1:
            discard(before)


# -- sweep -------------------------------------------------------------------------

NODE = ("conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
        "saved_tokens bigint, ends binary")
SWEPT = NODE + ", up binary, is_top boolean"


class _Open:
    """An open node: what its subtree holds so far."""
    __slots__ = ("size", "conv", "n", "children", "leaves", "saved", "ends", "below")

    def __init__(self, size: int):
        self.size, self.conv, self.n, self.children, self.leaves, self.saved = size, None, 0, 0, 0, 0
        self.ends, self.below = NOTHING, []


class _Sweep:
    """Nodes of one container, from its sequences in order."""

    def __init__(self, depth: int, up: bytes | None, up_conv: int | None):
        self.depth, self.up, self.up_conv = depth, up, up_conv
        self.path: list[_Open] = []
        self.last = b""
        self.told: list[tuple] = []

    def add(self, seq: bytes, sizes: list[int], conv: int, n: int, ends: bytes) -> None:
        start = self.depth
        if self.path:
            start = shared(self.last, seq, self.depth)
            while len(self.path) > start - self.depth + 1:
                self._close()
        else:
            self.path.append(_Open(sizes[start - 1] if start else 0))
        for size in sizes[start:]:
            self.path.append(_Open(size))
        node = self.path[-1]
        node.conv, node.n, node.ends = conv if node.conv is None else min(conv, node.conv), node.n + n, ends
        self.last = seq

    def _close(self) -> None:
        node, depth = self.path.pop(), self.depth + len(self.path)
        node.leaves = node.leaves or 1
        node.saved += (node.n - 1) * node.size
        # the children's parent is known by its smallest member, which is certain only now
        self.told += [(*row[:2], node.conv, *row[3:]) for row in node.below]
        row = (node.conv, depth, self.up_conv, node.n, node.children, node.leaves, node.saved, node.ends, self.up, not self.path)
        if not self.path:
            self.told.append(row)
            return
        over = self.path[-1]
        over.below.append(row)
        over.conv = node.conv if over.conv is None else min(over.conv, node.conv)
        over.n, over.children, over.leaves, over.saved = (over.n + node.n, over.children + 1, over.leaves + node.leaves,
                                                          over.saved + node.saved)

    def finish(self) -> list[tuple]:
        while self.path:
            self._close()
        return self.told


def swept(sequences: DataFrame) -> DataFrame:
    """The nodes of all containers; each container's top node carries its head, ``up``."""
    shards = sequences.repartition("box").sortWithinPartitions("box", "seq")
    to = to_arrow(SWEPT)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), to)], schema=to)

    def run(batches):
        box, sweep, rows = None, None, []
        for b in batches:
            names = ("box", "depth", "up", "up_conv", "seq", "sizes", "conv", "n", "ends")
            for x, depth, up, up_conv, *one in zip(*(b.column(c).to_pylist() for c in names)):
                if x != box or sweep is None:
                    rows += sweep.finish() if sweep else []
                    box, sweep = x, _Sweep(depth, up, up_conv)
                sweep.add(*one)
                if len(rows) > 20_000:
                    yield batch(rows)
                    rows = []
        rows += sweep.finish() if sweep else []
        if rows:
            yield batch(rows)
    return shards.select("box", "depth", "up", "up_conv", "seq", "sizes", "conv", "n", "ends").mapInArrow(run, SWEPT)


# -- heads -------------------------------------------------------------------------

def _chain(head: DataFrame, below: DataFrame) -> DataFrame:
    """The nodes of each head's chain. ``below``: ``up``, ``leaves`` and ``saved`` of each container under the heads."""
    sums = below.groupBy(F.col("up").alias("box")).agg(
        F.count(F.lit(1)).alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    j = head.join(sums, "box")
    levels = F.transform(F.sequence(F.col("depth"), F.col("common")), lambda d: F.struct(
        d.alias("d"), F.when(d > 0, F.get("sizes", d - 1)).otherwise(F.lit(0)).cast("bigint").alias("size")))
    nodes = j.select("box", "up", "up_conv", "head_conv", "total", "children", "leaves", "saved", "ends", "common",
                     F.col("depth").alias("top"), F.explode(levels).alias("l")).select("*", "l.d", "l.size")
    deeper = Window.partitionBy("box").orderBy(F.col("d").desc())
    nodes = nodes.withColumn("saved", F.col("saved") + F.sum((F.col("total") - 1) * F.col("size")).over(deeper))
    end, top = F.col("d") == F.col("common"), F.col("d") == F.col("top")
    return nodes.select(
        F.col("head_conv").alias("conv_id"), F.col("d").cast("bigint").alias("depth"),
        F.when(top, F.col("up_conv")).otherwise(F.col("head_conv")).alias("parent_conv_id"), F.col("total").alias("n_convs"),
        F.when(end, F.col("children")).otherwise(F.lit(1)).cast("bigint").alias("n_children"), F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.when(end, F.col("ends")).otherwise(F.lit(NOTHING)).alias("ends"), "up",
        top.alias("is_top"))


def nodes(sequences: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The trie's nodes over ``sequences`` (``conv``, ``seq``, ``sizes``): the columns of ``NODE``."""
    distinct = collapsed(sequences)
    heads, rest = burst(distinct, s)
    parts = [stored(swept(r), "trie-nodes") for r in rest]
    out, over = parts[-1], parts[-1]
    for head, part in zip(reversed(heads), reversed(parts[:-1])):
        below = over.filter("is_top").select("up", F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"))
        chain = stored(_chain(head, below), "trie-chains")
        over = part.unionByName(chain)
        out = out.unionByName(over)
    return out.drop("up", "is_top")


def conversation_trie(conversations: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations, with ``ends_sha256`` as text."""
    out = nodes(rebuilt(conversations, s), s)
    return out.select(*[c for c in out.columns if c != "ends"], F.lower(F.hex("ends")).alias("ends_sha256"))
