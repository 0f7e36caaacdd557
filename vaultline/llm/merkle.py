"""Merkle manifest of a dataset, with an inclusion proof (witness) for every row.

A row's leaf is a digest of its fields. Per group (``source``) the leaves, in order of their key, form a
tree: every ``arity`` consecutive nodes of a level (the last run may be shorter, even one node) are hashed into
one, until one is left, the subroot. The subroots, in order of the group, form the root's tree likewise.

Witnesses are built incrementally. Leaves are appended one by one to a stack of open runs, one run per level.
A leaf starts with an empty witness, which stays attached to the open subtree it belongs to. When a sibling
completes a run, the witness of each leaf below its members is extended by the run's other members, and the run's
digest is appended one level up. So no tree is kept: at any time a task holds the open runs and the witnesses
of one block.

Spark cuts the leaves of a group into blocks of ``arity ** block_levels``, aligned so that a block is a subtree. Blocks
are appended side by side, wherever they lie; the roots of the blocks of a group are then leaves of a further append, cut into
blocks in turn, until one block holds a whole group. A leaf's witness is its witness within the
block, and then that of the block's root. The subroots are the last append, over one group.

A witness is ``siblings`` (their raw digests, level by level, left to right) and ``shape`` (per level a
byte: place in the run, and members of the run). ``folded`` recomputes a root from a leaf and a witness.

Edge cases: a null field is ``-`` and an empty one has length 0, so they differ; a null group is a group of its own and
comes first; a null key comes first within its group; rows with equal keys are all leaves, in order
of their digests; rows alike in all are told apart by their place only, and their proofs may come in either order. A text
of any length is hashed where it lies and never moved. An empty table has no rows and no root. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import discard, map_arrow, stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


@dataclass(frozen=True)
class Settings:
    arity: int = 3
    block_levels: int = 7  # a block has arity ** block_levels leaves

    @property
    def block(self) -> int:
        return self.arity ** self.block_levels


def digest(parts: Sequence[Column]) -> Column:
    """Raw digest of the concatenated texts."""
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def field(c: Column) -> Column:
    """``-`` if null, else the number of UTF-8 bytes, a colon, and the value."""
    c = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c))


def leaf(replaced: dict[str, Column] | None = None) -> Column:
    """The leaf of a row of documents, with some fields replaced."""
    return digest([field((replaced or {}).get(c, F.col(c))) for c in FIELDS])


class Appender:
    """Streaming append of digests: open runs by level, and the leaves' partial witnesses."""

    def __init__(self, arity: int):
        self.arity = arity
        self.open: list[list[tuple[bytes, int, int]]] = []  # per level: digest, first leaf, end
        self.siblings: list[bytearray] = []
        self.shapes: list[bytearray] = []

    def append(self, leaf: bytes) -> None:
        n = len(self.siblings)
        self.siblings.append(bytearray())
        self.shapes.append(bytearray())
        self._put(0, (leaf, n, n + 1))

    def _put(self, level: int, node: tuple[bytes, int, int]) -> None:
        if level == len(self.open):
            self.open.append([])
        self.open[level].append(node)
        if len(self.open[level]) == self.arity:
            self._complete(level)

    def _complete(self, level: int) -> None:
        """The run's digest goes one level up; what is below its members learns of the others."""
        run, self.open[level] = self.open[level], []
        for place, (_, first, end) in enumerate(run):
            others = b"".join(d for j, (d, _, _) in enumerate(run) if j != place)
            for x in range(first, end):
                self.siblings[x] += others
                self.shapes[x].append(place * 16 + len(run))
        up = hashlib.sha256("".join(d.hex() for d, _, _ in run).encode()).digest()
        self._put(level + 1, (up, run[0][1], run[-1][2]))

    def finish(self, levels: int) -> bytes:
        """Complete what is open up to ``levels``; the one node that is left there."""
        for level in range(levels):
            if level < len(self.open) and self.open[level]:
                self._complete(level)
        return self.open[levels][0][0]


def levels_of(n: int, arity: int) -> int:
    """Levels of a tree over ``n`` nodes."""
    out = 0
    while n > 1:
        n, out = -(-n // arity), out + 1
    return out


def _blocks(nodes: DataFrame, s: Settings) -> DataFrame:
    """``nodes`` with their ``block``, their witness within it (``siblings``, ``shape``) and the block's root
    (``top``). ``nodes`` has ``member`` (number of the group), ``idx`` within it, ``total`` and ``digest``."""
    rows = nodes.withColumn("block", F.floor(F.col("idx") / s.block))
    rows = rows.repartition("member", "block").sortWithinPartitions("member", "block", "idx")
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema]
                       + ["siblings binary", "shape binary", "top binary"])

    def grown(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.concat_batches(held)
        total, appender = table.column("total")[0].as_py(), Appender(s.arity)
        for d in table.column("digest").to_pylist():
            appender.append(d)
        # one block is the whole tree, or one node at its level among others
        top = appender.finish(levels_of(total, s.arity) if total <= s.block else s.block_levels)
        more = (map(bytes, appender.siblings), map(bytes, appender.shapes), [top] * table.num_rows)
        return pa.RecordBatch.from_arrays([*table.columns, *(pa.array(x, pa.binary()) for x in more)],
                                          names=[*table.schema.names, "siblings", "shape", "top"])

    def run(batches):
        held, at = [], None
        for b in batches:
            member, block = (b.column(c).to_numpy() for c in ("member", "block"))
            edges = np.flatnonzero((np.diff(member) != 0) | (np.diff(block) != 0)) + 1
            for x, z in zip([0, *edges.tolist()], [*edges.tolist(), b.num_rows]):
                if z > x:
                    if held and (member[x], block[x]) != at:
                        yield grown(held)
                        held = []
                    at = (member[x], block[x])
                    held.append(b.slice(x, z - x))
        if held:
            yield grown(held)
    return map_arrow(rows, run, schema)


def climb(nodes: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame]:
    """The nodes with their witnesses within their blocks, and per block (``member``, ``block``) the rest of the
    way: ``more`` siblings, the ``rest`` of the shape, and the group's root ``top``. Both are stored. While a group has
    several blocks, their roots are appended in turn."""
    grown = stored(_blocks(nodes, s), "merkle-blocks")
    first = grown.filter(F.col("idx") % s.block == 0)
    if (grown.agg(F.max("total")).first()[0] or 0) <= s.block:
        empty = F.lit(b"")
        return grown, stored(first.select("member", "block", empty.alias("more"), empty.alias("rest"), "top"), "merkle-tops")
    roots = stored(first.select("member", F.col("block").alias("idx"), F.ceil(F.col("total") / s.block).alias("total"),
                                F.col("top").alias("digest")), "merkle-roots")
    over, tops = climb(roots, s)
    out = stored(over.drop("top").join(tops, ["member", "block"]).select(
        "member", F.col("idx").alias("block"), F.concat("siblings", "more").alias("more"),
        F.concat("shape", "rest").alias("rest"), "top"), "merkle-tops")
    discard(roots, over, tops)
    return grown, out


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``member`` (the group's number, in its order), ``idx`` (place within the group) and ``total`` (rows of the
    group); stored. The rows are sorted over all partitions, so a group may span any number of them; what is counted
    and summed up is one row per partition and group."""
    ordered = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    ordered = stored(ordered.withColumn("at", F.monotonically_increasing_id()), "merkle-order")
    part = F.shiftright("at", 33)
    runs = ordered.groupBy(group, part.alias("part")).agg(F.min("at").alias("from"), F.count(F.lit(1)).alias("n"))
    over = Window.partitionBy(group)
    before = F.sum("n").over(over.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    # a group's number is the place of its first row
    runs = runs.select(group, "part", "from", F.sum("n").over(over).alias("total"),
                       F.coalesce(before, F.lit(0)).alias("before"), F.min("from").over(over).alias("member"))
    o, r = ordered.withColumn("part", part).alias("o"), runs.alias("r")
    out = o.join(r, [F.col(f"o.{group}").eqNullSafe(F.col(f"r.{group}")), F.col("o.part") == F.col("r.part")])
    out = stored(out.select(*[F.col(f"o.{c}") for c in rows.columns], "r.member",
                            (F.col("o.at") - F.col("r.from") + F.col("r.before")).alias("idx"), "r.total"), "merkle-leaves")
    discard(ordered)
    return out


def manifest(leaves: DataFrame, group: str = "source", key: Sequence[str] = ("doc_id",),
             s: Settings = Settings()) -> DataFrame:
    """``leaves`` (whose column ``digest`` is the leaf) with ``siblings`` and ``shape`` (the witness up to the
    root), ``subroot`` and ``root``, as raw digests. ``leaves`` must give the same rows each time it is read."""
    nodes = numbered(leaves, group, key)
    grown, tops = climb(nodes, s)
    subroots = tops.filter("block = 0").select(F.col("member").alias("group"), F.col("top").alias("digest"), F.lit(0).alias("all"))
    groups = numbered(subroots, "all", ["group"])
    inner, outer = climb(groups, s)
    over = inner.drop("top").join(outer, ["member", "block"]).select(
        F.col("group").alias("member"), F.concat("siblings", "more").alias("last"), F.concat("shape", "rest").alias("end"),
        F.col("top").alias("root"))
    ways = stored(tops.join(over, "member").select(
        "member", "block", F.concat("more", "last").alias("more"), F.concat("rest", "end").alias("rest"),
        F.col("top").alias("subroot"), "root"), "merkle-ways")
    discard(nodes, tops, groups, inner, outer)
    return grown.join(ways, ["member", "block"]).select(
        *leaves.columns, F.concat("siblings", "more").alias("siblings"), F.concat("shape", "rest").alias("shape"),
        "subroot", "root")


def text_of(d: Column) -> Column:
    return F.lower(F.hex(d))


def folded(start: Column, siblings: Column, shape: Column) -> Column:
    """The root (as text) that a leaf and a witness lead to."""
    steps = F.sequence(F.lit(1), F.octet_length(shape))
    steps = F.when(F.octet_length(shape) > 0, steps).otherwise(F.array().cast("array<int>"))

    def step(acc, i):
        code = F.conv(F.hex(F.substring(shape, i, F.lit(1))), 16, 10).cast("int")
        place, others = F.floor(code / 16).cast("int"), code % 16 - 1
        left = text_of(F.substring(siblings, acc.at, place * 32))
        right = text_of(F.substring(siblings, acc.at + place * 32, (others - place) * 32))
        return F.struct(F.sha2(F.concat(left, acc.node, right).cast("binary"), 256).alias("node"),
                        (acc.at + others * 32).alias("at"))
    return F.aggregate(steps, F.struct(text_of(start).alias("node"), F.lit(1).alias("at")), step, lambda a: a.node)


def tampered(docs: DataFrame) -> Column:
    """The planted fault: where 2 divides crc32 of the decimal id, the text loses its line breaks."""
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    text = F.col("text").cast("string")
    return F.when(hit, leaf({"text": F.replace(text, F.lit("\n"), F.lit(""))})).otherwise(leaf())


def proofs(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Of each document: ``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root`` (of the tampered rows) and ``verified``."""
    leaves = stored(docs.select("doc_id", "source", leaf().alias("digest"), tampered(docs).alias("found"),
                                F.monotonically_increasing_id().alias("row")), "merkle-digests")
    told = manifest(leaves, "source", ("doc_id", "digest", "row"), s)
    return told.select(
        "doc_id", text_of(F.col("digest")).alias("leaf"), text_of(F.col("subroot")).alias("subroot"),
        text_of(F.col("root")).alias("root"),
        F.sha2(text_of(F.col("siblings")).cast("binary"), 256).alias("proof_sha256"),
        folded(F.col("found"), F.col("siblings"), F.col("shape")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
