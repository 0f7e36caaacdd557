"""Language-model scoring by Katz backoff.

The model has ``order`` orders (n-grams of 1 to ``order`` words). A word seen after a history keeps its Good-Turing
discounted share of the history's count; any other word shares what is left in proportion to its probability after the
history without its first word, recursively; a word never seen has the mass that the seen words gave up:

    p(w | h) = d(c(h, w)) c(h, w) / c(h)      if c(h, w) > 0
             = a(h) p(w | h without its first word)   if the history is known
             = p(w | h without its first word)        otherwise
    p(w)     = d(c(w)) c(w) / N, and 1 - sum of these for an unknown word
    a(h)     = (1 - sum of p(w | h) over words seen after h) / (1 - sum of p(w | shorter h) over these)

so every distribution sums to one exactly. The start of a text is a history of its own; longer histories begin there. Counts
over ``reliable`` lose the same absolute
amount as ``reliable`` does; each history therefore always leaves something. Copied documents put humps in
the counts of counts, so these are smoothed before ratios are taken (Simple Good-Turing: a line through their logarithms).
Only a count whose ratio still is not between 0 and 1 (no line, or one that falls too slowly: tiny
corpora) loses half a count instead.

How it runs:

1. Documents are read into blocks of about ``block_tokens`` tokens (whole documents), with tokens
   numbered within the block, and stored.
2. Each block sends its distinct n-grams of each order with their training counts to the
   partitions of the key space (one packed cell per block and partition). A partition adds the
   counts up, and stores its part of the count tables as answers in the order of the blocks' keys,
   with the counts of counts. Of the blocks that hold a key one is named its owner.
3. A block meets its answers and scores its documents as far as its own counts go. Owners send each n-gram's
   share of ``a(h)``; what is still missing is ``log a(h)`` for each order that a token backs off from, which are sent as
   (history, document, how often).
4. ``a(h)`` is a grouped sum, stored, and joined to those needs. A frequent history is summed up before its shuffle.

Memory per task is bounded by the block and by ``part_keys``. What is shuffled grows with the distinct
n-grams per block. They are told apart by 64-bit hashes.

Edge cases: null and empty texts are the end token alone; a text of any length is scored whole, within one block (it may
be longer than ``block_tokens``); an empty table gives no rows. Rows are scored one by one, so repeated rows (and
repeated or null ids) stay. Without any training document every probability is one. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .packed import pack, pack_keys, unpack, unpack_keys
from .tables import discard, stored, to_arrow

END, START = np.uint64(0), np.uint64(1)  # keys of the end token and of the start of a text
WORDS, PAIRS = 0, 1  # kinds of counts: order 1, order 2 and so on
PAIR_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    order: int = 2
    reliable: int = 5  # counts over it are not estimated by Good-Turing
    block_tokens: int = 500_000
    part_keys: int = 1_000_000  # of a partition of the key space, summed over blocks


def smoothed(seen: np.ndarray) -> np.ndarray:
    """Counts of counts on a line through them in log-log space (Simple Good-Turing); ones where no line
    that falls can be fitted. ``seen[c]``: how many types have count c (index 0 unused)."""
    n = np.asarray(seen, np.float64)
    c = np.arange(len(n))
    some = np.flatnonzero(n[1:] > 0) + 1
    if len(some) < 2:
        return np.ones(len(n))
    # a count stands for the empty ones around it too
    before, after = np.append(0, some[:-1]), np.append(some[1:], 2 * some[-1] - some[-2])
    slope, level = np.polyfit(np.log(some), np.log(2 * n[some] / (after - before)), 1)
    return np.exp(level + slope * np.log(np.maximum(c, 1))) if slope < 0 else np.ones(len(n))


def discounts(seen: np.ndarray, reliable: int) -> tuple[np.ndarray, float]:
    """Good-Turing ratios ``d`` of counts 1 to ``reliable`` (index 0 unused), and the absolute
    amount that larger counts lose. ``seen[c]``: how many types have count c, up to reliable + 1."""
    n, k = smoothed(seen[:reliable + 2]), reliable
    d = np.ones(k + 1)
    c = np.arange(1, k + 1)
    cut = (k + 1) * n[k + 1] / n[1]
    if cut < 1:
        d[1:] = ((c + 1) * n[2:k + 2] / (c * n[1:k + 1]) - cut) / (1 - cut)
    d[1:] = np.where((d[1:] > 0) & (d[1:] < 1), d[1:], (c - 0.5) / c)
    return d, k * (1 - d[k])


@dataclass
class Order:
    """One order of the model: counts of counts and what they imply."""
    types: int
    total: int
    d: np.ndarray
    over: float
    lost: float  # counts that discounting takes off, over all types

    @classmethod
    def of(cls, stats: np.ndarray, reliable: int) -> Order:
        seen = np.concatenate([[0], stats[2:]])
        d, over = discounts(seen, reliable)
        c = np.arange(reliable + 1)
        low = seen[:reliable + 1]
        return cls(int(stats[0]), int(stats[1]), d, over,
                   float((low * c * (1 - d)).sum() + (stats[0] - low.sum()) * over))

    @property
    def unknown(self) -> float:
        """Probability of a type never seen."""
        return self.lost / self.total if self.total else 1.0

    def kept(self, c: np.ndarray) -> np.ndarray:
        """Discounted counts."""
        k = len(self.d) - 1
        return np.where(c > k, c - self.over, c * self.d[np.minimum(c, k)])


def blocks(docs: DataFrame, training: Column, s: Settings) -> DataFrame:
    """Blocks of documents: ``block``, the arrays ``doc_id``, ``train`` and ``n`` (tokens) and, packed,
    the block's ascending word keys ``keys`` and every token's place among them ``ids``."""
    given = docs.select("doc_id", training.alias("train"), F.col("text").cast("string").alias("text"))
    kind = given.schema["doc_id"].dataType.simpleString()
    schema = f"block long, doc_id array<{kind}>, train array<boolean>, n array<int>, keys binary, ids binary"
    to = to_arrow(schema)

    def run(batches):
        number, held, size = 0, [], 0

        def block():
            keys, ids = np.unique(np.concatenate([h for *_, h, _ in held]), return_inverse=True)
            cols = [pa.array([(TaskContext.get().partitionId() << 24) + number], pa.int64())]
            for j, f in ((0, to.field("doc_id")), (1, to.field("train"))):
                cols.append(pa.array([[x for part in held for x in part[j].to_pylist()]], f.type))
            n = np.concatenate([m for *_, m in held])
            cols += [pa.array([n.astype(np.int32)], to.field("n").type), pa.array([pack_keys(keys)]),
                     pa.array([pack(ids.astype(np.uint32))])]
            return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, to)], schema=to)

        for part in (x for batch in batches for x in W.slices(batch, "text")):
            flat, off = W.split(part.column("text"), lower=True)
            ids, distinct = W.numbered(flat)
            n = np.diff(off) + 1  # and the end
            tokens = np.full(int(n.sum()), END, np.uint64)
            word = np.ones(len(tokens), bool)
            word[np.cumsum(n) - 1] = False
            h = W.hashed(distinct)
            tokens[word] = np.where(h > START, h, h + np.uint64(2))[ids] if len(ids) else 0
            held.append((part.column("doc_id"), part.column("train"), tokens, n))
            size += len(tokens)
            if size >= s.block_tokens:
                yield block()
                number, held, size = number + 1, [], 0
        if held:
            yield block()
    return stored(given.mapInArrow(run, schema), "lm-blocks")


class Grams:
    """The distinct n-grams of one order in a block. ``at``: positions that end one; ``place``: which; ``history``: key
    of the n-gram without its last word; ``first``: a position of each distinct one."""

    def __init__(self, keys: np.ndarray, at: np.ndarray, history: np.ndarray):
        self.at, self.history = at, history
        self.keys, first, self.place = np.unique(keys, return_index=True, return_inverse=True)
        self.first = at[first]


class Block:
    """The tokens of one block, its distinct n-grams, and who is who."""

    def __init__(self, n, train, keys: bytes, ids: bytes, order: int):
        self.n = np.asarray(n, np.int64)
        self.keys, self.ids = unpack_keys(keys), unpack(ids, np.uint32).astype(np.int64)
        self.doc = np.repeat(np.arange(len(self.n)), self.n)
        self.train = np.asarray(train, bool)[self.doc]
        starts = np.cumsum(self.n) - self.n
        pos = np.arange(len(self.ids)) - starts[self.doc]
        token = self.keys[self.ids]
        shorter = token  # key of the n-gram of the order before that ends at each position
        self.grams: list[Grams] = []
        for m in range(2, order + 1):
            history = np.full(len(token), START)
            history[1:][pos[1:] > 0] = shorter[:-1][pos[1:] > 0]
            at = np.flatnonzero(pos >= m - 2)  # the start of a text is the shortest history
            longer = np.zeros(len(token), np.uint64)
            longer[at] = W.mixed(history[at] * PAIR_MIX + token[at])
            self.grams.append(Grams(longer[at], at, history))
            shorter = longer
        self.starts = pos == 0

    def counts(self) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """Keys and training counts of each order."""
        out = {WORDS: (self.keys, np.bincount(self.ids[self.train], minlength=len(self.keys)))}
        for k, g in enumerate(self.grams, PAIRS):
            out[k] = (g.keys, np.bincount(g.place[self.train[g.at]], minlength=len(g.keys)))
        return out


def _cut(keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Partitions of the key space that hold some of the ascending keys, and their edges."""
    part = ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    at = np.flatnonzero(np.diff(part)) + 1
    edges = np.concatenate([[0], at, [len(keys)]])
    return part[edges[:-1]].astype(np.int64), edges


def counted(held: DataFrame, parts: int, s: Settings) -> DataFrame:
    """The count tables, partition by partition of the key space: rows of ``block``, ``kind``, ``part``, ``n``
    (counts in the order of the block's keys) and ``owner``; and per partition a row without
    block whose ``stats`` are types, total, and types of count 1 to ``reliable`` + 1."""
    sent = "part long, kind int, block long, keys binary, n binary"
    to = to_arrow(sent)

    def send(batches):
        for b in batches:
            for row in b.to_pylist():
                rows = []
                block = Block(row["n"], row["train"], row["keys"], row["ids"], s.order)
                for kind, (keys, n) in block.counts().items():
                    if not len(keys):  # texts too short for the order
                        continue
                    part, edges = _cut(keys, parts)
                    for i, p in enumerate(part.tolist()):
                        a, z = edges[i], edges[i + 1]
                        rows.append({"part": s.order * p + kind, "kind": kind, "block": row["block"],
                                     "keys": pack_keys(keys[a:z]), "n": pack(n[a:z].astype(np.uint32))})
                yield pa.RecordBatch.from_pylist(rows, schema=to)

    out = "block long, kind int, part long, n binary, owner binary, stats array<long>"
    back = to_arrow(out)
    k = s.reliable

    def add(t: pa.Table) -> pa.Table:
        t = t.sort_by("block")
        cells = [unpack_keys(x) for x in t.column("keys").to_pylist()]
        n = np.concatenate([unpack(x, np.uint32) for x in t.column("n").to_pylist()])
        keys, first, place = np.unique(np.concatenate(cells), return_index=True, return_inverse=True)
        total = np.bincount(place, n, len(keys)).astype(np.int64)
        owner = np.zeros(len(place), bool)
        owner[first] = True
        answer, edges = total[place], np.cumsum([0] + [len(c) for c in cells])
        kind, part = t.column("kind")[0].as_py(), t.column("part")[0].as_py()
        rows = [{"block": b, "kind": kind, "part": part, "n": pack(answer[a:z].astype(np.uint64)),
                 "owner": pack(owner[a:z])}
                for b, a, z in zip(t.column("block").to_pylist(), edges[:-1], edges[1:])]
        stats = np.bincount(np.minimum(total, k + 2), minlength=k + 3)
        rows.append({"block": None, "kind": kind, "part": part, "stats":
                     [int((total > 0).sum()), int(total.sum()), *stats[1:k + 2].tolist()]})
        return pa.Table.from_pylist(rows, schema=back)

    cells = held.select("block", "train", "n", "keys", "ids").mapInArrow(send, sent)
    return stored(cells.groupBy("part").applyInArrow(add, out), "lm-counts")


def orders(counts: DataFrame, s: Settings) -> dict[int, Order]:
    """Discounts of all orders, from the partitions' counts of counts (summed up by Spark)."""
    got = (counts.filter("block is null").select("kind", F.posexplode("stats").alias("i", "x"))
           .groupBy("kind", "i").agg(F.sum("x").alias("x")).collect())
    stats = {kind: np.zeros(s.reliable + 3, np.int64) for kind in range(s.order)}
    for r in got:
        stats[r.kind][r.i] = r.x
    return {kind: Order.of(x, s.reliable) for kind, x in stats.items()}


def score(docs: DataFrame, training: Column, s: Settings = Settings()) -> DataFrame:
    """``doc_id``, ``train``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of each document,
    by the model of those where ``training`` holds."""
    held = blocks(docs, training, s)
    tokens = held.agg(F.sum(F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    counts = counted(held, max(1, -(-tokens // s.part_keys)), s)
    model = orders(counts, s)
    one = model[WORDS]
    kind = held.schema["doc_id"].dataType.elementType.simpleString()
    schema = (f"what int, block long, i int, doc_id {kind}, train boolean, n_tokens long, n_known long, base double, "
              "part double, history long, n long, left double, beneath double")
    to = to_arrow(schema)

    def frame(rows: int, **cols) -> pa.Table:
        return pa.Table.from_arrays([pa.array(cols[f.name]).cast(f.type) if f.name in cols
                                     else pa.nulls(rows, f.type) for f in to], schema=to)

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        b = Block(row["n"], row["train"], row["keys"], row["ids"], s.order)
        right = right.sort_by([("kind", "ascending"), ("part", "ascending")])
        got = {k: ([], []) for k in range(s.order)}
        for k, n, own in zip(*(right.column(c).to_pylist() for c in ("kind", "n", "owner"))):
            got[k][0].append(unpack(n, np.uint64))
            got[k][1].append(unpack(own, np.bool_))
        count = [np.concatenate([np.zeros(0, np.uint64), *got[k][0]]).astype(np.int64) for k in range(s.order)]
        word = count[WORDS]

        base = np.log10((word + 1) / (one.total + one.types + 1))
        p = np.where(word > 0, one.kept(word) / max(one.total, 1), one.unknown)  # of each distinct word
        texts = word[0]  # the end token's key is the lowest; as often as it, a text starts
        below, log_p = p[b.ids], np.log10(p)[b.ids]  # of each token, by the orders so far
        ended = word[b.ids]  # how often what ends at each position was seen
        shares, needs = [], []
        for k, g in enumerate(b.grams, PAIRS):
            c = np.zeros(len(b.ids), np.int64)
            c[1:] = ended[:-1]
            c[b.starts] = texts
            seen = count[k] > 0
            now = np.zeros(len(b.ids), np.int64)
            now[g.at] = count[k][g.place]
            use = np.concatenate([np.zeros(0, bool), *got[k][1]]) & seen  # what this block owns
            at = g.first[use]
            kept = model[k].kept(count[k][use])
            shares.append((g.history[at], (count[k][use] - kept) / np.maximum(c[at], 1), below[at]))
            direct = now > 0
            miss = np.flatnonzero(~direct & (c > 0) & (np.bincount(g.at, minlength=len(b.ids)) > 0))
            needs.append((b.doc[miss], g.history[miss]))
            below = np.where(direct, model[k].kept(now) / np.maximum(c, 1), below)
            log_p = np.where(direct, np.log10(np.where(direct, below, 1)), log_p)
            ended = now
        d = len(b.n)
        docs = frame(d, what=np.zeros(d, np.int32), block=np.full(d, row["block"]), i=np.arange(d),
                     doc_id=row["doc_id"], train=row["train"], n_tokens=b.n,
                     n_known=np.bincount(b.doc, word[b.ids] > 0, d).astype(np.int64),
                     base=np.bincount(b.doc, base[b.ids], d), part=np.bincount(b.doc, log_p, d))

        key, left, beneath = (np.concatenate(x) for x in zip(*shares)) if shares else (np.zeros(0, np.uint64),) * 3
        hs, at = np.unique(key.view(np.int64), return_inverse=True)
        shared = frame(len(hs), what=np.full(len(hs), 1, np.int32), history=hs,
                       left=np.bincount(at, left, len(hs)), beneath=np.bincount(at, beneath, len(hs)))

        owing, key = (np.concatenate(x) for x in zip(*needs)) if needs else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
        need, n = np.unique(np.stack([owing, key.view(np.int64)], axis=1), axis=0, return_counts=True)
        needed = frame(len(need), what=np.full(len(need), 2, np.int32), block=np.full(len(need), row["block"]),
                       i=need[:, 0], history=need[:, 1], n=n)
        return pa.concat_tables([docs, shared, needed])

    answers = counts.filter("block is not null").select("block", "kind", "part", "n", "owner")
    told = stored(held.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(meet, schema),
                  "lm-scores")
    discard(held, counts)
    weights = (told.filter("what = 1").groupBy("history")
               .agg(F.sum("left").alias("left"), F.sum("beneath").alias("beneath"))
               .select("history", F.log10(F.col("left") / (1 - F.col("beneath"))).alias("weight")))
    backed = (told.filter("what = 2").select("block", "i", "history", "n").join(weights, "history")
              .groupBy("block", "i").agg(F.sum(F.col("n") * F.col("weight")).alias("backed")))
    return (told.filter("what = 0").join(backed, ["block", "i"], "left")
            .select("doc_id", "train", "n_tokens", "n_known", F.lit(one.total).cast("long").alias("train_tokens"),
                    F.col("base").alias("base_score"),
                    (F.col("part") + F.coalesce("backed", F.lit(0.0))).alias("score")))
