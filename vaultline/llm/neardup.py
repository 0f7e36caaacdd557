"""Near-duplicate documents by SetSketch.

A document's set is its distinct 5-word shingles. Its sketch has ``bands * rows`` registers: register j is
the exponentially spaced, truncated minimum of the j-th hash over the set,
``K = clip(floor(1 + log_b(a) - log_b(h)), 0, 255)`` with h exponentially distributed. Registers of a union are
the maxima of registers, and two sets agree in a register with about their Jaccard similarity.

1. Documents with equal sets form one class; from here on each class has one representative.
2. Bands of registers name buckets. Two sets with similarity 0.85 miss each other in all 48 bands of 8
   with probability below 1e-6.
3. In each bucket every member is paired with one of them (a star), the one with the largest share of
   shingles that other candidates have too and, of these, with the most company: an original rather than an edited copy. For a pair, the counts of
   registers that are larger, smaller and equal give the maximum-likelihood similarity (the set sizes are known); pairs
   that it puts clearly below the threshold go, by ``slack`` = seven standard deviations. The rest are verified on the full sets.
4. Connected components of the confirmed links settle most buckets: all members in one component. Members of the other
   buckets are paired across components if they share a shingle of their prefixes, the rarest shingles that
   hold at least one common one of any link, and estimated and verified too, so no link is lost to the star. What documents of one
   template have in common is frequent, and makes no pairs.

A pair is only made if its sets could be linked at all: shingles that no other candidate has
cannot be common, which bounds the similarity from above without looking at the pair.

Buckets are counted before they are joined; a class of equal sets never meets itself. Sets are
read again from the texts only for documents that share a bucket, and move only for pairs that the estimate leaves.

Edge cases: an empty table gives no rows; a text of any length is read whole; null, empty and blank texts have no shingles and link with nothing; a text of fewer words is one shingle.
Repeated rows have equal sets. A null ``doc_id`` is never the smallest one; a component without any id
has a null ``component_id``, and its documents are kept if they are alone. Other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .graph import components
from .tables import WORD, discard, map_arrow, stored


@dataclass(frozen=True)
class Settings:
    size: int = 5  # words of a shingle
    percent: int = 85  # least similarity of a link
    bands: int = 48
    rows: int = 8
    base: float = 1.1  # spacing of the registers
    rate: float = 20.0  # a: shifts them so that small sets are not truncated
    slack: float = 0.13

    @property
    def registers(self) -> int:
        return self.bands * self.rows


def shingles(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all shingles of each text, in order, and each text's offset."""
    flat, off = W.split(texts, lower=True)
    ids, distinct = W.numbered(flat)
    h = W.hashed(distinct)[ids] if len(ids) else np.zeros(0, np.uint64)
    n = np.diff(off)
    start, doc = W.windows(ids, off, size)
    full = W.rolled(h, start, size)
    short = np.flatnonzero((n > 0) & (n < size))
    few = np.array([W.rolled(h, off[d:d + 1], n[d])[0] for d in short], np.uint64)
    count = np.bincount(doc, minlength=len(n))
    count[short] = 1
    edges = np.concatenate([[0], np.cumsum(count)])
    out = np.empty(edges[-1], np.uint64)
    is_short = np.zeros(len(out), bool)
    is_short[edges[short]] = True
    out[~is_short], out[is_short] = full, few
    return out, edges


class Sketcher:
    def __init__(self, s: Settings):
        self.s = s
        i = np.arange(s.registers, dtype=np.uint64)
        self.times = (W.mixed(i + np.uint64(1)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
        self.plus = (W.mixed(i + np.uint64(1_000_003)) >> np.uint64(32)).astype(np.uint32)

    def registers(self, h: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """A row of registers for each text that has shingles, in order."""
        x = (h >> np.uint64(32)).astype(np.uint32)
        starts = edges[:-1][np.diff(edges) > 0]
        low = np.empty((self.s.registers, len(starts)), np.uint32)
        for j in range(self.s.registers):
            low[j] = np.minimum.reduceat(x * self.times[j] + self.plus[j], starts)
        u = (low.T.astype(np.float64) + 0.5) / 2.0 ** 32
        k = np.floor(1 + (math.log(self.s.rate) - np.log(-np.log1p(-u))) / math.log(self.s.base))
        return np.clip(k, 0, 255).astype(np.uint8)


def likely(more: np.ndarray, less: np.ndarray, same: np.ndarray, n: np.ndarray, m: np.ndarray,
           base: float) -> np.ndarray:
    """Maximum-likelihood similarity of sets with sizes ``n`` and ``m`` from how many registers of the first are
    larger, smaller and equal. The likelihood is unimodal; its top is found by golden section."""
    u, v = n / (n + m), m / (n + m)

    def log_likelihood(j):
        def p(x):
            return -np.log1p(-np.clip(x, 0, 1) * (base - 1) / base) / math.log(base)
        up, down = p(u - v * j), p(v - u * j)
        tiny = 1e-12
        return (more * np.log(np.maximum(up, tiny)) + less * np.log(np.maximum(down, tiny))
                + same * np.log(np.maximum(1 - up - down, tiny)))
    lo, hi = np.zeros(len(u)), np.minimum(u / v, v / u)
    g = (math.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        right = log_likelihood(a) < log_likelihood(b)
        lo, hi = np.where(right, a, lo), np.where(right, hi, b)
    return (lo + hi) / 2


def sketches(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``row`` (number of the row), ``doc_id``, ``text_hash``, ``n`` (set size), ``h1`` and ``h2`` (digest of the set) and
    ``registers`` (null without shingles) of each document; stored."""
    text = F.col("text").cast("string")
    given = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64(text).alias("text_hash"),
                        text.alias("text"))
    kind = given.schema["doc_id"].dataType.simpleString()

    def run(batches):
        sketcher = Sketcher(s)
        for b in (x for batch in batches for x in W.slices(batch, "text", 1 << 20)):
            h, edges = shingles(b.column("text"), s.size)
            n, digest = _sets(h, edges)
            some = np.diff(edges) > 0
            regs = [None] * b.num_rows
            if some.any():
                for i, r in zip(np.flatnonzero(some).tolist(), sketcher.registers(h, edges)):
                    regs[i] = r.tobytes()
            yield pa.record_batch({
                "row": b.column("row"), "doc_id": b.column("doc_id"), "text_hash": b.column("text_hash"),
                "n": pa.array(n), "h1": pa.array(digest[0]), "h2": pa.array(digest[1]),
                "registers": pa.array(regs, pa.binary())})
    return stored(map_arrow(given, run, f"row long, doc_id {kind}, text_hash long, n long, h1 long, h2 long, "
                                        "registers binary"), "sketches")


def _sets(h: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Size and 128-bit digest of each text's set."""
    n, digest = np.zeros(len(edges) - 1, np.int64), np.zeros((2, len(edges) - 1), np.int64)
    for i, (a, z) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
        if z > a:
            own = np.unique(h[a:z])
            n[i] = len(own)
            digest[:, i] = np.frombuffer(xxhash.xxh3_128_digest(own.tobytes()), np.int64)
    return n, digest


def _full_sets(docs: DataFrame, wanted: DataFrame, s: Settings) -> DataFrame:
    """``h1``, ``h2`` and ``items`` (the set, ascending) of the documents whose ``text_hash`` is wanted."""
    text = F.col("text").cast("string")
    given = docs.select(F.xxhash64(text).alias("text_hash"), text.alias("text"))
    # a sort-merge join at every size: nothing bounds the number of wanted texts
    given = given.join(wanted.hint("merge"), "text_hash", "left_semi")

    def run(batches):
        for b in (x for batch in batches for x in W.slices(batch, "text", 1 << 20)):
            h, edges = shingles(b.column("text"), s.size)
            _, digest = _sets(h, edges)
            own = [np.unique(h[a:z]).view(np.int64) for a, z in zip(edges[:-1], edges[1:])]
            at = np.cumsum([0] + [len(x) for x in own]).astype(np.int32)
            yield pa.record_batch({"h1": pa.array(digest[0]), "h2": pa.array(digest[1]), "items": pa.ListArray.from_arrays(
                pa.array(at), pa.array(np.concatenate(own) if own else np.zeros(0, np.int64)))})
    return map_arrow(given, run, "h1 long, h2 long, items array<long>")


def _possible(na: Column, sa: Column, nb: Column, sb: Column, s: Settings) -> Column:
    """Whether two sets of sizes ``na`` and ``nb`` can be linked if only ``sa`` and ``sb`` of their shingles
    occur in any other set."""
    common = F.least(sa, sb)
    return common * 100 >= (na + nb - common) * s.percent


def _estimated(pairs: DataFrame, held: DataFrame, s: Settings) -> DataFrame:
    """The pairs ``a``, ``b`` whose similarity may reach the threshold, by likelihood."""
    one = held.select(F.col("row").alias("a"), F.col("n").alias("na"), F.col("registers").alias("ra"))
    two = held.select(F.col("row").alias("b"), F.col("n").alias("nb"), F.col("registers").alias("rb"))
    return _likely(pairs.join(two, "b").join(one, "a"), s)


def _likely(pairs: DataFrame, s: Settings) -> DataFrame:
    """Of pairs with their sizes ``na``, ``nb`` and registers ``ra``, ``rb``, the likely ones: ``a``, ``b``."""
    def run(batches):
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(-1, s.registers)
                    for c in ("ra", "rb"))
            more, less = (x > y).sum(1), (x < y).sum(1)
            n, m = (b.column(c).to_numpy().astype(np.float64) for c in ("na", "nb"))
            j = likely(more, less, s.registers - more - less, n, m, s.base)
            yield b.select(["a", "b"]).filter(pa.array(j >= s.percent / 100 - s.slack))
    return map_arrow(pairs.select("a", "b", "na", "nb", "ra", "rb"), run, "a long, b long")


def _least(sizes: Column, times: int, by: int) -> Column:
    """``sizes * times / by``, rounded up."""
    return F.floor((sizes * times + (by - 1)) / by)


def _prefixes(docs: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """``docs`` times the shingles that a link must share one of (prefix filter), with their place ``at``.

    Shingles are in one order for all, the rare ones first. Two sets with ``least`` shingles in common share one of
    the first ``n - least + 1`` of each. ``least`` is ``percent`` of the size at the least, and more for the smaller set of a
    pair, whose prefix is ``short``. Shingles that only one document has take their place in the order, and need no row."""
    items = sets.join(docs.select("row"), "row", "left_semi").select("row", F.explode("items").alias("item"))
    often = items.groupBy("item").agg(F.count(F.lit(1)).alias("often")).filter("often > 1")
    order = items.join(often, "item").groupBy("row").agg(F.array_sort(F.collect_list(F.struct("often", "item"))).alias("shared"))
    n = F.col("n")
    own = n - F.size("shared")
    long, short = (n - least + 1 for least in (_least(n, s.percent, 100), _least(n, 2 * s.percent, 100 + s.percent)))
    first = F.slice("shared", F.lit(1), F.greatest(long - own, F.lit(0)).cast("int"))
    placed = docs.join(order, "row").select(*docs.columns, own.alias("own"), short.alias("short_to"),
                                            F.posexplode(first).alias("i", "x"))
    at = F.col("own") + F.col("i") + 1
    return placed.select(*docs.columns, F.col("x.item").alias("item"), at.alias("at"), (at <= F.col("short_to")).alias("short"))


def _verified(pairs: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """The pairs that are links by their full sets."""
    one = sets.select(F.col("row").alias("a"), F.col("items").alias("ia"))
    two = sets.select(F.col("row").alias("b"), F.col("items").alias("ib"))
    both = pairs.join(two, "b").join(one, "a").select(
        "a", "b", (F.size("ia") + F.size("ib")).alias("total"), F.size(F.array_intersect("ia", "ib")).alias("common"))
    return both.filter(F.col("common") * 100 >= (F.col("total") - F.col("common")) * s.percent).select("a", "b")


def classes(drawn: DataFrame) -> DataFrame:
    """One row per distinct set: ``h1``, ``h2``, ``n`` and the first ``row`` that has it."""
    return drawn.filter("n > 0").groupBy("h1", "h2", "n").agg(F.min("row").alias("row"))


def links(docs: DataFrame, drawn: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Components of the linked classes: ``node`` (a class's row) and ``label``; classes without links are absent."""
    reps = stored(classes(drawn), "set-classes")
    sketch = drawn.select("row", "n", "text_hash", "h1", "h2", "registers").join(reps.select("row"), "row", "left_semi")
    # sets of up to 5 shingles have no other set within reach
    least = math.ceil(s.percent / (100 - s.percent))
    bands = F.transform(F.sequence(F.lit(0), F.lit(s.bands - 1)), lambda j: F.xxhash64(
        F.substring(F.col("registers"), j * s.rows + 1, F.lit(s.rows)), j))
    keyed = sketch.filter(F.col("n") >= least).select("row", F.explode(bands).alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    met = stored(keyed.join(shared, "key").select("key", "size", "row"), "buckets")
    rows = met.select("row").distinct()
    held = stored(sketch.join(rows, "row", "left_semi"), "bucket-sketches")
    full = _full_sets(docs, held.select("text_hash").distinct(), s).dropDuplicates(["h1", "h2"])
    sets = stored(held.select("row", "h1", "h2").join(full, ["h1", "h2"]).select("row", "items"), "bucket-sets")

    # shingles of one candidate only, counted by their owner
    own = (sets.select("row", F.explode("items").alias("item")).groupBy("item")
           .agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("row")).filter("n = 1")
           .groupBy("row").agg(F.count(F.lit(1)).alias("own")))
    company = met.groupBy("row").agg(F.sum("size").alias("company"))  # how many others its buckets hold
    known = held.join(own, "row", "left").join(company, "row").select(
        "row", "n", (F.col("n") - F.coalesce("own", F.lit(0))).alias("common"), "company")
    members = stored(met.drop("size").join(known, "row"), "bucket-members")
    hubs = members.groupBy("key").agg(F.max(F.struct(
        (F.col("common") / F.col("n")).alias("share"), "company", (-F.col("row")).alias("least"), "n", "common"))
        .alias("hub"))
    star = members.join(hubs, "key").filter(F.col("row") != -F.col("hub.least")).filter(
        _possible(F.col("n"), F.col("common"), F.col("hub.n"), F.col("hub.common"), s))

    def confirmed(estimated: DataFrame, name: str) -> DataFrame:
        return stored(_verified(stored(estimated, name + "-estimated"), sets, s), name + "-links")

    pairs = star.select((-F.col("hub.least")).alias("a"), F.col("row").alias("b")).distinct()
    near = confirmed(_estimated(pairs, held, s), "star")
    label = components(near)
    placed = members.join(label.select(F.col("node").alias("row"), "label"), "row", "left").withColumn(
        "label", F.coalesce("label", "row"))
    open_ = placed.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x != y").select("key")
    # one row per document of an open bucket; what it may share with another one that it is linked with is in its prefix
    rest = stored(placed.join(open_, "key", "left_semi").select("row", "label", "n", "common").distinct(), "open-documents")
    posts = stored(_prefixes(rest, sets, s), "prefixes")
    one, two = (posts.select("item", *[F.col(c).alias(c + x) for c in ("row", "label", "n", "common", "at", "short")]) for x in ("a", "b"))
    least = _least(F.col("na") + F.col("nb"), s.percent, 100 + s.percent)
    behind = 1 + F.least(F.col("na") - F.col("ata"), F.col("nb") - F.col("atb"))  # this shingle and all after it
    cross = one.filter("shorta").join(two, "item").filter(
        (F.struct("na", "rowa") < F.struct("nb", "rowb")) & (F.col("labela") != F.col("labelb")) & (behind >= least)
        & _possible(F.col("na"), F.col("commona"), F.col("nb"), F.col("commonb"), s))
    cross = cross.select(F.col("rowa").alias("a"), F.col("rowb").alias("b")).distinct()
    out = components(near.unionByName(confirmed(_estimated(cross, held, s), "cross")))
    discard(reps, met, held, sets, members, rest, posts)
    return out


def near_duplicates(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``doc_id``, ``text_hash``, ``row``, ``n_shingles``, ``component_id`` and ``kept`` of each document."""
    drawn = sketches(docs, s)
    label = links(docs, drawn, s)
    reps = classes(drawn).join(label.withColumnRenamed("node", "row"), "row", "left").select(
        "h1", "h2", "n", F.coalesce("label", "row").alias("group"))
    placed = drawn.drop("registers").join(reps, ["h1", "h2", "n"], "left")
    placed = placed.withColumn("group", F.coalesce("group", F.col("row")))
    first = placed.groupBy("group").agg(F.min("doc_id").alias("component_id"),
                                        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"))
    return placed.join(first, "group").select(
        "doc_id", "text_hash", "row", F.col("n").alias("n_shingles"), "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
        (F.col("row") == F.col("first.row")).alias("first_of_group"))


def without_near_duplicates(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The documents with one of each group (the smallest id's), and all that have no words, with all their columns."""
    text = F.col("text").cast("string")
    stay = near_duplicates(docs, s).filter("first_of_group and n_shingles > 0").select(
        F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")).distinct()
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("id"),
                    F.xxhash64(text).alias("hash"), F.coalesce(F.regexp_like(text, F.lit(WORD)), F.lit(False)).alias("some"))
    l, r = d.alias("l"), stay.alias("r")
    one = (l.filter("some").join(r, F.col("l.id").eqNullSafe(F.col("r.id")) & (F.col("l.hash") == F.col("r.hash")),
                                 "left_semi").dropDuplicates(["id", "hash"]))
    out = one.unionByName(d.filter("not some"))
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
