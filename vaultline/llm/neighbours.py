"""Approximate nearest neighbours by a permutation index.

A vector is represented by the order in which it sees a fixed set of pivots, nearest first. It is
posted in the inverted files of its ``post`` nearest pivots; a query visits
the files of its ``probe`` nearest ones. In a file, candidates are ranked by footrule distance,
the sum over the query's ``prefix`` nearest pivots of how many places apart a pivot stands in both
orders; the best ``rerank`` share (at least ``least`` of them) is reranked by the exact inner
product in double precision. Orders tell directions only, and a long vector wins inner products from afar: a row
longer than the mean length is posted in as many times more files as it is longer (so there are at most about
twice as many posts, however lengths vary), and candidates are ranked by length times how far their
footrule distance is below that of an unrelated order, an estimate of the inner product. A pair that meets in several files is dealt with in the one
of the lowest pivot only.

There are ``per_root * sqrt(rows)`` pivots, a bounded share of the rows, chosen by the digest of their
ids; so files grow with the root of the table, and a query's work does too. The pivots are the only thing sent to all
tasks. A file longer than ``file_rows`` is dealt out over several groups, and so are its queries: a very
common vector fills no single task. A query that found fewer than ``k`` is searched again against all
rows, in blocks, so the result never lacks rows.

Edge cases: vectors that are null, all zero, hold null or non-finite components, or have another length
than most take no part, as rows without an id don't. Of rows with equal ids the smallest
vector counts. Ties go to the smaller id. Other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import stored, to_arrow


@dataclass(frozen=True)
class Settings:
    k: int = 20
    per_root: float = 1.5
    least_pivots: int = 32
    post: int = 16
    probe: int = 24
    prefix: int = 64
    rerank: float = 0.5
    least: int = 100
    file_rows: int = 4_000
    file_queries: int = 1_000


def usable(table: DataFrame) -> DataFrame:
    """``vec_id`` and ``v`` (array of float as given, else of double) of the rows that take part."""
    given = table.schema["embedding"].dataType.simpleString()
    v = F.col("embedding").cast(given if given == "array<float>" else "array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = table.select("vec_id", v.alias("v")).filter("vec_id is not null and v is not null").filter(
        fine & F.exists("v", lambda x: x != 0))
    rows = rows.groupBy("vec_id").agg(F.min("v").alias("v"))
    return rows


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), dim).astype(np.float64)


class Pivots:
    """The pivots, scaled to length one, and orders of them. ``usual``: mean length of the rows."""

    def __init__(self, vectors: np.ndarray, usual: float):
        self.p = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        self.usual = usual

    def posts(self, x: np.ndarray, s: Settings) -> np.ndarray:
        """How many files hold each vector."""
        times = np.linalg.norm(x, axis=1) / self.usual if 0 < self.usual < math.inf else np.ones(len(x))
        most = max(s.post, len(self.p))
        return np.clip(np.rint(s.post * np.minimum(times, most)), s.post, most).astype(np.int32)

    def unrelated(self, prefix: int) -> float:
        """Mean footrule distance of orders that have nothing to do with each other."""
        place = np.arange(len(self.p))
        return float(sum(np.abs(place - i).mean() for i in place[:prefix]))

    def places(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pivots by nearness of each vector, and each pivot's place in that order."""
        order = np.argsort(-(x @ self.p.T), axis=1, kind="stable").astype(np.int32)
        place = np.empty_like(order)
        np.put_along_axis(place, order, np.arange(len(self.p), dtype=np.int32)[None, :], axis=1)
        return order, place


SLICE_CELLS = 4_000_000  # rows x pivots whose orders a task holds at once


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest scores, ties to the smaller id."""
    if len(scores) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        few = np.flatnonzero(scores >= edge)
    else:
        few = np.arange(len(scores))
    return few[np.lexsort((ids[few], -scores[few]))][:k]


def search(table: DataFrame, is_query: Column, s: Settings = Settings()) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the ``k`` nearest rows found of each query."""
    rows = stored(usable(table), "vectors")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    lengths = rows.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n"),
                                                         F.avg(F.sqrt(square)).alias("usual"))
    common = lengths.orderBy(F.col("n").desc(), "dim").first()
    dim, n = (common.dim, common.n) if common else (1, 0)
    rows = rows.filter(F.size("v") == dim)
    many = max(s.least_pivots, math.ceil(s.per_root * math.sqrt(n)))
    chosen = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(many).collect()  # bounded by the root of n
    # the mean without its last digits, which depend on the order of summing
    pivots = (Pivots(np.array([r.v for r in chosen], np.float64).reshape(-1, dim), float(f"{common.usual:.9g}"))
              if chosen else None)

    def post(batches):
        # the orders of a slice's rows take 24 bytes a row and pivot: bounded by SLICE_CELLS, not by the batch
        rows_at_once = max(1, SLICE_CELLS // max(1, len(pivots.p) if pivots else 1))
        for b in (batch.slice(i, rows_at_once) for batch in batches for i in range(0, batch.num_rows, rows_at_once)):
            b = b.take(pa.array(np.arange(b.num_rows)))
            x = _matrix(b.column("v"), dim)
            q = b.column("is_query").to_numpy(zero_copy_only=False)
            near = pivots.places(x)[0]
            held = np.arange(near.shape[1]) < pivots.posts(x, s)[:, None]
            a, z = near[held], near[q][:, :s.probe]
            row = np.concatenate([np.nonzero(held)[0], np.repeat(np.flatnonzero(q), z.shape[1])])
            pivot, asks = np.concatenate([a, z.ravel()]).astype(np.int32), np.arange(len(row)) >= a.size
            for i in range(0, len(row), 200_000):  # a batch of long vectors has many
                out = b.select(["vec_id", "v"]).take(pa.array(row[i:i + 200_000]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pivot[i:i + 200_000]), pa.array(asks[i:i + 200_000]), *out.columns],
                    names=["pivot", "asks", "vec_id", "v"])

    kind, real = (rows.schema[c].dataType.simpleString() for c in ("vec_id", "v"))
    marked = rows.withColumn("is_query", F.coalesce(is_query, F.lit(False)))
    posted = marked.mapInArrow(post, f"pivot int, asks boolean, vec_id {kind}, v {real}")
    sizes = posted.groupBy("pivot").agg(
        F.greatest(F.lit(1), F.ceil(F.sum((~F.col("asks")).cast("int")) / s.file_rows)).cast("int").alias("a"),
        F.greatest(F.lit(1), F.ceil(F.sum(F.col("asks").cast("int")) / s.file_queries)).cast("int").alias("b"))
    found = stored(_meet(posted, sizes, pivots, dim, kind, s), "neighbours")

    # the rest, exactly: queries with fewer than k found, against all rows in blocks
    lacking = (marked.filter("is_query").join(found.groupBy(F.col("query_id").alias("vec_id"))
                                              .agg(F.count(F.lit(1)).alias("got")), "vec_id", "left")
               .filter(F.coalesce("got", F.lit(0)) < min(s.k, n - 1)).select("vec_id", "v"))
    lacking = stored(lacking, "lacking")
    if not lacking.isEmpty():
        blocks = max(1, math.ceil(n / s.file_rows))
        whole = (marked.select(F.lit(0).alias("pivot"), F.lit(False).alias("asks"), "vec_id", "v")
                 .unionByName(lacking.select(F.lit(0).alias("pivot"), F.lit(True).alias("asks"), "vec_id", "v")))
        some = math.ceil(lacking.count() / s.file_queries)
        size = lacking.sparkSession.range(1).select(F.lit(0).alias("pivot"), F.lit(blocks).alias("a"),
                                                    F.lit(some).alias("b"))
        found = (found.join(lacking.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti")
                 .unionByName(_meet(whole, size, None, dim, kind, s)))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= s.k)
            .select("query_id", "rank", "vec_id", "score"))


def _meet(posted: DataFrame, sizes: DataFrame, pivots: Pivots | None, dim: int, kind: str,
          s: Settings) -> DataFrame:
    """The ``k`` best of each group of each file for each of its queries. Without pivots, every
    row of the group is a candidate."""
    # file rows and queries are dealt out over a grid of groups: (a row group, a query group)
    dealt = posted.join(sizes, "pivot").withColumn("h", F.abs(F.xxhash64("vec_id")))
    mine = F.when(F.col("asks"), F.col("h") % F.col("b")).otherwise(F.col("h") % F.col("a"))
    other = F.sequence(F.lit(0), F.when(F.col("asks"), F.col("a")).otherwise(F.col("b")) - 1)
    dealt = dealt.withColumn("mine", mine.cast("int")).withColumn("other", F.explode(other)).select(
        "pivot", "asks", "vec_id", "v",
        F.when(F.col("asks"), F.col("other")).otherwise(F.col("mine")).alias("row_group"),
        F.when(F.col("asks"), F.col("mine")).otherwise(F.col("other")).alias("query_group"))
    schema = f"query_id {kind}, vec_id {kind}, score double"
    to = to_arrow(schema)

    def near(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        asks = t.column("asks").to_numpy()
        ids = t.column("vec_id").to_numpy()
        x = _matrix(pa.concat_arrays(t.column("v").chunks), dim)
        qid, cid, qx, cx = ids[asks], ids[~asks], x[asks], x[~asks]
        out = [], [], []
        if len(qid) and len(cid):
            eligible = None
            if pivots is not None:
                file = t.column("pivot")[0].as_py()
                qo, qp = pivots.places(qx)
                co, cp = pivots.places(cx)
                # pairs that also meet in the file of a lower pivot belong there
                low_q = ((qp < s.probe)[:, :file]).astype(np.float32)
                low_c = ((cp < pivots.posts(cx, s)[:, None])[:, :file]).astype(np.float32)
                eligible = low_q @ low_c.T == 0
                small = np.int16 if s.prefix * len(pivots.p) < 2 ** 15 else np.int32  # holds any footrule
                by_pivot, steps = np.ascontiguousarray(cp.T, small), np.arange(s.prefix, dtype=small)[:, None]
                length, unrelated = np.linalg.norm(cx, axis=1), pivots.unrelated(s.prefix)
            for i in range(len(qid)):
                ok = cid != qid[i]
                if eligible is not None:
                    ok &= eligible[i]
                at = np.flatnonzero(ok)
                keep = max(s.least, math.ceil(s.rerank * len(at)))
                if eligible is not None and len(at) > keep:
                    top = qo[i, :s.prefix]
                    apart = by_pivot[top]
                    apart -= steps[:len(top)]
                    footrule = np.abs(apart, out=apart).sum(0, dtype=small)[at]
                    at = at[np.argpartition((footrule - unrelated) * length[at], keep)[:keep]]
                score = cx[at] @ qx[i]
                best = _best(score, cid[at], s.k)
                out[0].append(np.full(len(best), qid[i]))
                out[1].append(cid[at][best])
                out[2].append(score[best])
        cols = [np.concatenate(c) if c else np.zeros(0) for c in out]
        return pa.Table.from_arrays([pa.array(c).cast(f.type) for c, f in zip(cols, to)], schema=to)

    return dealt.groupBy("pivot", "row_group", "query_group").applyInArrow(near, schema)
