"""View state that is kept up to date batch by batch.

A fold is a grouped aggregate whose measures merge (counts, sums, minima, maxima). Its result is stored in key
buckets. A new batch is aggregated by itself, merged with the buckets it touches, and those are replaced; the rows folded
before are never read again.

Counts and sums must not take a batch twice. Batches are numbered, ascending; each bucket's rows carry the number of the
batch folded last, so a batch that is run again skips the buckets that have it. Buckets are
replaced through a generation and a pending note, so an interrupted replacement is finished by the next read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_path, scratch_path
from .sinks import read_or_none, replace_partitions

BUCKET = "key_bucket"
BUCKETS = 256
LAST = "folded"

# How a measure of a batch is merged with the stored one.
MERGE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


@dataclass(frozen=True)
class Fold:
    """``measures``: name -> (kind, column). A count counts rows where its column is true."""
    name: str
    keys: tuple[str, ...]
    measures: dict[str, tuple[str, Column]] = field(hash=False)

    def partial(self, rows: DataFrame) -> DataFrame:
        def measure(kind: str, c: Column) -> Column:
            return F.count_if(c) if kind == "count" else MERGE[kind](c)
        return rows.groupBy(*self.keys).agg(*[measure(k, c).alias(n) for n, (k, c) in self.measures.items()])

    def merged(self, parts: DataFrame, *more: str) -> DataFrame:
        return parts.groupBy(*self.keys, *more).agg(*[MERGE[k](n).alias(n) for n, (k, _) in self.measures.items()])


def _bucketed(df: DataFrame, keys) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int"))


def state_path(root: str, f: Fold) -> str:
    return f"{root.rstrip('/')}/{f.name}__state"


def folded(spark: SparkSession, root: str, f: Fold) -> DataFrame | None:
    """The fold of all batches so far; None before the first."""
    state = read_or_none(spark, state_path(root, f))
    return None if state is None else state.select(*f.keys, *f.measures)


def fold(spark: SparkSession, root: str, f: Fold, rows: DataFrame, batch: int) -> int:
    """Fold ``rows``, the batch of that number, into the stored state; returns how many buckets changed. At most
    ``BUCKETS`` bucket numbers reach the driver."""
    path, scratch = state_path(root, f), scratch_path(spark, f"{f.name}-fold")
    _bucketed(f.partial(rows), f.keys).write.parquet(scratch)
    part = spark.read.parquet(scratch)
    try:
        touched = {r[0] for r in part.select(BUCKET).distinct().collect()}
        state = read_or_none(spark, path)
        if state is not None:
            near = state.filter(F.col(BUCKET).isin(sorted(touched)))
            touched -= {r[0] for r in near.groupBy(BUCKET).agg(F.max(LAST).alias("b")).filter(F.col("b") >= batch).collect()}
        if not touched:
            return 0
        now = F.col(BUCKET).isin(sorted(touched))
        parts = part.filter(now)
        if state is not None:
            parts = parts.unionByName(state.filter(now).drop(LAST))
        replace_partitions(spark, f.merged(parts, BUCKET).withColumn(LAST, F.lit(batch).cast("long")), path, [BUCKET])
        return len(touched)
    finally:
        delete_path(spark, scratch)


def meter_reads() -> Fold:
    """Last read and number of readings per meter: the state behind the legacy meters view."""
    return Fold("meter_reads", ("asset_id",), {"last_read": ("max", F.col("interval_end")), "readings": ("count", F.lit(True))})


def quality_reads() -> Fold:
    """Readings by quality and status: the state behind the quality report."""
    return Fold("quality_reads", ("quality_code", "reading_status"), {"reading_count": ("count", F.lit(True))})
