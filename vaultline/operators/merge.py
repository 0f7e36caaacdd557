"""What a merge may take from its source: one row per key.

A MERGE is defined only where each target row meets at most one source row. Repeats of the same row are harmless and
collapse. Rows that share a key but differ are a conflict: no rule of the merge says which is right, so
either the merge fails, or a stated order picks one and the others are handed back with a reason. A row with a
NULL in its key can match nothing, now or at a later delivery; it is handed back as well.

Each key's row and whether it is contested (by hashes of its rows) come from one grouped pass, combined before the
shuffle; only rows of contested keys are looked at again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON = "reject_reason"
CONFLICT = "CONFLICTING_KEY"
NO_KEY = "NULL_KEY"


class MergeConflict(ValueError):
    """A merge source has several different rows for a key, or rows without one."""


def _keyed(keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).isNotNull()
    return out


def contested_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys that rows of different content share, with ``n_rows``."""
    both = {"__a": F.xxhash64(*source.columns), "__b": F.xxhash64(F.lit(1), *source.columns)}
    hashed = source.filter(_keyed(keys)).select(*keys, *[c.alias(n) for n, c in both.items()])
    groups = hashed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), *[
        f(c).alias(f"{f.__name__}{c}") for c in both for f in (F.min, F.max)])
    return groups.filter("min__a <> max__a OR min__b <> max__b").select(*keys, "n_rows")


CONTESTED = "__contested"


def settled(source: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key of ``source``, the last by ``order`` and then by the other columns, and ``__contested``: whether rows
    of different content share the key. One grouped pass; rows with a NULL in the key are left out."""
    keys, order = list(keys), [c for c in order if c not in keys]
    fields = order + [c for c in source.columns if c not in keys and c not in order]
    if not fields:
        return source.filter(_keyed(keys)).distinct().withColumn(CONTESTED, F.lit(False))
    hashes = (F.xxhash64(*source.columns), F.xxhash64(F.lit(1), *source.columns))
    differs = F.lit(False)
    for h in hashes:
        differs = differs | (F.min(h) != F.max(h))
    picked = source.filter(_keyed(keys)).groupBy(*keys).agg(F.max(F.struct(*fields)).alias("__last"), differs.alias(CONTESTED))
    return picked.select(*keys, *[F.col(f"__last.{c}").alias(c) for c in fields], CONTESTED).select(*source.columns, CONTESTED)


def conflict_losers(source: DataFrame, winners: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows of ``source`` that lost to the row of their key in ``winners`` (the ``settled`` rows of contested keys), and
    those without a key, each once, with their ``reject_reason``."""
    rows = source.filter(_keyed(keys)).join(winners.select(*keys), list(keys), "left_semi").distinct()
    r, k = rows.alias("r"), winners.alias("k")
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"k.{c}")) for c in source.columns]
    losers = r.join(k, same, "left_anti").select("r.*", F.lit(CONFLICT).alias(REASON))
    unkeyed = source.filter(~_keyed(keys)).distinct().withColumn(REASON, F.lit(NO_KEY))
    return losers.unionByName(unkeyed)


def split_conflicts(source: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """``(clean, rejected)``: one row per key, the last by ``order`` and then by the other columns, and all other rows
    of different content with their ``reject_reason``. Together they hold every distinct row of ``source``."""
    kept = settled(source, keys, order)
    return kept.drop(CONTESTED), conflict_losers(source, kept.filter(CONTESTED).drop(CONTESTED), keys)


def require_one_row_per_key(source: DataFrame, keys: Sequence[str]) -> None:
    """Raises ``MergeConflict`` (with some of the keys) if the source is not fit for a merge."""
    found = contested_keys(source, keys).limit(5).collect()
    if found:
        raise MergeConflict(f"different rows share a merge key {list(keys)}, e.g. {[tuple(r) for r in found]}")
    if not source.filter(~_keyed(keys)).isEmpty():
        raise MergeConflict(f"rows have no merge key: NULL in one of {list(keys)}")
