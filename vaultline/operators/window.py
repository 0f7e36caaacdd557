"""One row per key: first-seen (hubs, links) and latest version (satellites).

The reference expresses both as ``ROW_NUMBER() OVER (PARTITION BY k ORDER BY ts)
= 1``. Here they are a grouped ``min``/``max`` over a struct whose leading fields
are the ordering columns and whose trailing fields are the rest of the row:

* it is a total order (ties on the ordering columns are broken by the remaining
  columns), so the result is deterministic;
* the aggregate runs partially before the shuffle, so a key holding a third of
  all rows is reduced to one row per input partition before it is exchanged,
  instead of being sorted inside a single task as a window partition would be.

Null ordering follows Spark's struct ordering: a NULL field sorts first, so
``first_by`` prefers NULLs and ``latest_by`` ranks them last
(``ORDER BY ... ASC NULLS FIRST`` / ``DESC NULLS LAST`` in SQL).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

_PICK = "__pick"


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], agg) -> DataFrame:
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    fields = order + rest
    if not fields:
        return df.select(*keys).distinct()
    picked = df.groupBy(*keys).agg(agg(F.struct(*fields)).alias(_PICK))
    return picked.select(*[F.col(k) for k in keys],
                         *[F.col(f"{_PICK}.{c}").alias(c) for c in fields]
                         ).select(*df.columns)


def reduce_lead(df: DataFrame, keys: Sequence[str], lead: str, earliest: bool) -> DataFrame:
    """Collapse rows that agree on ``keys`` and every column but ``lead`` to one row
    holding the smallest (``earliest``) or largest ``lead``.

    The aggregate buffer is fixed-width, so Spark runs it as a hash aggregate with
    map-side combine (no sort). It leaves the result of ``first_by``/``latest_by``
    unchanged and shrinks their input to the distinct versions per key. NULLs
    follow the struct ordering: a NULL ``lead`` is the earliest value.
    """
    others = [c for c in df.columns if c not in keys and c != lead]
    c = F.col(lead)
    if earliest:
        v = F.when(F.max(c.isNull()), F.lit(None).cast(df.schema[lead].dataType)).otherwise(F.min(c))
    else:
        v = F.max(c)
    return df.groupBy(*keys, *others).agg(v.alias(lead)).select(*df.columns)


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str],
             reduce_first: bool = False) -> DataFrame:
    """Earliest row per key by ``order`` (ascending), ties broken by the other columns.

    ``reduce_first`` pre-collapses repeated versions with ``reduce_lead`` (worth it
    when many rows share a key's other columns, e.g. one row per reading).
    """
    if reduce_first and order:
        df = reduce_lead(df, keys, order[0], earliest=True)
    return _pick(df, keys, order, F.min)


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str],
              reduce_first: bool = False) -> DataFrame:
    """Latest row per key by ``order`` (descending), ties broken by the other columns."""
    if reduce_first and order:
        df = reduce_lead(df, keys, order[0], earliest=False)
    return _pick(df, keys, order, F.max)


_BYTES, _TEXT = "__bytes", "__text"


def _as_bytes(c: Column, dtype: DataType) -> list[Column]:
    """A value as it is shuffled: a hash in upper-case hex as its 16 bytes, as its text is twice that and does not compress, and any
    other one as it is. The two columns, of which at least one is NULL, are equal where the values are."""
    if not isinstance(dtype, StringType):
        return [F.lit(None).cast("binary").alias(_BYTES), c.alias(_TEXT)]
    is_hash = F.coalesce((F.length(c) == 32) & (F.translate(c, "0123456789ABCDEF", "") == ""), F.lit(False))
    return [F.when(is_hash, F.unhex(c)).alias(_BYTES), F.when(~is_hash, c).alias(_TEXT)]


def _as_text(struct: str) -> Column:
    """The value that ``_as_bytes`` has put into a struct."""
    raw, text = F.col(f"{struct}.{_BYTES}"), F.col(f"{struct}.{_TEXT}")
    return F.when(raw.isNotNull(), F.hex(raw).cast("string")).otherwise(text)


def change_points(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  value: str) -> DataFrame:
    """Rows whose ``value`` differs from the previous row of the same key.

    The history of a key is ordered by ``order`` and then by ``value`` and the
    remaining columns (a total order). Rows that agree on key, order and value can only
    repeat the first of them, so they are collapsed to it first (a grouped minimum, combined
    before the shuffle): a bulk load stamped with one time costs a row per value. A window over
    the key would sort a hot key's whole history in one task, so the history is cut into pieces of an hour.
    One window pass over (key, piece) gives each row its predecessor; the pieces, each with its first and last row, then
    feed a small window over the key that tells which of them start with another value than the one before ended with.
    Both passes carry key, order and value alone, and a value that is a hash goes there as bytes. What they find meets the collapsed rows by key, order and
    value, which is how these are partitioned already: the other columns are shuffled once. Rows with a NULL key
    are returned unchanged.
    """
    from pyspark.sql import Window

    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys and c not in order and c != value]
    at, piece = "__at", "__piece"
    keyed = None
    for k in keys:
        keyed = F.col(k).isNotNull() if keyed is None else keyed & F.col(k).isNotNull()
    # A row without a key has no history to compare with: it is returned as is.
    unkeyed = df.filter(~keyed)
    # Order and value as one struct: it is never NULL itself, and equal to another one with NULLs in the same places.
    sent, told = _as_bytes(F.col(value), df.schema[value].dataType), _as_text(at)
    placed = df.filter(keyed).select(*keys, F.struct(*order, *sent).alias(at), F.struct(*(rest or keys)).alias(_PICK))
    once = placed.groupBy(*keys, at).agg(F.min(_PICK).alias(_PICK))
    # The condition holds for every row. It keeps the picked row in this branch too, so that both share one exchange.
    hour = F.date_trunc("HOUR", F.col(f"{at}.{order[0]}"))
    points = once.filter(F.col(_PICK).isNotNull()).select(*keys, at).repartition(*keys, hour).withColumn(piece, hour)
    place = F.struct(*[F.col(f"{at}.{c}") for c in order], told.alias(value))  # what rows are ordered by
    w = Window.partitionBy(*keys, piece).orderBy("__place")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    points = (points.withColumn("__place", place).withColumn("__prev", F.lag("__place").over(w))
              .withColumn("__tail", F.last(at).over(whole)))
    inside = points.filter(F.col("__prev").isNotNull() & ~F.col(f"__place.{value}").eqNullSafe(F.col(f"__prev.{value}")))
    ends = points.filter(F.col("__prev").isNull()).select(*keys, at, "__tail").repartition(*keys)
    wk = Window.partitionBy(*keys).orderBy("__place")
    heads = (ends.withColumn("__place", place).withColumn("__prev", F.lag(_as_text("__tail")).over(wk))
             .withColumn("__pos", F.row_number().over(wk))
             .filter((F.col("__pos") == 1) | ~F.col(f"__place.{value}").eqNullSafe(F.col("__prev"))))
    found = inside.select(*keys, at).unionByName(heads.select(*keys, at))
    out = {**{c: F.col(c) for c in keys}, **{c: F.col(f"{at}.{c}") for c in order}, value: told,
           **{c: F.col(f"{_PICK}.{c}") for c in rest}}
    return once.join(found, [*keys, at], "left_semi").select(
        *[out[c].alias(c) for c in df.columns]).unionByName(unkeyed)
