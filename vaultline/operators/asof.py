"""Facts joined to the version that was in force at their time.

``as_of_join`` is no range join. Facts and versions of a key are put in one sequence by time, and a
fact takes the last version before it. A window over the key would sort a hot key's facts in one task, so time is
cut into pieces: a window over (key, piece) sees the facts and versions of one piece, and one more row that opens it,
the version in force when the piece begins. Openings come from a window over the key's versions and the pieces in which it has
facts, one row each; so a key's facts are never together anywhere. The pieces are told where the facts lie already, and openings and
versions are dealt to them there: the fact is shuffled once.

``timeline`` makes versions out of raw dimension rows; ``chained`` composes the timelines of a child and its
parent at dimension grain, so that a chain of dimensions costs the fact one join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.temporal import ntz_literal
from .window import latest_by

VALID_FROM = "valid_from"
# A key's first version is in force from the beginning; facts without a time stand at the end.
BEGIN = "0001-01-01 00:00:00"
END = "9000-01-01 00:00:00"
END_PIECES = 64  # facts without a time are spread over so many pieces, all opened by the current version


def timeline(versions: DataFrame, key: str, changed: str, order: Sequence[str] = ()) -> DataFrame:
    """One row per key and time, with ``valid_from``: the time of the change, or ``BEGIN`` for a key's first version.

    Of several rows of one time the last by ``order`` (then by the other columns) is in force. A
    version without a time counts as first. Rows with a NULL key are left out: nothing can refer to them.
    """
    rows = versions.filter(F.col(key).isNotNull())
    at = F.coalesce(F.col(changed), ntz_literal(BEGIN))
    # dealt by key at once, as the window below needs it: the versions are shuffled once
    once = latest_by(rows.withColumn(VALID_FROM, at).repartition(key), [key, VALID_FROM], list(order))
    place = F.row_number().over(Window.partitionBy(key).orderBy(VALID_FROM))
    return once.withColumn(VALID_FROM, F.when(place == 1, ntz_literal(BEGIN)).otherwise(F.col(VALID_FROM))).select(
        *versions.columns, VALID_FROM)


def _piece(at: Column, unit: str) -> Column:
    return F.date_trunc(unit, at).cast("timestamp_ntz")


def as_of_join(facts: DataFrame, versions: DataFrame, key: str, fact_time: str, unit: str = "DAY",
               how: str = "inner") -> DataFrame:
    """All columns of ``facts`` and those of the version (a ``timeline`` by ``key``) in force at ``fact_time``, the
    moment of the change included.

    ``unit`` is the length of a piece of time. A fact without a time takes the current version. A fact whose key has no version, or is
    NULL, is dropped by ``how="inner"`` and kept with NULLs by ``"left"``. Other columns of the two must differ in name.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', not {how!r}")
    rest = [c for c in versions.columns if c != key]
    clash = set(rest) & set(facts.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    payload = [c for c in rest if c != VALID_FROM]
    days = F.pmod(F.xxhash64(*[F.col(c) for c in facts.columns]), F.lit(END_PIECES)).cast("int")
    at = F.coalesce(F.col(fact_time), F.timestamp_add("DAY", days, ntz_literal(END)))
    keyed = facts.filter(F.col(key).isNotNull())
    f = keyed.select(F.col(key).alias("__key"), at.alias("__at"), F.struct(*[c for c in facts.columns if c != key]).alias("__fact"))
    # a version without other columns is its time alone: all but the fact then is of fixed width
    held = F.struct(VALID_FROM, *payload) if payload else F.col(VALID_FROM)
    v = versions.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("__key"), F.col(VALID_FROM).alias("__at"), held.alias("__version"))
    spot = ["__key", "__piece"]
    v = v.withColumn("__piece", _piece(F.col("__at"), unit))
    f = f.withColumn("__piece", _piece(F.col("__at"), unit)).repartition(*spot)

    # a piece with facts opens with the last version before it: in the line it comes before the versions that begin in it
    none = F.lit(None).cast(v.schema["__version"].dataType)
    # the hash is there in every group. It keeps all columns of the facts in this branch too, so that both share one exchange
    asked = f.groupBy(*spot).agg(F.max(F.xxhash64(*f.columns)).alias("__any")).filter(F.col("__any").isNotNull()).select(
        *spot, F.lit(None).cast("timestamp_ntz").alias("__at"), none.alias("__version"))
    line = asked.unionByName(v.select(*spot, "__at", "__version"))
    earlier = Window.partitionBy("__key").orderBy("__piece", F.col("__at").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    openings = (line.withColumn("__open", F.last("__version", ignorenulls=True).over(earlier))
                .filter(F.col("__at").isNull() & F.col("__open").isNotNull())
                .select(*spot, F.lit(None).cast("timestamp_ntz").alias("__at"), F.col("__open").alias("__version")))

    no_fact = F.lit(None).cast(f.schema["__fact"].dataType).alias("__fact")
    columns = [*spot, "__at", "__fact", "__version"]
    together = (f.select(*spot, "__at", "__fact", none.alias("__version"))
                .unionByName(v.select(*spot, "__at", "__version").repartition(*spot).select(*spot, "__at", no_fact, "__version"))
                .unionByName(openings.repartition(*spot).select(*spot, "__at", no_fact, "__version"))).select(*columns)
    # a version that begins at a fact's time comes before the fact
    order = Window.partitionBy("__key", "__piece").orderBy(F.col("__at").asc_nulls_first(), F.col("__fact").isNotNull())
    found = (together.withColumn("__in_force", F.last("__version", ignorenulls=True)
                                 .over(order.rowsBetween(Window.unboundedPreceding, 0)))
             .filter(F.col("__fact").isNotNull()))
    if how == "inner":
        found = found.filter(F.col("__in_force").isNotNull())
    one = {c: F.col(f"__in_force.{c}") if payload else F.col("__in_force") for c in rest}
    whole = [F.col("__key").alias(c) if c == key else F.col(f"__fact.{c}").alias(c) for c in facts.columns]
    out = found.select(*whole, *[held_in.alias(c) for c, held_in in one.items()])
    if how == "left":
        types = {x.name: x.dataType for x in versions.schema}
        out = out.unionByName(facts.filter(F.col(key).isNull()).select(
            "*", *[F.lit(None).cast(types[c]).alias(c) for c in rest]))
    return out


def chained(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """The timeline of ``children`` with their parent's columns: a version begins where the child or its parent
    changes, and holds both from then on. Both are timelines, at dimension grain; ``parent_key`` is the child's reference.

    Versions meet by an equi-join on the reference, as far as their validities overlap.
    """
    def spans(df: DataFrame, key: str, name: str) -> DataFrame:
        until = F.lead(VALID_FROM).over(Window.partitionBy(key).orderBy(VALID_FROM))
        return df.withColumn(f"__{name}_until", until).withColumnRenamed(VALID_FROM, f"__{name}_from")
    both = spans(children, child_key, "c").join(spans(parents, parent_key, "p"), parent_key)
    both = both.filter((F.col("__p_until").isNull() | (F.col("__c_from") < F.col("__p_until")))
                       & (F.col("__c_until").isNull() | (F.col("__p_from") < F.col("__c_until"))))
    out = both.withColumn(VALID_FROM, F.greatest("__c_from", "__p_from"))
    return out.drop("__c_from", "__c_until", "__p_from", "__p_until")
