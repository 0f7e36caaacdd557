"""Line deduplication by a suffix array over line ids.

The corpus is read as sequences of lines (lines without a word take no part). Every
*maximal repeated run* of lines, inside a document or across documents, with at
least ``min_words`` words stays where it stands first, in order of ``doc_id`` and line,
and is deleted from every later place.

1. *Prefix doubling.* Suffixes are ranked by their first line, then by their first 2, 4, 8 ...
   lines: a rank at depth ``2h`` is the place of the pair (rank of the suffix at depth ``h``, rank at
   depth ``h`` of the suffix ``h`` lines on) in a distributed sort of all such pairs. A suffix
   whose prefix occurs once has found its place in the suffix array and leaves; the
   rounds shrink quickly, and end at the longest prefix that step 2 asks for.
2. *LCP intervals.* Suffixes that share a prefix stand next to each other, and form
   an interval of the suffix array whose common prefix is at least that long. What matters of a
   maximal run is covered exactly by its shortest qualifying windows: the ones of just
   ``min_words`` words or more that begin at, or end before, each of its lines. Such a window of
   ``m`` lines names its interval by the ranks of its two covering prefixes of ``2 ** k <= m`` lines.
3. *Deletion.* Of each interval the first suffix keeps its window, every other one deletes it. So each
   deleted line has an equal line at an earlier place, and the first of all places stays.

All steps are joins, grouped aggregates and sorts on fixed-width rows; a frequent line
is counted before it is shuffled, and joins on it can be split by adaptive execution. Windows
run within one document.

Edge cases: an empty table gives no rows; a text of any length is split and put together once; a null text stays null and an empty one stays empty; a text that loses all its lines becomes
empty. Rows equal in ``doc_id`` and text are one document: they are judged once
and come back alike. A null ``doc_id`` sorts first. Lines are compared as they are, by two
independent 64-bit hashes. Other columns are carried in a struct and cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import WORD, stored

DOC = ("doc", "digest")  # what tells documents apart, and orders them


@dataclass(frozen=True)
class Settings:
    min_words: int = 50


def numbered_lines(docs: DataFrame) -> DataFrame:
    """``doc``, ``digest`` (of the text), ``ord`` (number among the lines with a word), ``pos``
    (number among all lines), ``h1``, ``h2`` (what the line is) and ``words``."""
    text = F.col("text").cast("string")
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.alias("pos"), x.alias("line"))),
                     lambda x: F.regexp_like(x.line, F.lit(WORD)))
    out = docs.select(F.col("doc_id").alias("doc"), F.xxhash64(text).alias("digest"), text.alias("text"))
    out = out.filter("text is not null").select(*DOC, F.posexplode(lines).alias("ord", "x"))
    out = out.select(*DOC, "ord", F.col("x.pos").alias("pos"), F.xxhash64("x.line").alias("h1"),
                      F.xxhash64(F.lit(1), "x.line").alias("h2"),
                      F.regexp_count("x.line", F.lit(WORD)).alias("words"))
    return out.dropDuplicates([*DOC, "ord"])  # repeated rows are one document


def _ranked(pairs: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Repeated keys with a ``rank`` in their order. After a range partitioning and a sort the
    row's own id ascends over all partitions; storing the table makes it final."""
    groups = pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    ordered = groups.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return stored(ordered.withColumn("rank", F.monotonically_increasing_id()), name)


def _windows(active: DataFrame, min_words: int) -> DataFrame:
    """Shortest windows of ``min_words`` words from each repeated line on, and back from each:
    ``doc``, ``digest``, ``start`` and ``m`` (lines)."""
    in_doc = Window.partitionBy(*DOC).orderBy("ord")
    rows = active.select(*DOC, "ord", "words")
    rows = rows.withColumn("stretch", F.col("ord") - F.row_number().over(in_doc))  # unbroken
    in_stretch = Window.partitionBy(*DOC, "stretch").orderBy("ord")
    rows = rows.withColumn("to", F.sum("words").over(in_stretch))
    # a line's position in words, and one more position at the end of the stretch
    points = rows.withColumn("last", F.lead("ord").over(in_stretch).isNull()).select(
        *DOC, "stretch", F.explode(F.when(F.col("last"), F.array(
            F.struct("ord", (F.col("to") - F.col("words")).alias("at"), F.lit(True).alias("line")),
            F.struct((F.col("ord") + 1).alias("ord"), F.col("to").alias("at"), F.lit(False).alias("line"))))
            .otherwise(F.array(F.struct("ord", (F.col("to") - F.col("words")).alias("at"),
                                        F.lit(True).alias("line"))))).alias("p"))
    points = points.select(*DOC, "stretch", "p.*")
    on = Window.partitionBy(*DOC, "stretch")
    behind = on.orderBy(F.col("at").asc()).rangeBetween(Window.unboundedPreceding, -min_words)
    ahead = on.orderBy(F.col("at").desc()).rangeBetween(Window.unboundedPreceding, -min_words)
    points = points.withColumn("from", F.max("ord").over(behind)).withColumn("until", F.min("ord").over(ahead))
    both = F.array(F.when(F.col("line") & F.col("until").isNotNull(),
                          F.struct(F.col("ord").alias("start"), (F.col("until") - F.col("ord")).alias("m"))),
                   F.when(F.col("from").isNotNull(),
                          F.struct(F.col("from").alias("start"), (F.col("ord") - F.col("from")).alias("m"))))
    return (points.select(*DOC, F.explode(F.array_distinct(F.array_compact(both))).alias("w"))
            .select(*DOC, "w.start", "w.m").dropDuplicates([*DOC, "start", "m"]))


def deleted_lines(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``doc``, ``digest``, ``pos`` and ``words`` of each line that a later copy of a run loses."""
    lines = stored(numbered_lines(docs), "lines")
    classes = _ranked(lines, ["h1", "h2"], "line-ranks")
    active = stored(lines.join(classes, ["h1", "h2"]).select(*DOC, "ord", "pos", "words", "rank"), "suffixes-1")
    found = stored(_windows(active, s.min_words), "line-windows")
    longest = found.agg(F.max("m")).first()[0] or 0

    ranks = active.select(F.lit(0).alias("level"), *DOC, "ord", "rank")
    level, now = 0, ranks.drop("level")
    while 2 << level <= longest:
        here, ahead = now.alias("a"), now.alias("b")
        step = 1 << level
        same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in DOC]
        pairs = here.join(ahead, [*same, F.col("a.ord") + step == F.col("b.ord")]).select(
            *[F.col(f"a.{k}").alias(k) for k in DOC], F.col("a.ord").alias("ord"),
            F.col("a.rank").alias("first"), F.col("b.rank").alias("second"))
        pairs = stored(pairs, "suffix-pairs")
        order = _ranked(pairs, ["first", "second"], "suffix-ranks")
        now = stored(pairs.join(order, ["first", "second"]).select(*DOC, "ord", "rank"), "suffixes")
        level += 1
        ranks = ranks.unionByName(now.select(F.lit(level).alias("level"), *DOC, "ord", "rank"))

    found = found.withColumn("level", F.floor(F.log2(F.col("m").cast("double") + 0.5)).cast("int"))
    found = found.withColumn("ord", F.col("start"))
    found = _with_rank(found, ranks, "left_rank")
    found = found.withColumn("ord", F.col("start") + F.col("m") - F.pow(F.lit(2), F.col("level")).cast("int"))
    found = _with_rank(found, ranks, "right_rank")
    named = stored(found.select(*DOC, "start", "m", "left_rank", "right_rank"), "line-intervals")

    interval = ["m", "left_rank", "right_rank"]
    at = F.struct(*DOC, "start")
    first = named.groupBy(*interval).agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    copies = named.join(first, interval).filter(at != F.col("first"))
    gone = (copies.select(*DOC, F.explode(F.sequence(F.col("start"), F.col("start") + F.col("m") - 1)).alias("ord"))
            .dropDuplicates([*DOC, "ord"]))
    a, g = active.alias("a"), gone.alias("g")
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"g.{k}")) for k in (*DOC, "ord")]
    return a.join(g, same, "left_semi").select(*DOC, "pos", "words")


def _with_rank(found: DataFrame, ranks: DataFrame, name: str) -> DataFrame:
    """``found`` with the rank of the suffix at ``ord``; rows whose prefix occurs once go."""
    f, r = found.alias("f"), ranks.alias("r")
    same = [F.col(f"f.{k}").eqNullSafe(F.col(f"r.{k}")) for k in DOC]
    return (f.join(r, [*same, F.col("f.level") == F.col("r.level"), F.col("f.ord") == F.col("r.ord")])
            .select("f.*", F.col("r.rank").alias(name)))


def dedup_lines(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``row`` (all columns of ``docs`` as a struct), ``text`` without the deleted lines, ``n_lines``
    (lines with a word, before), ``n_removed`` lines and ``words_removed``."""
    gone = deleted_lines(docs, s).groupBy(*DOC).agg(
        F.collect_list("pos").alias("gone"), F.count(F.lit(1)).alias("n_removed"),
        F.sum("words").alias("words_removed"))
    text = F.col("text").cast("string")
    given = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                        F.col("doc_id").alias("doc"), F.xxhash64(text).alias("digest"), text.alias("text"))
    d, g = given.alias("d"), gone.alias("g")
    joined = d.join(g, [F.col(f"d.{k}").eqNullSafe(F.col(f"g.{k}")) for k in DOC], "left")
    lines = F.split("text", "\n")

    def rest(all_lines):
        kept = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col("gone"))
        return F.array_join(F.transform(kept, lambda i: F.get(all_lines, i)), "\n")
    # the lines are bound once per row; an expression inside a lambda would be evaluated for every line
    out = F.get(F.transform(F.array(lines), rest), 0)
    return joined.select(
        "row", F.when(F.col("gone").isNull(), F.col("text")).otherwise(out).alias("text"),
        F.coalesce(F.size(F.filter(lines, lambda x: F.regexp_like(x, F.lit(WORD)))), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("words_removed", F.lit(0)).cast("long").alias("words_removed"))


def deduplicated(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The documents with later copies of runs deleted and all their columns; a document of
    which nothing is left is gone."""
    out = dedup_lines(docs, s).filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    return out.select(*[F.col("text").alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c)
                        for c in docs.columns])
