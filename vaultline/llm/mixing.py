"""Mixing sources to target weights by systematic sampling.

Each source gets a target number of words: its weight's share of all words,
never more than ``max_copies`` times what it has; what a full source cannot
take is shared again by weight. Within a source every document then has the same
expected number of copies ``r = target / size of the source``. Documents are laid
end to end, each ``r`` long, on a line that starts at one random offset; a
document comes out once for each integer that lies inside its stretch. Laid in
order of size, neighbours are alike, so the words taken follow the target closely.

The rank of a document within its source is a prefix sum in two levels: counts of
(source, size, bucket of the id's digest) are summed up first, and rows are only
numbered inside their bucket. A source, or a size that a third of all rows share,
is thus spread over ``2 ** bucket_bits`` buckets; no window holds a whole source.
Totals of sources (one row each) are the only global windows.

Edge cases: a null or empty text has size 0 and takes 0 words. A null source is a
source of its own, after all others. Repeated rows are separate documents; equal
ones take neighbouring places, and which of them comes out more often cannot be
told apart. An empty table gives an empty result. A source with no words has target 0.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import WORD, stored


@dataclass(frozen=True)
class Settings:
    weights: tuple[float, ...] = (1.0, 2.0, 3.0)  # of sources in code point order, repeating
    max_copies: float = 3.0
    total_share: float = 1.0  # of all words
    seed: str = "mix"
    bucket_digits: int = 3  # hexadecimal digits of the id's digest that choose a bucket


def sizes(docs: DataFrame, carry: bool = False) -> DataFrame:
    """``row`` (``doc_id``, or all columns with ``carry``) with its source key ``src`` (sorts
    by code point, null last), its ``size`` in words, and the digest ``h`` that orders
    documents of equal size and spreads them over buckets."""
    names = docs.columns if carry else ["doc_id"]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
        F.coalesce(F.concat(F.lit("0"), F.col("source").cast("string")), F.lit("1")).alias("src"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"),
                         F.concat(F.lit("null|"), F.md5(text)))).alias("h"))


def targets(per: DataFrame, s: Settings = Settings()) -> DataFrame:
    """From one row per source (``src``, ``source_size``): ``target`` and ``ratio`` of each.

    Sharing the excess again until none is left fills all sources to one common level
    of words per weight, so the full ones are those that need the lowest level: a
    prefix in order of ``limit / weight``."""
    weights = F.array(*[F.lit(float(w)) for w in s.weights])
    nth = F.row_number().over(Window.orderBy("src")) - 1
    per = (per.withColumn("weight", F.element_at(weights, (nth % len(s.weights) + 1).cast("int")))
           .withColumn("limit", F.lit(float(s.max_copies)) * F.col("source_size")))
    by_level = Window.orderBy(F.col("limit") / F.col("weight"), "src")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    all_ = by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = (F.lit(float(s.total_share)) * F.sum("source_size").over(all_)
            - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
    open_ = F.sum("weight").over(all_) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    per = per.withColumn("level", left / open_)
    per = per.withColumn("full", F.col("limit") <= F.col("level") * F.col("weight"))
    common = F.max(F.when(~F.col("full"), F.col("level"))).over(all_)  # the first open source's
    target = F.when(F.col("full"), F.col("limit")).otherwise(common * F.col("weight"))
    per = per.select("src", "source_size", target.alias("target"))
    return per.withColumn("ratio", F.when(F.col("source_size") > 0,
                                          F.col("target") / F.col("source_size")).otherwise(0.0))


def offset(src: Column, seed: str) -> Column:
    """A number in (0, 1) drawn for each source, always the same for a seed."""
    digest = F.substring(F.md5(F.concat(F.lit(seed + "|"), src)), 1, 4)
    return (F.conv(digest, 16, 10).cast("double") + 0.5) / 65536.0


def mix(docs: DataFrame, s: Settings = Settings(), carry: bool = False) -> DataFrame:
    """``row``, ``size``, ``source_size``, ``target`` and ``copies`` of each document."""
    rows = sizes(docs, carry)
    small = stored(sizes(docs), "mix-sizes")  # read by the counts, without texts
    if not carry:
        rows = small
    bucket = F.substring("h", 1, s.bucket_digits)
    first = Window.unboundedPreceding

    buckets = small.groupBy("src", "size", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    of_size = buckets.groupBy("src", "size").agg(F.sum("n").alias("n"))
    per = of_size.groupBy("src").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    in_source = Window.partitionBy("src").orderBy("size").rowsBetween(first, -1)
    in_size = Window.partitionBy("src", "size").orderBy("bucket").rowsBetween(first, -1)
    of_size = (of_size.withColumn("before", F.coalesce(F.sum("n").over(in_source), F.lit(0)))
               .drop("n").join(targets(per, s), "src"))
    buckets = (buckets.withColumn("earlier", F.coalesce(F.sum("n").over(in_size), F.lit(0)))
               .drop("n").join(of_size, ["src", "size"]))

    in_bucket = Window.partitionBy("src", "size", "bucket").orderBy("h", *_tie(rows))
    placed = (rows.withColumn("bucket", bucket)
              .withColumn("place", F.row_number().over(in_bucket))
              .join(buckets, ["src", "size", "bucket"])
              .withColumn("end", (F.col("before") + F.col("earlier") + F.col("place")).cast("double")))
    at = offset(F.col("src"), s.seed)
    copies = (F.floor(at + F.col("end") * F.col("ratio"))
              - F.floor(at + (F.col("end") - 1) * F.col("ratio")))
    return placed.select("row", "size", "source_size", "target", copies.cast("int").alias("copies"))


def _tie(rows: DataFrame) -> list[Column]:
    """Settles the order of rows with the same id where texts are carried."""
    return [F.xxhash64("row.text")] if "text" in rows.schema["row"].dataType.names else []


def mixed_documents(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The mix itself: each document as often as it was drawn, with all its columns."""
    out = mix(docs, s, carry=True).filter("copies > 0")
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
