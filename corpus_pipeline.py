"""The corpus pipeline: five stages over ``documents``, each one operator of ``vaultline.llm``.

Every stage is written as Parquet and read again, so each starts from files that any
executor can read, and works on all that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vaultline.llm import bpe, lines, mixing, neardup, quality
from vaultline.llm.queries import bpe_settings
from vaultline.llm.tables import stored, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality rules reject."""
    return quality.quality_filter(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes later copies of repeated line runs, and documents of which nothing is left."""
    return lines.deduplicated(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return neardup.without_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target weight draws it."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and digests of ids and decoded text."""
    return bpe.encode(docs, *bpe_settings(), with_ids=True)


STAGES = [
    ("quality rules", keep_quality),
    ("line dedup", drop_repeated_lines),
    ("near-dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("byte-level BPE", encode),
]

#: Expectation-maximisation, near-duplicate groups and BPE have no SQL form; the
#: pipeline is tested stage by stage against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
