"""Writing vault tables on plain Parquet (no table format required).

* ``append``: insert-only loads (hubs, links, satellites, measurements). A
  partitioned append is rebalanced on the partition column first, so each day
  lands in few files, and AQE splits a day that holds a large share of the rows
  instead of sending it to one task.
* ``merge`` and ``upsert``: merge semantics without MERGE INTO. ``merge`` settles source rows that share a key first. The merged rows of the
  affected partitions are written to a generation folder first, a pending note
  names it, and then it replaces those partitions. A run that dies in between
  is finished by the next read or upsert of the table.
* ``save_table`` / ``create_view``: catalog tables (created if missing) and views.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.merge import CONTESTED, conflict_losers, require_one_row_per_key, settled
from ..operators.vault import upsert_rows
from ..session import delete_path, scratch_path

NOT_THERE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table folder holds committed data. Only a missing or empty folder is
    "no": a store that cannot be reached raises, or a load would take it for a first one."""
    try:
        sc = spark.sparkContext
    except Exception:  # a remote session has no context: probe by reading
        sc = None
    if sc is None:
        try:
            spark.read.parquet(path).schema  # noqa: B018
        except AnalysisException as ex:
            if ex.getCondition() in NOT_THERE:
                return False
            raise
        return True
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return False
    return any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(p))


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, after an interrupted upsert of it was finished."""
    finish_upsert(spark, path)
    return spark.read.parquet(path) if path_exists(spark, path) else None


def append(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
           sort_within: Sequence[str] | None = None) -> None:
    """Append ``df`` as Parquet; ``partition_by`` lays files out by those columns."""
    out = df
    if partition_by:
        out = out.hint("rebalance", *partition_by)
    if sort_within:
        out = out.sortWithinPartitions(*sort_within)
    w = out.write.mode("append").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def save_table(df: DataFrame, name: str, partition_by: Sequence[str] | None = None,
               fmt: str = "parquet", location: str | None = None, replace: bool = False,
               bucket_by: tuple[int, str] | None = None) -> None:
    """Append to a catalog table, creating its namespace and the table (with ``location`` and
    format) if missing; ``replace`` refreshes it in full. ``bucket_by`` (how many, column) stores the rows by hash of the
    column and sorted by it; the batch is dealt by it first, so that each append adds one file per bucket."""
    spark = df.sparkSession
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if bucket_by:
        df = df.repartition(*bucket_by)
    w = df.write.format(fmt).mode("overwrite" if replace else "append")
    if location:
        w = w.option("path", location)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        w = w.bucketBy(*bucket_by).sortBy(bucket_by[1])
    w.saveAsTable(name)


def create_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


PENDING = T.StructType([T.StructField("generation", T.StringType()),
                        T.StructField("partition_by", T.ArrayType(T.StringType()))])


def _pending_path(path: str) -> str:
    head, _, name = path.rstrip("/").rpartition("/")
    return f"{head}/_pending-{name}"


def finish_upsert(spark: SparkSession, path: str) -> None:
    """Put a complete generation in place that an upsert left behind; doing it twice is the same."""
    note = _pending_path(path)
    if not path_exists(spark, note):
        return
    row = spark.read.schema(PENDING).parquet(note).first()
    if row is not None:
        _replace(spark, row.generation, path, row.partition_by or [])
    delete_path(spark, note)
    if row is not None:
        delete_path(spark, row.generation)


def _replace(spark: SparkSession, generation: str, path: str, partition_by: Sequence[str]) -> None:
    staged = spark.read.parquet(generation)
    if partition_by:
        staged = staged.hint("rebalance", *partition_by)
    out = staged.write.mode("overwrite").format("parquet")
    if partition_by:  # only the partitions of the generation are replaced
        out = out.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    else:
        out = out.option("partitionOverwriteMode", "static")
    out.save(path)


BATCH = "batch"


def merge(spark: SparkSession, source: DataFrame, path: str, keys: Sequence[str],
          partition_by: Sequence[str] | None = None, order: Sequence[str] = (), rejects: str | None = None,
          batch: str = "0") -> None:
    """``upsert`` of a source that may have several rows per key.

    Different rows for one key, or a row without one, fail the merge before anything is written. With
    ``rejects`` (a table's path) the last row by ``order`` is merged instead, and the others are stored there with a
    reason, under the name of the ``batch``; merging a batch again replaces its rejects. The source is
    written to the shared folder first, so that the checks and the merge see the same rows and its plan runs once.
    """
    scratch = scratch_path(spark, "merge-source")
    source.write.parquet(scratch)
    source = spark.read.parquet(scratch)
    try:
        if rejects is None:
            require_one_row_per_key(source, keys)
            clean = source
        else:
            # one grouped pass settles the source; contested rows lie in a folder of their own, so that their size is known
            one = settled(source, keys, order)
            one.write.partitionBy(CONTESTED).parquet(f"{scratch}-settled")
            one = spark.read.schema(one.schema).parquet(f"{scratch}-settled")
            clean = one.drop(CONTESTED)
            rejected = conflict_losers(source, one.filter(CONTESTED).drop(CONTESTED), keys)
            (rejected.withColumn(BATCH, F.lit(batch)).write.mode("overwrite").partitionBy(BATCH)
             .option("partitionOverwriteMode", "dynamic").parquet(rejects))
        upsert(spark, clean, path, keys, partition_by, settled=rejects is not None)
    finally:
        delete_path(spark, scratch)
        delete_path(spark, f"{scratch}-settled")


def upsert(spark: SparkSession, source: DataFrame, path: str, keys: Sequence[str],
           partition_by: Sequence[str] | None = None, settled: bool = False) -> None:
    """Rows of ``source`` replace rows with the same ``keys`` in the table at ``path``. The source
    must have one row per key: ``merge`` checks that, or settles it (``settled``: it need not be reduced again).

    With ``partition_by`` only the partitions that get rows are read and rewritten. The
    partition columns must belong to the key: a row could otherwise move to another partition
    and stay in the old one as well. Their values in ``source`` are the one thing collected (as
    many as the batch touches partitions); as literals they prune the scan.
    """
    parts, keys = list(partition_by or []), list(keys)
    if not set(parts) <= set(keys):
        raise ValueError(f"partition columns {parts} must be part of the merge key {keys}")
    current = read_or_none(spark, path)
    if current is None:
        append(upsert_rows(None, source, keys, settled), path, parts)
        return
    columns = current.columns
    if parts:
        # column by column: a superset of the touched partitions, each replaced as a whole
        for c in parts:
            values = [r[0] for r in source.select(c).distinct().collect()]
            named = F.col(c).isin([v for v in values if v is not None])
            current = current.filter(named | F.col(c).isNull() if None in values else named)
    replace_partitions(spark, upsert_rows(current, source.select(*columns), keys, settled), path, parts)


def replace_partitions(spark: SparkSession, rows: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Put ``rows`` in place of the partitions that they have (without partitions: of the table); ``rows`` may read
    the table. A run that dies once all rows are written is finished by the next read."""
    generation = scratch_path(spark, "generation")
    rows.write.mode("overwrite").parquet(generation)
    note = spark.createDataFrame([(generation, list(partition_by))], PENDING)
    note.coalesce(1).write.mode("overwrite").parquet(_pending_path(path))
    finish_upsert(spark, path)


def write_checkpoint(df: DataFrame, name: str) -> DataFrame:
    """Materialise ``df`` under the shared checkpoint folder and read it back,
    cutting the lineage (survives executor loss, unlike a local checkpoint)."""
    spark = df.sparkSession
    p = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(p)
    return spark.read.parquet(p)


def observed(obs, key: str, default=0):
    """A metric of a finished ``Observation``. When AQE proves the observed plan
    empty it removes the plan, metrics node included, and the observation ends
    with a row without a schema: nothing was written, so the default applies. A failure is raised."""
    jvm_side = getattr(obs, "_jo", None)
    if jvm_side is not None and jvm_side.getRow().schema() is None:
        return default
    return obs.get.get(key, default)
