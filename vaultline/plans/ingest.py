"""Config-driven, incremental and idempotent ingest into the raw (lake) layer.

``ingest`` loads one table: extract the declared columns, keep only what is new
(watermark for incremental facts, changed versions for dimensions), append,
then advance the watermark. The row count, the new watermark and the NULLs in required
columns are observed during the write itself (``DataFrame.observe``), so the data is read once.

No row is lost to the watermark: rows equal to it and rows without a time are read
again by every run, and what is stored already is removed by an anti-join.

``register_new_files`` is the file-level variant: a landing folder's files are
diffed against a manifest of registered paths (``left_anti``), and only rows of
unregistered files are appended; each row keeps its source file.
"""

from __future__ import annotations

import datetime as dt
import logging
import urllib.parse
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.staging import LOAD_ID
from ..session import delete_path, released_shuffles, sized_shuffles
from ..sources.readers import extract, source_frame
from ..sources.schema import TableDef
from ..sources.state import WatermarkStore
from .sinks import append, observed, path_exists, read_or_none

log = logging.getLogger(__name__)
ROW_HASH = "row_hash"
SOURCE_FILE = "source_file"


@dataclass
class IngestResult:
    table: str
    rows: int
    watermark: str | None
    error: str | None = None
    null_required: int = 0  # NULLs in columns that the definition requires


def incremental_filter(df: DataFrame, field: str, last_value: str | None,
                       lookback_hours: int | None = None) -> DataFrame:
    """Rows a run has to look at: from ``watermark - lookback_hours`` on (the watermark itself
    included: more rows may have its time), and rows without a time. All rows on a first run."""
    if last_value is None:
        return df
    bound = F.to_timestamp_ntz(F.lit(last_value))
    if lookback_hours:
        bound = F.timestamp_add("HOUR", F.lit(-int(lookback_hours)), bound)
    return df.filter(F.col(field).isNull() | (F.col(field) >= bound))


LOOKBACK_FLOOR = "1970-01-01 00:00:00"


def late_filter(df: DataFrame, existing: DataFrame | None, ts_col: str,
                lookback_hours: int = 24) -> DataFrame:
    """Rows newer than ``max(ts_col)`` of the target minus a lookback, and rows without a
    time; all rows on a first run. The maximum is one scalar computed before the filter is planned,
    so the bound is a literal and can prune partitions and row groups."""
    if existing is None:
        return df
    top = existing.agg(F.coalesce(F.max(ts_col), F.to_timestamp_ntz(F.lit(LOOKBACK_FLOOR)))
                       .alias("m")).first()["m"]
    bound = F.timestamp_add("HOUR", F.lit(-int(lookback_hours)),
                            F.to_timestamp_ntz(F.lit(top.strftime("%Y-%m-%d %H:%M:%S.%f"))))
    return df.filter(F.col(ts_col).isNull() | (F.col(ts_col) > bound))


def anti_join_null_safe(df: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` with no row in ``existing`` equal on ``keys``, NULL equal to NULL
    (an equi-join on ``<=>``, so it still hashes/sorts on the keys)."""
    ex = existing.select(*[F.col(k).alias(f"__ex_{k}") for k in keys])
    cond = [df[k].eqNullSafe(ex[f"__ex_{k}"]) for k in keys]
    return df.join(ex, cond, "left_anti")


def new_load_id() -> int:
    """A number larger than those of earlier loads (time-based)."""
    return uuid.uuid1().time & ((1 << 62) - 1)


def new_versions(df: DataFrame, existing: DataFrame | None, key: str | Sequence[str],
                 load_id: int | None = None) -> DataFrame:
    """Rows whose content differs from the latest stored version of their key: re-extracting an
    unchanged dimension adds nothing, a changed row adds one version, and so does a row
    that changes back to an earlier content.

    The stored table keeps each version's content hash and the number of the load that wrote it,
    so a run reads only ``(key, row_hash, load_id)``; a table without them is hashed
    on the fly and counts as one earlier load.
    """
    keys = [key] if isinstance(key, str) else list(key)
    cols = [c for c in df.columns if c not in (ROW_HASH, LOAD_ID)]
    number = F.lit(new_load_id() if load_id is None else load_id).cast("long")
    hashed = df.select(*cols).withColumn(ROW_HASH, row_hash(cols)).withColumn(LOAD_ID, number)
    if existing is None:
        return hashed
    content = F.col(ROW_HASH) if ROW_HASH in existing.columns else row_hash(cols)
    written = F.col(LOAD_ID) if LOAD_ID in existing.columns else F.lit(0).cast("long")
    stored = existing.select(*keys, content.alias(ROW_HASH), F.coalesce(written, F.lit(0)).alias(LOAD_ID))
    # a load may hold several rows of a key: all of its last load's versions are current
    last = stored.groupBy(*keys).agg(F.max(LOAD_ID).alias("__last"))
    same = [stored[k].eqNullSafe(last[k]) for k in keys]
    current = stored.join(last, [*same, stored[LOAD_ID] == last["__last"]], "left_semi")
    return anti_join_null_safe(hashed, current, [*keys, ROW_HASH])


def row_hash(cols: Sequence[str]):
    """Content hash of a row for version detection within Spark: MD5 of the row as
    JSON (every type renders; a NULL field differs from any value)."""
    return F.md5(F.to_json(F.struct(*[F.col(c) for c in cols])))


def plan_ingest(spark: SparkSession, table: TableDef, source: DataFrame, target: str,
                state: WatermarkStore | None = None, lookback_hours: int | None = None,
                dedup_keys: Sequence[str] | None = None) -> DataFrame:
    """The rows one ingest run would append (lazy). ``lookback_hours`` and ``dedup_keys`` default
    to the table's definition."""
    df = source
    existing = read_or_none(spark, target)
    keys = list(dedup_keys or table.dedup_keys)
    if table.is_incremental and table.incremental_field:
        field = table.incremental_field
        last = state.last_value(table.name, field) if state else None
        hours = table.lookback_hours if lookback_hours is None else lookback_hours
        df = incremental_filter(df, field, last, hours)
        if existing is not None:
            # Stored rows of the same window: the overlap, or rows of a run that appended
            # but died before saving its watermark. The window filter reaches the
            # Parquet scan, so only recent row groups are read.
            df = anti_join_null_safe(df, incremental_filter(existing, field, last, hours),
                                     keys or df.columns)
    elif table.primary_key:
        df = new_versions(df, existing, keys or table.primary_key)
    if table.primary_key:
        df = df.sortWithinPartitions(table.primary_key)
    return df


def ingest(spark: SparkSession, table: TableDef, kind: str, options: dict, target: str,
           state: WatermarkStore | None = None, lookback_hours: int | None = None,
           dedup_keys: Sequence[str] | None = None, source: DataFrame | None = None,
           fail_on_null: bool = False) -> IngestResult:
    """Load one table from a source into the Parquet table at ``target``. NULLs in required columns are counted; with
    ``fail_on_null`` they are the load's ``error`` (its rows stay in the raw layer, where they can be looked at)."""
    src = extract(source, table) if source is not None else source_frame(spark, table, kind,
                                                                          options)
    rows = plan_ingest(spark, table, src, target, state, lookback_hours, dedup_keys)
    wm_field = table.incremental_field if table.is_incremental else None
    metrics = [F.count(F.lit(1)).alias("rows")]
    if wm_field:
        metrics.append(F.max(wm_field).alias("wm"))
    if table.required:
        missing = F.lit(0)
        for c in table.required:
            missing = missing + F.count_if(F.col(c).isNull())
        metrics.append(missing.alias("missing"))
    obs = Observation(f"ingest_{table.name}")
    with sized_shuffles(spark, src), released_shuffles(spark):
        append(rows.observe(obs, *metrics), target,
               [table.partition_field] if table.partition_field else None)
    wm = observed(obs, "wm", None) if wm_field else None
    watermark = None
    if wm is not None:
        watermark = wm.strftime("%Y-%m-%d %H:%M:%S.%f")
        last = state.last_value(table.name, wm_field) if state is not None else None
        if state is not None and (last is None or watermark > last):  # late rows don't move it back
            state.save(table.name, wm_field, watermark)
    missing = int(observed(obs, "missing") or 0) if table.required else 0
    error = f"{missing} NULLs in required columns {list(table.required)}" if missing and fail_on_null else None
    return IngestResult(table.name, int(observed(obs, "rows")), watermark, error, null_required=missing)


def ingest_all(spark: SparkSession, tables: Sequence[TableDef], kind: str,
               options_for, target_for, state: WatermarkStore | None = None,
               raise_on_error: bool = True, fail_on_null: bool = False) -> DataFrame:
    """Load every table; a failing table does not stop the others, but the run
    fails at the end (after reporting) unless ``raise_on_error`` is False.

    ``options_for(table) -> dict`` and ``target_for(table) -> path`` map each
    definition to its source options and lake path.
    """
    results = []
    for t in tables:
        try:
            results.append(ingest(spark, t, t.source_kind or kind, options_for(t), target_for(t), state, fail_on_null=fail_on_null))
        except Exception as ex:  # isolate the failure, report it below
            log.error("failed to load %s: %s", t.name, ex)
            results.append(IngestResult(t.name, 0, None, f"{type(ex).__name__}: {ex}"))
    status = spark.createDataFrame(
        [(r.table, r.rows, r.watermark, r.error, r.null_required) for r in results],
        "table_name string, rows long, watermark string, error string, null_required long")
    failed = [r for r in results if r.error]
    if failed and raise_on_error:
        raise RuntimeError("ingest failed for: " + ", ".join(f"{r.table} ({r.error})"
                                                             for r in failed))
    return status


# -- file-level exactly-once registration ---------------------------------------------

def unregistered_rows(landing: DataFrame, manifest: DataFrame | None) -> DataFrame:
    """Rows of ``landing`` (a file-based DataFrame) whose file is not in ``manifest``."""
    with_file = landing.withColumn("__file", F.col("_metadata.file_path"))
    if manifest is not None:
        with_file = with_file.join(manifest.select(F.col("file_path").alias("__file")),
                                   "__file", "left_anti")
    return with_file


MANIFEST = "_manifest"
MODIFIED = "modified_at"


def manifest_path(target: str) -> str:
    """The target's file manifest (a leading underscore hides it from table reads)."""
    return f"{target.rstrip('/')}/{MANIFEST}"


def listed_files(spark: SparkSession, landing_path: str, after=None) -> DataFrame:
    """``file_path`` and ``modified_at`` of the landing files, from the listing alone: no file is opened."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if after is not None:
        r = r.option("modifiedAfter", after.strftime("%Y-%m-%dT%H:%M:%S")).option("timeZone", "UTC")
    # the path as the rows' own metadata tell it
    return r.load(landing_path).select(F.col("_metadata.file_path").alias("file_path"),
                                       F.col("modificationTime").cast("timestamp_ntz").alias("modified_at"))


def register_new_files(spark: SparkSession, landing_path: str, schema, target: str,
                       partition_by: Sequence[str] | None = None,
                       file_col: str = SOURCE_FILE, overlap_hours: int | None = None) -> int:
    """Append the rows of landing files that are not registered in the target yet.

    The manifest holds one row per registered file, so finding new files is a
    join over file names, from a listing that opens none of them. With ``overlap_hours`` only files modified since that long
    before the latest registered one are compared, with the manifest's rows of that time; a file that lands with an older
    time (copied with its time kept) is then not seen, which is why the whole listing is the default. The new
    names are noted as pending, the
    data is appended, and the names go to the manifest. A run that died in between
    leaves the note: the next run looks up which of its files have rows in the target, and
    registers those instead of loading them again. The names of a run's new files reach the driver, which hands them to the
    reader, so that old files are not opened. Returns the number of rows appended.
    """
    _settle_pending(spark, target, file_col)
    manifest, after = read_or_none(spark, manifest_path(target)), None
    if manifest is not None and MODIFIED in manifest.columns and overlap_hours is not None:
        high = manifest.agg(F.max(MODIFIED)).first()[0]
        if high is not None:
            after = high - dt.timedelta(hours=overlap_hours)
            manifest = manifest.filter((F.col(MODIFIED) >= F.lit(after).cast("timestamp_ntz")) | F.col(MODIFIED).isNull())
    files = listed_files(spark, landing_path, after)
    if manifest is not None:
        files = files.join(manifest.select("file_path"), "file_path", "left_anti")
    note = f"{manifest_path(target)}_pending"
    files.write.mode("overwrite").parquet(note)
    pending = spark.read.parquet(note)
    new = [r.file_path for r in pending.select("file_path").collect()]
    if not new:
        delete_path(spark, note)
        return 0
    landing = spark.read.schema(schema).option("basePath", landing_path).parquet(*[urllib.parse.unquote(f) for f in new])
    rows = landing.withColumn(file_col, F.col("_metadata.file_path"))
    obs = Observation("register_files")
    append(rows.observe(obs, F.count(F.lit(1)).alias("rows")), target, partition_by)
    _record(pending, target)
    delete_path(spark, note)
    return int(observed(obs, "rows"))


def _settle_pending(spark: SparkSession, target: str, file_col: str) -> None:
    """Register the files of a run that appended their rows but died before the manifest."""
    note = f"{manifest_path(target)}_pending"
    if not path_exists(spark, note):
        return
    existing, manifest = read_or_none(spark, target), read_or_none(spark, manifest_path(target))
    if existing is not None:
        done = spark.read.parquet(note).join(
            existing.select(F.col(file_col).alias("file_path")), "file_path", "left_semi")
        if manifest is not None:
            done = done.join(manifest.select("file_path"), "file_path", "left_anti")
        _record(done, target)
    delete_path(spark, note)


def _record(files: DataFrame, target: str) -> None:
    (files.select("file_path", F.localtimestamp().alias("registered_at"), MODIFIED)
     .write.mode("append").parquet(manifest_path(target)))


def registered_files(spark: SparkSession, target: str) -> DataFrame | None:
    """The manifest of a target (``file_path``, ``registered_at``)."""
    return read_or_none(spark, manifest_path(target))
