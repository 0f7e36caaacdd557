"""Registered queries that write: ingest runs, file registration, streaming loads.

Each one lands the fixture data as files under a fresh folder below the
session's checkpoint directory, runs the job(s), and returns a DataFrame over
the result. The data is the driver's tables mapped to readings, whole; the
split into deliveries (batch 1, then everything) is the scenario, not a cap.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.temporal import ntz_literal
from ..operators import business, quality
from ..operators.merge import REASON
from ..operators.references import reference_table
from ..operators.staging import seen_rows, stage_asset_span, stage_readings
from ..operators.vault import (HUB_CUSTOMER, SAT_ASSET_MEASUREMENTS, hub_rows,
                               measurement_rows)
from ..session import apply_conf, scratch_path
from ..sources import fixtures
from ..sources.readers import source_frame
from ..sources.schema import FieldDef, TableDef, meter_tables, to_struct
from ..sources.state import WatermarkStore
from ..streaming.dedup import stream_dedup
from ..streaming.loads import stream_load
from . import measurements
from .build import read_vault, run_build
from .folds import fold, folded, meter_reads, quality_reads
from .ingest import (ingest, ingest_all, plan_ingest, register_new_files, registered_files,
                     unregistered_rows)
from .sinks import BATCH, merge, save_table, upsert
from .targets import CatalogTarget

# Fixed parameters of the scenarios.
LATE_WINDOW_HOURS = 48     # late rows: created within this many hours before batch 1 ended
LOOKBACK_HOURS = 24        # re-read window behind the watermark
EVENTS_WAVE2_START = "2024-01-16 00:00:00"
EVENTS_DELAY = dt.timedelta(days=1)
HUB_BUCKETS = 16

READINGS = meter_tables()["readings"]


def _land(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).parquet(path)


def _before_batch_end(col: str = "creation_time"):
    return F.col(col) < ntz_literal(fixtures.BATCH1_END)


def q_ingest_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Config-driven load of readings from a Parquet export that lacks the
    ``source_system`` column: declared columns are cast, the missing one takes
    its declared default."""
    apply_conf(spark)
    root = scratch_path(spark, "ingest-projection")
    export = f"{root}/export"
    _land(fixtures.sources(spark, sf_dir).readings.drop("source_system"), export, "overwrite")
    ingest(spark, READINGS, "parquet", {"path": export}, f"{root}/raw_readings")
    return spark.read.parquet(f"{root}/raw_readings")


def q_incremental_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second run of an incremental load: rows created after the stored watermark."""
    apply_conf(spark)
    root = scratch_path(spark, "incremental-extract")
    state = WatermarkStore(spark, f"{root}/_state")
    r = fixtures.sources(spark, sf_dir).readings
    ingest(spark, READINGS, "parquet", {}, f"{root}/raw_readings", state,
           source=r.filter(_before_batch_end()))
    return plan_ingest(spark, READINGS, r, f"{root}/raw_readings", state)


def q_late_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second run with a 24 h lookback: late rows within the window are picked
    up, rows already loaded are removed by a null-safe anti-join."""
    apply_conf(spark)
    root = scratch_path(spark, "late-lookback")
    state = WatermarkStore(spark, f"{root}/_state")
    r = fixtures.sources(spark, sf_dir).readings
    end = ntz_literal(fixtures.BATCH1_END)
    late = (F.col("creation_time") > F.timestamp_add("HOUR", F.lit(-LATE_WINDOW_HOURS), end)) \
        & (F.col("unit_of_measure") == "L")
    first = r.filter(_before_batch_end() & ~late)
    ingest(spark, READINGS, "parquet", {}, f"{root}/raw_readings", state, source=first)
    return plan_ingest(spark, READINGS, r, f"{root}/raw_readings", state,
                       lookback_hours=LOOKBACK_HOURS)


def q_ingest_null_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries in which some readings carry no creation time: each row is stored once."""
    apply_conf(spark)
    root = scratch_path(spark, "null-timestamps")
    state = WatermarkStore(spark, f"{root}/_state")
    r = fixtures.sources(spark, sf_dir).readings
    r = r.withColumn("__delivered", _before_batch_end()).withColumn(
        "creation_time", F.when(F.col("unit_of_measure") != "L", F.col("creation_time")))
    for part in (r.filter("__delivered"), r):
        ingest(spark, READINGS, "parquet", {}, f"{root}/raw_readings", state, source=part)
    return spark.read.parquet(f"{root}/raw_readings")


def q_incremental_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings stamped by day: half of the last day's rows come with the first delivery, the rest,
    equal to the watermark, with the second."""
    apply_conf(spark)
    root = scratch_path(spark, "incremental-ties")
    state = WatermarkStore(spark, f"{root}/_state")
    r = fixtures.sources(spark, sf_dir).readings
    r = r.withColumn("creation_time", F.date_trunc("DAY", F.col("creation_time")).cast("timestamp_ntz"))
    end = ntz_literal(fixtures.BATCH1_END)
    first = r.filter((F.col("creation_time") < end)
                     | ((F.col("creation_time") == end) & (F.col("id") % 2 == 0)))
    for part in (first, r):
        ingest(spark, READINGS, "parquet", {}, f"{root}/raw_readings", state, source=part)
    return spark.read.parquet(f"{root}/raw_readings")


def q_dimension_revert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers change and change back, their change time standing still: three versions."""
    apply_conf(spark)
    root = scratch_path(spark, "dimension-revert")
    target, table = f"{root}/customers", meter_tables()["customers"]
    for changed in (False, True, True, False):
        ingest(spark, table, "parquet", {}, target,
               source=fixtures.sources(spark, sf_dir, changed=changed).customers)
    return spark.read.parquet(target).drop("row_hash", "load_id")


def q_partitioned_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table with a partition field is laid out in its folders."""
    apply_conf(spark)
    root = scratch_path(spark, "partitioned-export")
    table = replace(READINGS, partition_field="reading_type")
    ingest(spark, table, "parquet", {}, f"{root}/raw_readings",
           source=fixtures.sources(spark, sf_dir).readings)
    return spark.read.parquet(f"{root}/raw_readings").select(*READINGS.names)


def q_sorted_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table with a primary key: each written file is sorted by it."""
    apply_conf(spark)
    root = scratch_path(spark, "sorted-ingest")
    table = meter_tables()["assets"]
    ingest(spark, table, "parquet", {}, f"{root}/assets", source=fixtures.sources(spark, sf_dir).assets)
    return spark.read.parquet(f"{root}/assets").select(*table.names)


def q_catalog_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog table, created with its namespace on the first of two appends, then scanned."""
    apply_conf(spark)
    name = "vaultline_raw.accounts_" + scratch_path(spark, "x").rsplit("-", 1)[-1]
    accounts = fixtures.sources(spark, sf_dir).customer_accounts
    active, location = F.col("status") == "ACTIVE", scratch_path(spark, "catalog-table")
    for part in (accounts.filter(active), accounts.filter(~active)):
        save_table(part, name, location=location)
    return spark.table(name)


def q_hub_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored hub merged on its key: the first delivery's customers come again from another system."""
    apply_conf(spark)
    path = f"{scratch_path(spark, 'hub-upsert')}/hub_customer"
    s1, s = fixtures.sources(spark, sf_dir, batch=1), fixtures.sources(spark, sf_dir)

    def hub(x):
        return hub_rows(seen_rows(stage_asset_span(x.readings, x.assets, x.customer_accounts, x.customers),
                                  "first"), HUB_CUSTOMER)
    upsert(spark, hub(s), path, ["customer_hk"])
    upsert(spark, hub(s1).withColumn("record_source", F.lit("MERGED")), path, ["customer_hk"])
    return spark.read.parquet(path)


def _merged_measurements(spark: SparkSession, sf_dir: str, root: str) -> tuple[str, str]:
    """Two deliveries merged on the five-part key, the second one with corrected demand readings: the paths of
    the table and of its rejects. Of readings with one key the one with the larger id, then value, is kept."""
    path, rejects = f"{root}/sat_asset_measurements", f"{root}/sat_asset_measurements_rejects"
    s1, s = fixtures.sources(spark, sf_dir, batch=1), fixtures.sources(spark, sf_dir)

    def rows(x):
        staged = stage_readings(x.readings, x.assets, x.customer_accounts, x.customers)
        return measurement_rows(staged)
    fixed = F.when(F.col("reading_type") == "DEMAND", F.lit("SUSPECT")).otherwise(F.col("quality_code"))
    for batch, df in (("first", rows(s1)), ("second", rows(s).withColumn("quality_code", fixed))):
        merge(spark, df, path, SAT_ASSET_MEASUREMENTS.key, order=["reading_id", "reading_value"], rejects=rejects, batch=batch)
    return path, rejects


def q_measurements_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored measurements merged on their five-part key: demand readings are corrected."""
    apply_conf(spark)
    return spark.read.parquet(_merged_measurements(spark, sf_dir, scratch_path(spark, "measurements-upsert"))[0])


def q_merge_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings that the merge of all measurements handed back: another one has their five-part key."""
    apply_conf(spark)
    s, root = fixtures.sources(spark, sf_dir), scratch_path(spark, "merge-conflicts")
    rows = measurement_rows(stage_readings(s.readings, s.assets, s.customer_accounts, s.customers))
    merge(spark, rows, f"{root}/sat_asset_measurements", SAT_ASSET_MEASUREMENTS.key, order=["reading_id", "reading_value"],
          rejects=f"{root}/rejects")
    schema = StructType(rows.schema.fields).add(REASON, "string")  # no file is written where no key is contested
    return spark.read.schema(schema).parquet(f"{root}/rejects").drop(BATCH)


def q_vault_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job: ingest the four tables, build the vault, run the checks; rows of each vault table."""
    apply_conf(spark)
    root = scratch_path(spark, "vault-run")
    s = fixtures.sources(spark, sf_dir).as_dict()
    state = WatermarkStore(spark, f"{root}/_state")
    for name, df in s.items():
        _land(df, f"{root}/export/{name}", "overwrite")
    ingest_all(spark, list(meter_tables().values()), "parquet", lambda t: {"path": f"{root}/export/{t.name}"},
               lambda t: f"{root}/lake/{t.name}", state)
    lake = fixtures.Sources(*(spark.read.parquet(f"{root}/lake/{n}")
                              for n in ("customers", "customer_accounts", "assets", "readings")))
    run_build(spark, lake, f"{root}/vault")
    return quality.row_counts(read_vault(spark, f"{root}/vault").as_dict())


def q_new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of landing files that are not registered in the raw table yet."""
    apply_conf(spark)
    root = scratch_path(spark, "new-files")
    landing, target = f"{root}/landing", f"{root}/raw_readings"
    schema = to_struct(READINGS)
    r = fixtures.sources(spark, sf_dir).readings
    _land(r.filter(_before_batch_end()), landing)
    register_new_files(spark, landing, schema, target)
    _land(r.filter(~_before_batch_end()), landing)
    return unregistered_rows(spark.read.schema(schema).parquet(landing),
                             registered_files(spark, target)).drop("__file")


def q_registered_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries registered file by file, from the last run's mark on; a third run finds nothing."""
    apply_conf(spark)
    root = scratch_path(spark, "registered")
    landing, target, schema = f"{root}/landing", f"{root}/raw_readings", to_struct(READINGS)
    r = fixtures.sources(spark, sf_dir).readings
    for part in (_before_batch_end(), ~_before_batch_end(), None):
        if part is not None:
            _land(r.filter(part), landing)
        register_new_files(spark, landing, schema, target, overlap_hours=24)
    return spark.read.parquet(target).select(*READINGS.names)


def q_stream_hub_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings arrive in two deliveries; a file stream stages each micro-batch
    against the dimensions and appends new customer hub keys."""
    apply_conf(spark)
    root = scratch_path(spark, "stream-hub")
    landing, ckpt, vault = f"{root}/landing", f"{root}/_checkpoint", f"{root}/vault"
    s = fixtures.sources(spark, sf_dir)
    schema = to_struct(READINGS)
    dims = lambda: (s.assets, s.customer_accounts, s.customers)
    for wave in (_before_batch_end(), ~_before_batch_end()):
        _land(s.readings.filter(wave), landing)
        stream_load(spark, landing, schema, vault, ckpt, ["hub_customer"], dims)
    return spark.read.parquet(f"{vault}/hub_customer")


def q_stream_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as meter readings, two deliveries, repeats of a reading id inside a
    batch reduced to one, day-partitioned measurement appends."""
    apply_conf(spark)
    root = scratch_path(spark, "stream-measurements")
    landing, ckpt, vault = f"{root}/landing", f"{root}/_checkpoint", f"{root}/vault"
    ev = fixtures.events_as_readings(fixtures.read_tables(spark, sf_dir, ("events",)))
    schema = to_struct(READINGS)
    first = F.col("creation_time") < ntz_literal(EVENTS_WAVE2_START)
    for wave in (first, ~first):
        _land(ev.filter(wave), landing)
        stream_load(spark, landing, schema, vault, ckpt, [SAT_ASSET_MEASUREMENTS.name],
                    dedup_keys=["id"], event_time="creation_time")
    return spark.read.parquet(f"{vault}/{SAT_ASSET_MEASUREMENTS.name}") \
        .select(*SAT_ASSET_MEASUREMENTS.columns)


def q_stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newer half of the events arrives first, the older one weeks late: nothing is lost."""
    apply_conf(spark)
    root = scratch_path(spark, "stream-late")
    landing, ckpt, vault = f"{root}/landing", f"{root}/_checkpoint", f"{root}/vault"
    ev = fixtures.events_as_readings(fixtures.read_tables(spark, sf_dir, ("events",)))
    newer = F.col("creation_time") >= ntz_literal(EVENTS_WAVE2_START)
    for wave in (newer, ~newer):
        _land(ev.filter(wave), landing)
        stream_load(spark, landing, to_struct(READINGS), vault, ckpt, [SAT_ASSET_MEASUREMENTS.name],
                    dedup_keys=["id"], event_time="creation_time")
    return spark.read.parquet(f"{vault}/{SAT_ASSET_MEASUREMENTS.name}") \
        .select(*SAT_ASSET_MEASUREMENTS.columns)


def q_stream_satellite_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer versions by micro-batches of one stream; the second delivery lands twice."""
    apply_conf(spark)
    root = scratch_path(spark, "stream-replay")
    landing, ckpt, vault = f"{root}/landing", f"{root}/_checkpoint", f"{root}/vault"
    s1, s2 = fixtures.sources(spark, sf_dir, batch=1), fixtures.sources(spark, sf_dir, changed=True)
    for s in (s1, s2, s2):
        _land(s.readings, landing)
        stream_load(spark, landing, to_struct(READINGS), vault, ckpt, ["sat_customer_details"],
                    lambda s=s: (s.assets, s.customer_accounts, s.customers))
    return spark.read.parquet(f"{vault}/sat_customer_details")


def q_stream_dedup_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as meter readings, each once: repeats within the delay are known to the stream's state, while rows and
    repeats that come later than that are compared with the stored table. The stream is stopped and restarted."""
    apply_conf(spark)
    root = scratch_path(spark, "stream-dedup")
    landing, ckpt, vault = f"{root}/landing", f"{root}/_checkpoint", f"{root}/vault"
    ev = fixtures.events_as_readings(fixtures.read_tables(spark, sf_dir, ("events",)))
    at, late = F.col("creation_time"), F.col("id") % 50 == 0
    older = at < ntz_literal(EVENTS_WAVE2_START)
    near = at >= F.timestamp_add("HOUR", F.lit(-12), ntz_literal(EVENTS_WAVE2_START))
    for wave in (older & ~late,             # what is on time
                 (older & near) | ~older,   # half a day again, and the rest
                 older):                    # weeks late: rows that never came, and repeats of all others
        _land(ev.filter(wave), landing)
        stream_dedup(spark, landing, to_struct(READINGS), vault, ckpt, EVENTS_DELAY)
    return spark.read.parquet(f"{vault}/{SAT_ASSET_MEASUREMENTS.name}") \
        .select(*SAT_ASSET_MEASUREMENTS.columns)


def q_meters_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The legacy meters view from state that is folded batch by batch; the second batch comes twice."""
    apply_conf(spark)
    root, s = scratch_path(spark, "meters"), fixtures.sources(spark, sf_dir)
    for batch, part in ((1, _before_batch_end()), (2, ~_before_batch_end()), (2, ~_before_batch_end())):
        fold(spark, root, meter_reads(), s.readings.filter(part), batch)
    return business.meters(s.assets, s.customer_accounts, last=folded(spark, root, meter_reads()))


def q_quality_counts_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings by quality and status, folded batch by batch from the measurements."""
    apply_conf(spark)
    root, s = scratch_path(spark, "quality"), fixtures.sources(spark, sf_dir)
    rows = measurement_rows(stage_readings(s.readings, s.assets, s.customer_accounts, s.customers))
    first = F.col("load_ts") < ntz_literal(fixtures.BATCH1_END)
    for batch, part in ((1, first), (2, ~first)):
        fold(spark, root, quality_reads(), rows.filter(part), batch)
    return folded(spark, root, quality_reads())


def q_measurements_key_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries of measurements, loaded by a filter of the stored keys; the second holds the first again."""
    apply_conf(spark)
    path = f"{scratch_path(spark, 'key-filter')}/sat_asset_measurements"
    for batch in (1, None):
        s = fixtures.sources(spark, sf_dir, batch=batch)
        staged = stage_readings(s.readings, s.assets, s.customer_accounts, s.customers)
        measurements.load(spark, staged, path, use_sketch=True)
    return spark.read.parquet(path).select(*SAT_ASSET_MEASUREMENTS.columns)


def q_hub_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New hub keys of the second delivery against a stored hub that is bucketed by its key."""
    apply_conf(spark)
    target = CatalogTarget(spark, "vaultline_" + scratch_path(spark, "x").rsplit("-", 1)[-1], buckets=HUB_BUCKETS)
    s1, s = fixtures.sources(spark, sf_dir, batch=1), fixtures.sources(spark, sf_dir)

    def hub(x, existing=None):
        return hub_rows(seen_rows(stage_asset_span(x.readings, x.assets, x.customer_accounts, x.customers),
                                  "first"), HUB_CUSTOMER, existing)
    target.append(hub(s1), HUB_CUSTOMER.name)
    return hub(s, target.read(HUB_CUSTOMER.name))


def q_incremental_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vault's column checks after two builds: the second one adds what its rows bring to the counts of the first."""
    apply_conf(spark)
    root = scratch_path(spark, "incremental-checks")
    for batch in (1, None):
        got = run_build(spark, fixtures.sources(spark, sf_dir, batch=batch), root, raise_on_check_failure=False)
    return got.checks


def q_source_query_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table whose definition brings its own query: readings of suspect quality with their meter's type."""
    apply_conf(spark)
    s, name = fixtures.sources(spark, sf_dir), "q_" + scratch_path(spark, "x").rsplit("-", 1)[-1]
    s.readings.createOrReplaceTempView(f"{name}_readings")
    s.assets.createOrReplaceTempView(f"{name}_assets")
    table = TableDef("suspect_readings", (*READINGS.fields, FieldDef("asset_type", "string")), source_query=f"""
        SELECT r.*, a.asset_type FROM {name}_readings r JOIN {name}_assets a USING (asset_id) WHERE r.quality_code = 'SUSPECT'""")
    return source_frame(spark, table, "sql", {})


def q_reference_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full-refresh reference table, refreshed twice, met by the readings that use its codes."""
    apply_conf(spark)
    path = f"{scratch_path(spark, 'reference')}/ref_reading_type"
    for _ in range(2):
        reference_table(spark, "ref_reading_type", "2025-01-01 00:00:00").coalesce(1).write.mode("overwrite").parquet(path)
    codes = spark.read.parquet(path)
    key = codes.columns[0]
    used = fixtures.sources(spark, sf_dir).readings.groupBy(F.col("reading_type").alias(key)).agg(F.count(F.lit(1)).alias("readings"))
    return codes.select(key).join(used, key, "left").select(F.col(key).alias("code"), F.coalesce("readings", F.lit(0)).alias("readings"))


IO_QUERIES = {name[2:]: fn for name, fn in dict(globals()).items()
              if name.startswith("q_") and callable(fn)}
