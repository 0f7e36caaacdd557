"""One vault build: stage -> raw vault loads -> reference tables -> views -> checks.

The staging feeds all nine loads; it is computed once and written under the shared checkpoint
folder (a lineage cut that survives executor loss), so the fact is read and its dimensions are joined once however many loads
there are. Hubs and links reduce it to a row per key and record source where it lies. The loads are independent jobs and are submitted
together from a small thread pool so the cluster runs them side by side; those that shuffle every reading take turns, and a
query's shuffle files go when it ends, so that disk holds one of them at a time. Checks count what each load adds (``check_state.py``); failures are
raised at the end of the run; the staged copy is deleted. Tables are folders or catalog tables (``targets.py``).
"""

from __future__ import annotations

import datetime as dt
import threading
from concurrent.futures import ThreadPoolExecutor
from contextlib import AbstractContextManager, nullcontext
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import business, quality, reports
from ..operators.references import REFERENCE_ROWS, reference_table
from ..operators.staging import stage_readings
from ..operators.vault import (HUBS, LINKS, LOAD_DAY, LOAD_TS, SAT_ASSET_MEASUREMENTS,
                               SATELLITES, Satellite, VaultFrames, hub_rows, link_rows,
                               measurement_rows, merge_current, satellite_rows, with_load_day)
from ..operators.window import latest_by
from ..session import delete_path, released_shuffles, scratch_path, sized_shuffles
from ..sources.fixtures import Sources
from . import measurements
from .check_state import CheckState, Counts, new_repeats, null_metrics, report
from .ingest import late_filter, new_load_id
from .sinks import create_view, observed, read_or_none
from .targets import CatalogTarget, PathTarget

VAULT_TABLES = ("hub_customer", "hub_customer_account", "hub_asset",
                "link_customer_account", "link_account_asset", "sat_customer_details",
                "sat_customer_acc_details", "sat_asset_details", "sat_asset_measurements")
PARTITIONED = {SAT_ASSET_MEASUREMENTS.name: [LOAD_DAY]}


@dataclass
class BuildResult:
    appended: dict[str, int]
    checks: DataFrame | None


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def read_vault(spark: SparkSession, root: str, target: PathTarget | CatalogTarget | None = None) -> VaultFrames:
    """The stored raw-vault tables (measurements without the partition column)."""
    frames = {}
    for n in VAULT_TABLES:
        df = spark.read.parquet(table_path(root, n)) if target is None else target.read(n)
        frames[n] = df.drop(LOAD_DAY) if LOAD_DAY in df.columns else df
    return VaultFrames(**frames)


def register_views(spark: SparkSession, root: str, load_ts: str | None = None) -> dict[str, DataFrame]:
    """Temp views over the stored vault: raw tables, references and business views."""
    v = read_vault(spark, root)
    views = {n: create_view(df, n) for n, df in v.as_dict().items()}
    for ref in REFERENCE_ROWS:
        p = table_path(root, ref)
        df = read_or_none(spark, p)
        views[ref] = create_view(df if df is not None else reference_table(spark, ref, load_ts), ref)
    views["bv_customer_accounts"] = create_view(business.customer_accounts(v), "bv_customer_accounts")
    views["bv_asset_details"] = create_view(business.asset_details(v), "bv_asset_details")
    views["bv_asset_measurements"] = create_view(business.asset_measurements(v),
                                                 "bv_asset_measurements")
    views["bv_customer_asset_hierarchy"] = create_view(business.customer_asset_hierarchy(v),
                                                       "bv_customer_asset_hierarchy")
    # the reports, as views (the hierarchy report adds the customer's current name/type)
    views["rpt_active_hierarchy"] = create_view(
        reports.active_hierarchy(views["bv_customer_asset_hierarchy"],
                                 business.current_customer(v)), "rpt_active_hierarchy")
    views["rpt_quality_counts"] = create_view(reports.quality_counts(v.sat_asset_measurements),
                                              "rpt_quality_counts")
    views["rpt_hub_counts"] = create_view(reports.hub_counts(v), "rpt_hub_counts")
    return views


CURRENT_SUFFIX = "__current"
MARKER_SUFFIX = "__current_marker"
MARKER = "sat_rows"
CHECK_STATE = "_check_state"
BUCKET = "key_bucket"
BUCKETS = 256


def _bucketed(df: DataFrame, sat: Satellite) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(sat.hk), F.lit(BUCKETS)).cast("int"))


def _load_current(spark: SparkSession, root: str, sat: Satellite,
                  stored: DataFrame | None) -> tuple[DataFrame | None, int, bool]:
    """The satellite's one-row-per-key current-version table, the satellite's row count,
    and whether the table had to be rebuilt. A marker records the count the table was
    built for; if a run died between appending rows and replacing buckets, the counts differ and
    the table is rebuilt from the satellite (the only full scan, and a rare one)."""
    if stored is None:
        return None, 0, True
    n = stored.count()  # Parquet footers only
    cur = read_or_none(spark, table_path(root, sat.name + CURRENT_SUFFIX))
    marker = read_or_none(spark, table_path(root, sat.name + MARKER_SUFFIX))
    if cur is not None and marker is not None and BUCKET in cur.columns:
        row = marker.first()
        if row is not None and row[MARKER] == n:
            return cur, n, False
    rebuilt = latest_by(stored.select(sat.hk, LOAD_TS, sat.hashdiff), [sat.hk], [LOAD_TS],
                        reduce_first=True)
    return _bucketed(rebuilt, sat), n, True


MOST_RANGES = 200


def _days(rows: DataFrame) -> list:
    """The distinct days of the rows' load times, ascending (as many values as the batch has days)."""
    got = rows.select(F.to_date(LOAD_TS).alias("d")).filter("d IS NOT NULL").distinct().collect()
    return sorted(r.d for r in got)


def _day_ranges(days: list, most: int = MOST_RANGES) -> list[tuple]:
    """Days as at most ``most`` ranges (first, last), neighbours together; then the smallest gaps are included."""
    ranges: list[list] = []
    for d in days:
        if ranges and (d - ranges[-1][1]).days <= 1:
            ranges[-1][1] = d
        else:
            ranges.append([d, d])
    if len(ranges) > most:
        gaps = sorted(range(1, len(ranges)), key=lambda i: ranges[i][0] - ranges[i - 1][1], reverse=True)
        cut = [0, *sorted(gaps[:most - 1]), len(ranges)]
        ranges = [[ranges[a][0], ranges[z - 1][1]] for a, z in zip(cut, cut[1:])]
    return [tuple(r) for r in ranges]


def _unstored(rows: DataFrame, stored: DataFrame, sat: Satellite) -> DataFrame:
    """Rows that are not stored already with the same key, time and content: a replayed batch
    adds nothing, even where it holds several versions of a key. ``rows`` are written already; only stored rows of
    the days that they touch are read (as ranges, which reach the scan), however late one of them is."""
    near = F.lit(False)
    for first, last in _day_ranges(_days(rows)):
        begin, end = (F.to_timestamp_ntz(F.lit(f"{d} 00:00:00")) for d in (first, last + dt.timedelta(days=1)))
        near = near | ((F.col(LOAD_TS) >= begin) & (F.col(LOAD_TS) < end))
    same = [sat.hk, LOAD_TS, sat.hashdiff]
    return rows.join(stored.filter(near).select(*same), same, "left_anti").select(*rows.columns)


def _append_observed(rows: DataFrame, name: str, target, partition_by=None) -> dict[str, int]:
    """Append and return what was written: ``rows`` and the NULLs of the checked columns."""
    obs = Observation(f"load_{name}_{new_load_id()}")
    metrics = [F.count(F.lit(1)).alias("rows"), *null_metrics(name)]
    names = ["rows", *[f"null_{c}" for c in quality.VAULT_CHECKS[name].not_null]]
    target.append(rows.observe(obs, *metrics), name, partition_by)
    return {n: int(observed(obs, n, 0)) for n in names}


def _load_satellite(spark: SparkSession, root: str, staged: DataFrame, sat: Satellite,
                    stored: DataFrame | None, target: PathTarget | CatalogTarget | None = None,
                    turn: AbstractContextManager = nullcontext()) -> dict[str, int]:
    """Append new satellite versions and keep the current-version table in step. Later loads write what is new to scratch
    first, in their ``turn``, as that shuffles all rows, and replace the buckets of the current-version table that it touches."""
    target = target or PathTarget(spark, root)
    current, n, whole = _load_current(spark, root, sat, stored)
    scratch = scratch_path(spark, f"{sat.name}-load")
    rows = satellite_rows(staged, sat, existing=stored, current=current)
    if stored is None:
        got = _append_observed(rows, sat.name, target)
        new = target.read(sat.name)
        k, before = new.count() if new is not None else 0, None
    else:
        with turn:
            rows.write.parquet(f"{scratch}/changed")
        _unstored(spark.read.parquet(f"{scratch}/changed"), stored, sat).write.parquet(f"{scratch}/rows")
        new = spark.read.parquet(f"{scratch}/rows")
        k, before = new.count(), current
        got = {"rows": 0, **{f"null_{c}": 0 for c in quality.VAULT_CHECKS[sat.name].not_null}}
    if k or whole:
        if not whole:
            touched = [r[0] for r in _bucketed(new.select(sat.hk), sat).select(BUCKET).distinct().collect()]
            before = current.filter(F.col(BUCKET).isin(touched))  # at most BUCKETS values
        merged = merge_current(before, new, sat) if new is not None else before
        _bucketed(merged, sat).write.parquet(f"{scratch}/current")
        if stored is not None and k:
            got = _append_observed(new, sat.name, target)
        mode = "static" if whole else "dynamic"
        (spark.read.parquet(f"{scratch}/current").hint("rebalance", BUCKET).write.mode("overwrite")
         .option("partitionOverwriteMode", mode).partitionBy(BUCKET)
         .parquet(table_path(root, sat.name + CURRENT_SUFFIX)))
        spark.range(1).select(F.lit(n + k).cast("long").alias(MARKER)).coalesce(1) \
            .write.mode("overwrite").option("partitionOverwriteMode", "static") \
            .parquet(table_path(root, sat.name + MARKER_SUFFIX))
    delete_path(spark, scratch)
    return {**got, "rows": k}


def run_build(spark: SparkSession, src: Sources, root: str, load_ts: str | None = None,
              key_mode: str = "natural", dedup_sources: bool = True,
              run_checks: bool = True, raise_on_check_failure: bool = True,
              parallelism: int = 4, compact: bool = False,
              lookback_hours: int | None = None, catalog: str | None = None, buckets: int = 0,
              key_sketch: bool = False) -> BuildResult:
    """Build (or incrementally extend) the vault stored under ``root``.

    All tables come from the reading-grain staging, which is written once; hubs and links reduce it by
    a hash aggregate that combines before any shuffle. Incremental runs compare
    satellites against their current-version tables and measurements against the
    day partitions the batch touches, so their cost follows the batch, not the
    history.

    ``dedup_sources`` (lake tables keep row versions) uses each dimension's current row.
    ``compact`` stores only the change points of satellites. ``lookback_hours`` stages only readings
    that arrived later than that before the newest stored measurement (default: all). ``catalog`` stores the tables in that
    namespace (``buckets``: by hash of their keys), with the build's own state still below ``root``. ``key_sketch`` keeps
    a filter of the measurements' keys, so that new readings are loaded without a look at the table.
    """
    target = CatalogTarget(spark, catalog, buckets) if catalog else PathTarget(spark, root)
    if catalog and key_sketch:
        raise ValueError("key_sketch needs a vault of folders")
    scratch = scratch_path(spark, "build")
    with sized_shuffles(spark, src.readings), released_shuffles(spark):
        try:
            return _run_build(spark, src, root, scratch, load_ts, key_mode, dedup_sources, run_checks,
                              raise_on_check_failure, parallelism, compact, lookback_hours, target, key_sketch)
        finally:
            delete_path(spark, scratch)


def _run_build(spark, src, root, scratch, load_ts, key_mode, dedup_sources, run_checks,
               raise_on_check_failure, parallelism, compact, lookback_hours, target, key_sketch) -> BuildResult:
    readings = src.readings
    measured = target.read(SAT_ASSET_MEASUREMENTS.name)
    if lookback_hours is not None and measured is not None:
        readings = late_filter(readings, measured.select(F.col(LOAD_TS).alias("creation_time")),
                               "creation_time", lookback_hours)

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{scratch}/{name}")
        return spark.read.parquet(f"{scratch}/{name}")

    wide = stage_readings(readings, src.assets, src.customer_accounts, src.customers, key_mode=key_mode,
                          dedup_sources=dedup_sources)
    wanted = {c for b in (*HUBS, *LINKS, *SATELLITES, SAT_ASSET_MEASUREMENTS) for c in b.columns}  # what the loads read
    staged = written(wide.select(*[c for c in wide.columns if c in wanted]), "staged")
    stored = {n: df for n in VAULT_TABLES if (df := target.read(n)) is not None}
    by_name = {b.name: b for b in (*HUBS, *LINKS, *SATELLITES)}
    check_state, load_id = CheckState(spark, table_path(root, CHECK_STATE)), new_load_id()
    known = check_state.known()
    check_state.mark(VAULT_TABLES, load_id)

    def keyed_rows(name: str) -> DataFrame:
        rows = hub_rows if name in {h.name for h in HUBS} else link_rows
        return rows(staged, by_name[name], stored.get(name))

    turn = threading.Lock()

    def load(name: str) -> tuple[str, dict[str, int], Counts]:
        repeats: Counts = {}
        if name in {s.name for s in SATELLITES}:
            sat = by_name[name]
            got = _load_satellite(spark, root, satellite_rows(staged, sat, compact=True) if compact else staged,
                                  sat, stored.get(name), target, turn)
        elif name == SAT_ASSET_MEASUREMENTS.name:
            def put(rows: DataFrame) -> dict[str, int]:
                return _append_observed(rows, name, target, PARTITIONED[name])
            with turn:
                if isinstance(target, CatalogTarget):
                    got = put(with_load_day(measurement_rows(staged, SAT_ASSET_MEASUREMENTS, stored.get(name), prune_days=True)))
                else:
                    got = measurements.load(spark, staged, target.path(name), key_sketch, put)
        else:
            rows = written(keyed_rows(name), name)  # small: read by the check of repeats, and by the append
            for key in quality.VAULT_CHECKS[name].unique:
                repeats[key, "unique"] = new_repeats(rows, stored.get(name), key).first()[0]
            got = _append_observed(rows, name, target)
        nulls = {(c.removeprefix("null_"), "not_null"): n for c, n in got.items() if c != "rows"}
        return name, got, {**nulls, **repeats}

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        loaded = list(pool.map(load, VAULT_TABLES))
    appended = {name: got["rows"] for name, got, _ in loaded}

    for ref in REFERENCE_ROWS:  # full refresh (small fixed tables)
        target.replace(reference_table(spark, ref, load_ts).coalesce(1), ref)

    # tables whose counts were complete, or that are new, add up; others are read in full, if checks are wanted
    counted = {name: counts for name, _, counts in loaded if (name in known or name not in stored) and (
        len(counts) == len(quality.VAULT_CHECKS[name].not_null) + len(quality.VAULT_CHECKS[name].unique))}
    rest = [n for n in VAULT_TABLES if n not in counted] if run_checks else []
    if rest:
        frames = read_vault(spark, root, target).as_dict()
        for r in quality.run_checks(frames, {n: quality.VAULT_CHECKS[n] for n in rest}).collect():
            counted.setdefault(r.table_name, {})[r.column_name, r.test] = r.failures
    check_state.add(load_id, counted, [n for n in counted if n in rest or n not in stored])
    checks = None
    if run_checks:
        totals = {n: {c: v + (0 if n in rest else known.get(n, {}).get(c, 0)) for c, v in counts.items()}
                  for n, counts in counted.items()}
        checks = report(spark, totals)
        p = table_path(root, "_checks")
        checks.write.mode("overwrite").parquet(p)
        checks = spark.read.parquet(p)
        if raise_on_check_failure:
            quality.raise_on_failure(checks)
    return BuildResult(appended, checks)
