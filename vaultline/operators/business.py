"""Business views over the raw vault: current state, hierarchy, legacy meters, as-of.

All joins are equi-joins on hub keys. Where a fact meets several per-key
dimensions (one row per key each), the dimensions are joined to each other
first, so the fact is exchanged once. The current-version lookups are grouped
aggregates and therefore arrive hash-partitioned by the hub key, which lets the
following joins on that key reuse the partitioning.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.temporal import ntz_literal
from .vault import VaultFrames
from .window import latest_by


def current_asset_details(sat_asset_details: DataFrame) -> DataFrame:
    """Latest version per asset: asset_hk, asset_type, asset_installation_date,
    asset_status, load_ts."""
    d = sat_asset_details.select("asset_hk", "load_ts", "asset_type",
                                 "asset_installation_date", "asset_status")
    return latest_by(d, ["asset_hk"], ["load_ts"], reduce_first=True)


def current_customer_details(sat_customer_details: DataFrame, reduced: bool = False) -> DataFrame:
    d = sat_customer_details.select("customer_hk", "load_ts", "customer_name", "customer_type")
    return latest_by(d, ["customer_hk"], ["load_ts"], reduce_first=not reduced)


def customer_accounts(v: VaultFrames) -> DataFrame:
    """Customers with their accounts through the link (``meter_id`` is the account id).

    The models also left-join the latest customer and account details without
    selecting from them; with at most one row per key those joins cannot change
    the result and are left out.
    """
    c = v.hub_customer.select("customer_hk", "customer_id",
                              F.col("load_ts").alias("customer_load_ts"))
    ln = v.link_customer_account.select("link_customer_account_hk", "customer_hk",
                                        "customer_account_hk",
                                        F.col("load_ts").alias("link_load_ts"))
    a = v.hub_customer_account.select("customer_account_hk", "customer_account_id",
                                      F.col("load_ts").alias("account_load_ts"))
    return (c.join(ln, "customer_hk").join(a, "customer_account_hk")
             .select(F.col("customer_id").alias("installation_id"),
                     F.col("customer_account_id").alias("meter_id"),
                     "customer_hk", "customer_account_hk", "link_customer_account_hk",
                     "customer_load_ts", "account_load_ts", "link_load_ts"))


def _current_asset(v: VaultFrames) -> DataFrame:
    if v.current_asset is not None:
        return v.current_asset.select("asset_hk", "load_ts", "asset_type",
                                      "asset_installation_date", "asset_status")
    return current_asset_details(v.sat_asset_details)


def current_customer(v: VaultFrames) -> DataFrame:
    if v.current_customer is not None:
        return v.current_customer.select("customer_hk", "load_ts", "customer_name",
                                         "customer_type")
    return current_customer_details(v.sat_customer_details)


def asset_details(v: VaultFrames) -> DataFrame:
    a = v.hub_asset.select("asset_hk", "asset_id", F.col("load_ts").alias("asset_load_ts"))
    d = _current_asset(v)
    return (a.join(d, "asset_hk", "left")
             .select(F.col("asset_id").alias("meter_id"), "asset_hk",
                     F.col("asset_type").alias("meter_type"),
                     F.col("asset_installation_date").alias("installation_date"),
                     F.col("asset_status").alias("meter_status"),
                     "asset_load_ts", F.col("load_ts").alias("detail_load_ts")))


def asset_measurements(v: VaultFrames) -> DataFrame:
    """Every measurement with its meter and the meter's current type and status."""
    meters = (v.hub_asset.select("asset_hk", "asset_id")
              .join(_current_asset(v).select("asset_hk", "asset_type", "asset_status"),
                    "asset_hk", "left"))
    m = v.sat_asset_measurements.select(
        "asset_hk", "reading_id", "reading_value", "interval_start", "interval_end",
        "reading_type", "unit_of_measure", "quality_code", "reading_status", "load_ts")
    return (m.join(meters, "asset_hk")
             .select(F.col("asset_id").alias("meter_id"),
                     F.col("asset_type").alias("meter_type"),
                     F.col("asset_status").alias("meter_status"),
                     "reading_id", "reading_value", "interval_start", "interval_end",
                     "reading_type", "unit_of_measure", "quality_code", "reading_status",
                     F.col("load_ts").alias("measurement_load_ts"), "asset_hk"))


def customer_asset_hierarchy(v: VaultFrames) -> DataFrame:
    """customer -> account -> asset through both links, with current asset details."""
    owners = v.hub_customer.select("customer_hk", F.col("customer_id").alias("installation_id"))
    contracts = v.hub_customer_account.select("customer_account_hk",
                                              F.col("customer_account_id").alias("account_meter_id"))
    devices = (v.hub_asset.select("asset_hk", F.col("asset_id").alias("asset_meter_id"))
               .join(_current_asset(v), "asset_hk", "left"))
    held = v.link_customer_account.select("customer_hk", "customer_account_hk")
    supplied = v.link_account_asset.select("customer_account_hk", "asset_hk")
    return (owners.join(held, "customer_hk").join(contracts, "customer_account_hk")
                  .join(supplied, "customer_account_hk").join(devices, "asset_hk")
                  .select("installation_id", "account_meter_id", "asset_meter_id",
                          F.col("asset_type").alias("meter_type"),
                          F.col("asset_installation_date").alias("installation_date"),
                          F.col("asset_status").alias("meter_status"),
                          "customer_hk", "customer_account_hk", "asset_hk"))


def meters(assets: DataFrame, accounts: DataFrame, readings: DataFrame | None = None,
           last: DataFrame | None = None) -> DataFrame:
    """Legacy view: one row per asset with its installation and last read time.

    Readings are reduced to one row per asset (``max(interval_end)``) before the
    join; the outer grouping then sees at most one row per asset and account. ``last`` (``asset_id``, ``last_read``)
    may supply that reduction, kept up to date batch by batch.
    """
    if last is None:
        last = readings.groupBy("asset_id").agg(F.max("interval_end").alias("last_read"))
    last = last.select("asset_id", "last_read")
    a = assets.select("asset_id", "account_id", "asset_type", "installation_date", "status")
    ca = accounts.select("account_id", "installation_id")
    j = a.join(ca, "account_id", "left").join(last, "asset_id", "left")
    return (j.groupBy("asset_id", "installation_id", "asset_type", "installation_date", "status")
             .agg(F.max("last_read").alias("last_read_date"))
             .select(F.col("asset_id").alias("meter_id"), "installation_id",
                     F.col("asset_type").alias("meter_type"), "installation_date",
                     "last_read_date", "status"))


def as_of(df: DataFrame, ts: str | Column, keys: list[str] | None = None,
          order: str = "load_ts") -> DataFrame:
    """State of an insert-only vault table at ``ts``: rows loaded at or before it;
    with ``keys``, only the latest such row per key (satellites)."""
    t = ntz_literal(ts) if isinstance(ts, str) else ts
    past = df.filter(F.col(order) <= t)
    if "load_day" in df.columns:  # partition pruning on the day-partitioned table
        past = past.filter(F.col("load_day") <= F.to_date(t))
    if keys:
        past = latest_by(past, keys, [order])
    return past


SNAPSHOT_FORMATS = ("iceberg", "delta", "hudi")


def time_travel(spark, table: str, ts: str, keys: list[str] | None = None,
                order: str = "load_ts") -> DataFrame:
    """``FOR SYSTEM_TIME AS OF``: a snapshot read where the table's format has snapshots,
    otherwise ``as_of`` on the insert-only table. Errors of a snapshot read (an expired
    snapshot, no permission) are raised, not answered with something else."""
    when = datetime.fromisoformat(ts).strftime("%Y-%m-%d %H:%M:%S.%f")
    provider = None
    if not spark.catalog.getTable(table).isTemporary:
        about = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
        provider = (about.get("Provider") or "").lower()
    if provider in SNAPSHOT_FORMATS:
        snap = spark.sql(f"SELECT * FROM {table} TIMESTAMP AS OF '{when}'")
        return latest_by(snap, keys, [order]) if keys else snap
    return as_of(spark.table(table), ts, keys, order)
