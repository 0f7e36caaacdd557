"""Registered queries: each takes (spark, sf_dir) and returns a lazy DataFrame.

Every query reads the driver's tables through the fixture mapping and runs over
them whole; the only row-count limit is the top-k report, where it is the
feature.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import hash_key
from ..operators import business, quality, reports
from ..operators.staging import seen_rows, stage_as_of, stage_asset_span, stage_readings
from ..operators.window import latest_by
from ..operators.vault import (HUB_ASSET, HUB_CUSTOMER, HUB_CUSTOMER_ACCOUNT,
                               LINK_ACCOUNT_ASSET, LINK_CUSTOMER_ACCOUNT,
                               SAT_ASSET_DETAILS, SAT_ASSET_MEASUREMENTS,
                               SAT_CUSTOMER_ACC_DETAILS, SAT_CUSTOMER_DETAILS,
                               build_vault, compact_satellite, hub_rows,
                               link_rows, measurement_rows, satellite_rows, upsert_rows)
from ..session import apply_conf
from ..sources import fixtures
from .ingest import late_filter

# Fixed parameters of the registered queries.
AS_OF_MEASUREMENTS = "1997-01-01 00:00:00"
AS_OF_CUSTOMER = "1998-07-01 00:00:00"


def staged(spark: SparkSession, sf_dir: str, changed: bool = False,
           batch: int | None = None) -> DataFrame:
    apply_conf(spark)
    s = fixtures.sources(spark, sf_dir, changed=changed, batch=batch)
    return stage_readings(s.readings, s.assets, s.customer_accounts, s.customers)


def span(spark: SparkSession, sf_dir: str, batch: int | None = None) -> DataFrame:
    """Asset-grain staging with first and last load times (lazy)."""
    apply_conf(spark)
    s = fixtures.sources(spark, sf_dir, batch=batch)
    return stage_asset_span(s.readings, s.assets, s.customer_accounts, s.customers)


def seen(spark: SparkSession, sf_dir: str, which: str = "first",
         batch: int | None = None) -> DataFrame:
    """Asset-grain staging (readings pre-aggregated per asset before the join)."""
    return seen_rows(span(spark, sf_dir, batch), which)


class LazyVault:
    """The vault of one first load, planned lazily and table by table (the same
    attributes as ``VaultFrames``): a query plans only the tables it reads.

    Hubs, links and current details come from the asset-grain staging, satellites and
    measurements from the reading-grain staging. Nothing runs or is written while a query is
    planned, at any size: consumers of the same staging share its exchanges. A stored vault
    (``run_build``) materialises both stagings once instead.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def _staged(self) -> DataFrame:
        return staged(self.spark, self.sf_dir)

    @cached_property
    def _span(self) -> DataFrame:
        return span(self.spark, self.sf_dir)

    def _hub(self, h):
        return hub_rows(seen_rows(self._span, "first"), h, reduced=True)

    def _link(self, ln):
        return link_rows(seen_rows(self._span, "first"), ln, reduced=True)

    hub_customer = cached_property(lambda self: self._hub(HUB_CUSTOMER))
    hub_customer_account = cached_property(lambda self: self._hub(HUB_CUSTOMER_ACCOUNT))
    hub_asset = cached_property(lambda self: self._hub(HUB_ASSET))
    link_customer_account = cached_property(lambda self: self._link(LINK_CUSTOMER_ACCOUNT))
    link_account_asset = cached_property(lambda self: self._link(LINK_ACCOUNT_ASSET))
    sat_customer_details = cached_property(
        lambda self: satellite_rows(self._staged, SAT_CUSTOMER_DETAILS))
    sat_customer_acc_details = cached_property(
        lambda self: satellite_rows(self._staged, SAT_CUSTOMER_ACC_DETAILS))
    sat_asset_details = cached_property(
        lambda self: satellite_rows(self._staged, SAT_ASSET_DETAILS))
    sat_asset_measurements = cached_property(
        lambda self: measurement_rows(self._staged, SAT_ASSET_MEASUREMENTS))

    @cached_property
    def current_asset(self) -> DataFrame:
        last = seen_rows(self._span, "last")
        return latest_by(last.select("asset_hk", "load_ts", "asset_type",
                                     "asset_installation_date", "asset_status"),
                         ["asset_hk"], ["load_ts"])

    @cached_property
    def current_customer(self) -> DataFrame:
        return business.current_customer_details(seen_rows(self._span, "last"), reduced=True)

    def as_dict(self) -> dict[str, DataFrame]:
        names = ("hub_customer", "hub_customer_account", "hub_asset", "link_customer_account",
                 "link_account_asset", "sat_customer_details", "sat_customer_acc_details",
                 "sat_asset_details", "sat_asset_measurements")
        return {n: getattr(self, n) for n in names}


def vault(spark: SparkSession, sf_dir: str) -> LazyVault:
    return LazyVault(spark, sf_dir)


def _sat_cd_history(spark, sf_dir) -> DataFrame:
    """sat_customer_details after batch 1 plus the incremental load of changed batch 2."""
    first = satellite_rows(staged(spark, sf_dir, batch=1), SAT_CUSTOMER_DETAILS)
    # holds for every row, and names all columns: the change detection, which reads three, shares the exchanges of the history
    first = first.filter(F.pmod(F.xxhash64(*first.columns), F.lit(1)) == 0)
    new = satellite_rows(staged(spark, sf_dir, changed=True), SAT_CUSTOMER_DETAILS,
                         existing=first)
    return first, new


# -- keys ---------------------------------------------------------------------

def q_hash_key_single(spark, sf_dir):
    apply_conf(spark)
    c = fixtures.customers(fixtures.read_tables(spark, sf_dir))
    return c.select("installation_id", hash_key("installation_id").alias("installation_hash"))


def q_hash_key_multi(spark, sf_dir):
    apply_conf(spark)
    a = fixtures.customer_accounts(fixtures.read_tables(spark, sf_dir))
    return a.select("account_id", "installation_id",
                    hash_key("installation_id", "account_id").alias("link_customer_account_hk"))


def q_hash_diff_timestamp(spark, sf_dir):
    apply_conf(spark)
    a = fixtures.assets(fixtures.read_tables(spark, sf_dir))
    cols = ["asset_serial_number", "asset_type", "manufacturer", "model",
            "installation_date", "status"]
    return a.select("asset_id", hash_key(*cols, schema=a.schema).alias("asset_details_hashdiff"))


# -- staging --------------------------------------------------------------------

def q_stage_readings(spark, sf_dir):
    return staged(spark, sf_dir)


def q_stage_as_of(spark, sf_dir):
    """Readings with their asset, account and customer as they were when the reading was taken."""
    apply_conf(spark)
    s = fixtures.history(spark, sf_dir)
    return stage_as_of(s.readings, s.assets, s.customer_accounts, s.customers)


def q_stage_null_key_filter(spark, sf_dir):
    """Readings from an unknown source system arrive without an asset: they must
    vanish from staging, the rest must stay."""
    apply_conf(spark)
    s = fixtures.sources(spark, sf_dir)
    r = s.readings.withColumn(
        "asset_id", F.when(F.col("source_system").isNull(), F.lit(None).cast("string"))
                     .otherwise(F.col("asset_id")))
    st = stage_readings(r, s.assets, s.customer_accounts, s.customers)
    return st.select("reading_id", "customer_id", "customer_account_id", "asset_id", "load_ts",
                     "record_source")


# -- hubs, links -----------------------------------------------------------------

def q_hub_customer(spark, sf_dir):
    return hub_rows(seen(spark, sf_dir), HUB_CUSTOMER)


def q_hub_customer_account(spark, sf_dir):
    return hub_rows(seen(spark, sf_dir), HUB_CUSTOMER_ACCOUNT)


def q_hub_asset(spark, sf_dir):
    return hub_rows(seen(spark, sf_dir), HUB_ASSET)


def q_hub_customer_incremental(spark, sf_dir):
    first = hub_rows(seen(spark, sf_dir, batch=1), HUB_CUSTOMER)
    return hub_rows(seen(spark, sf_dir), HUB_CUSTOMER, existing=first)


def q_hub_customer_account_incremental(spark, sf_dir):
    first = hub_rows(seen(spark, sf_dir, batch=1), HUB_CUSTOMER_ACCOUNT)
    return hub_rows(seen(spark, sf_dir), HUB_CUSTOMER_ACCOUNT, existing=first)


def q_hub_asset_incremental(spark, sf_dir):
    first = hub_rows(seen(spark, sf_dir, batch=1), HUB_ASSET)
    return hub_rows(seen(spark, sf_dir), HUB_ASSET, existing=first)


def q_link_customer_account_incremental(spark, sf_dir):
    first = link_rows(seen(spark, sf_dir, batch=1), LINK_CUSTOMER_ACCOUNT)
    return link_rows(seen(spark, sf_dir), LINK_CUSTOMER_ACCOUNT, existing=first)


def q_link_customer_account(spark, sf_dir):
    return link_rows(seen(spark, sf_dir), LINK_CUSTOMER_ACCOUNT)


def q_link_account_asset(spark, sf_dir):
    return link_rows(seen(spark, sf_dir), LINK_ACCOUNT_ASSET)


def q_link_account_asset_incremental(spark, sf_dir):
    first = link_rows(seen(spark, sf_dir, batch=1), LINK_ACCOUNT_ASSET)
    return link_rows(seen(spark, sf_dir), LINK_ACCOUNT_ASSET, existing=first)


# -- satellites ------------------------------------------------------------------

def q_sat_customer_details(spark, sf_dir):
    return satellite_rows(staged(spark, sf_dir), SAT_CUSTOMER_DETAILS)


def q_sat_customer_acc_details(spark, sf_dir):
    return satellite_rows(staged(spark, sf_dir), SAT_CUSTOMER_ACC_DETAILS)


def q_sat_asset_details(spark, sf_dir):
    return satellite_rows(staged(spark, sf_dir), SAT_ASSET_DETAILS)


def _renamed(readings_batch: DataFrame, column: str, hashdiff_input: str) -> DataFrame:
    """Staged rows in which every third asset has another value, with its new hash diff."""
    third = F.pmod(F.substring("asset_id", 6, 20).cast("long"), F.lit(3)) == 0
    return readings_batch.withColumn(column, F.when(third, F.lit("RELOCATED")).otherwise(F.col(column))) \
        .withColumn(hashdiff_input, F.when(third, F.md5(F.col(hashdiff_input))).otherwise(F.col(hashdiff_input)))


def q_sat_customer_acc_details_incremental(spark, sf_dir):
    first = satellite_rows(staged(spark, sf_dir, batch=1), SAT_CUSTOMER_ACC_DETAILS)
    new = _renamed(staged(spark, sf_dir), "account_status", "customer_account_hashdiff")
    return satellite_rows(new, SAT_CUSTOMER_ACC_DETAILS, existing=first)


def q_sat_asset_details_incremental(spark, sf_dir):
    first = satellite_rows(staged(spark, sf_dir, batch=1), SAT_ASSET_DETAILS)
    new = _renamed(staged(spark, sf_dir), "asset_status", "asset_details_hashdiff")
    return satellite_rows(new, SAT_ASSET_DETAILS, existing=first)


def q_sat_customer_details_incremental(spark, sf_dir):
    _, new = _sat_cd_history(spark, sf_dir)
    return new


def q_sat_upsert(spark, sf_dir):
    first, new = _sat_cd_history(spark, sf_dir)
    return upsert_rows(first, new, ["customer_hk", "load_ts"])


def q_sat_compact(spark, sf_dir):
    first, new = _sat_cd_history(spark, sf_dir)
    return compact_satellite(first.unionByName(new), SAT_CUSTOMER_DETAILS)


def q_sat_asset_measurements(spark, sf_dir):
    return measurement_rows(staged(spark, sf_dir), SAT_ASSET_MEASUREMENTS)


def q_sat_asset_measurements_incremental(spark, sf_dir):
    first = measurement_rows(staged(spark, sf_dir, batch=1), SAT_ASSET_MEASUREMENTS)
    return measurement_rows(staged(spark, sf_dir), SAT_ASSET_MEASUREMENTS, existing=first)


# -- business views ----------------------------------------------------------------

def q_bv_customer_accounts(spark, sf_dir):
    return business.customer_accounts(vault(spark, sf_dir))


def q_bv_asset_details(spark, sf_dir):
    return business.asset_details(vault(spark, sf_dir))


def q_bv_asset_measurements(spark, sf_dir):
    return business.asset_measurements(vault(spark, sf_dir))


def q_bv_customer_asset_hierarchy(spark, sf_dir):
    return business.customer_asset_hierarchy(vault(spark, sf_dir))


def q_meters_legacy(spark, sf_dir):
    apply_conf(spark)
    s = fixtures.sources(spark, sf_dir)
    return business.meters(s.assets, s.customer_accounts, s.readings)


def q_as_of_measurements(spark, sf_dir):
    return business.as_of(vault(spark, sf_dir).sat_asset_measurements, AS_OF_MEASUREMENTS)


def q_as_of_customer(spark, sf_dir):
    first, new = _sat_cd_history(spark, sf_dir)
    return business.as_of(first.unionByName(new), AS_OF_CUSTOMER, keys=["customer_hk"])


# -- reports -------------------------------------------------------------------------

def q_active_hierarchy(spark, sf_dir):
    v = vault(spark, sf_dir)
    return reports.active_hierarchy(business.customer_asset_hierarchy(v),
                                    business.current_customer(v))


def q_recent_measurements(spark, sf_dir):
    v = vault(spark, sf_dir)
    return reports.recent_measurements(business.asset_measurements(v), days_of=v.sat_asset_measurements)


def q_sql_ordinals(spark, sf_dir):
    """SQL text with positional grouping and ordering over a registered view."""
    vault(spark, sf_dir).sat_asset_measurements.createOrReplaceTempView("measured")
    return spark.sql("SELECT reading_type, unit_of_measure, count(*) AS readings, sum(reading_value) AS total "
                     "FROM measured GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2")


def q_late_filter(spark, sf_dir):
    """Readings newer than the first delivery's latest minus a day, in a staged model's own filter."""
    first = staged(spark, sf_dir, batch=1)
    return late_filter(staged(spark, sf_dir), first, "load_ts", 24).select(
        "reading_id", "asset_hk", "load_ts", "reading_value")


def q_quality_counts(spark, sf_dir):
    return reports.quality_counts(vault(spark, sf_dir).sat_asset_measurements)


def q_hub_counts(spark, sf_dir):
    return reports.hub_counts(vault(spark, sf_dir))


# -- quality -----------------------------------------------------------------------

def q_check_not_null(spark, sf_dir):
    return quality.run_checks(vault(spark, sf_dir).as_dict(),
                              tests=("not_null",))


def q_check_unique(spark, sf_dir):
    return quality.run_checks(vault(spark, sf_dir).as_dict(),
                              tests=("unique",))


def q_check_orphans(spark, sf_dir):
    apply_conf(spark)
    s = fixtures.sources(spark, sf_dir)
    parts = [
        quality.orphans(s.customer_accounts, "customer_accounts", "installation_id",
                        s.customers, "installation_id"),
        quality.orphans(s.assets, "assets", "account_id", s.customer_accounts, "account_id"),
        quality.orphans(s.readings, "readings", "asset_id", s.assets, "asset_id"),
    ]
    return quality._union(parts)


def q_check_code_domain(spark, sf_dir):
    apply_conf(spark)
    return quality.code_checks(fixtures.sources(spark, sf_dir).as_dict())


def q_source_checks(spark, sf_dir):
    """Declared integrity of the source tables; closed accounts violate the status list."""
    apply_conf(spark)
    return quality.source_checks(fixtures.sources(spark, sf_dir).as_dict())


def q_row_counts(spark, sf_dir):
    apply_conf(spark)
    s = fixtures.sources(spark, sf_dir)
    st = stage_readings(s.readings, s.assets, s.customer_accounts, s.customers)
    v = build_vault(st, first_seen=seen_rows(stage_asset_span(
        s.readings, s.assets, s.customer_accounts, s.customers), "first"))
    return quality.row_counts({**s.as_dict(), "stg_meter_data": st, **v.as_dict()})


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in dict(globals()).items()
    if name.startswith("q_") and callable(fn)
}


def _with_io() -> None:
    from .catalog_io import IO_QUERIES
    QUERIES.update(IO_QUERIES)


_with_io()
