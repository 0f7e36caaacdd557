"""Analyst reports on the business views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vault import VaultFrames

RECENT_LIMIT = 20


def active_hierarchy(hierarchy: DataFrame, customers_current: DataFrame) -> DataFrame:
    """Active meters in the hierarchy with the customer's current name and type.

    ``customers_current`` is one row per customer (``business.current_customer``).
    """
    cd = customers_current.select("customer_hk", "customer_name", "customer_type")
    return (hierarchy.filter(F.col("meter_status") == "ACTIVE")
            .join(cd, "customer_hk", "left")
            .select("installation_id", "customer_name", "customer_type", "account_meter_id",
                    "meter_type", "meter_status")
            .orderBy("installation_id"))


def recent_measurements(measurements: DataFrame, on_date=None, limit: int = RECENT_LIMIT,
                        days_of: DataFrame | None = None) -> DataFrame:
    """Top ``limit`` measurements of one day, newest interval first.

    ``on_date`` defaults to the latest day of ``days_of`` (the measurement table behind the view, so
    that its one column is read and not the view evaluated twice; a scalar subquery, evaluated
    by Spark, not on the driver). The sort key is the full output row, so the
    top-k is deterministic under ties.
    """
    day = F.to_date("interval_start")
    if on_date is None:
        target = (measurements if days_of is None else days_of).select(F.max(day)).scalar()
    else:
        target = F.to_date(F.lit(on_date))
    cols = ["asset_id", "reading_value", "interval_start", "reading_type",
            "unit_of_measure", "quality_code"]
    return (measurements.filter(day == target)
            .select(F.col("meter_id").alias("asset_id"), *cols[1:])
            .orderBy(F.col("interval_start").desc(),
                     *[F.col(c).asc_nulls_first() for c in cols if c != "interval_start"])
            .limit(limit))


def quality_counts(sat_asset_measurements: DataFrame) -> DataFrame:
    return (sat_asset_measurements.groupBy("quality_code", "reading_status")
            .agg(F.count(F.lit(1)).alias("reading_count"))
            .orderBy(F.col("reading_count").desc()))


def hub_counts(v: VaultFrames) -> DataFrame:
    parts = [("Customers", v.hub_customer), ("Accounts", v.hub_customer_account),
             ("Assets", v.hub_asset)]
    out = None
    for label, df in parts:
        one = df.agg(F.count(F.lit(1)).alias("record_count")) \
                .select(F.lit(label).alias("entity"), "record_count")
        out = one if out is None else out.unionByName(one)
    return out
