"""Map the driver's TPC-H-style tables onto the four operational source entities.

customers <- customer x nation x region, customer_accounts <- orders grouped by
(o_custkey, o_orderpriority), assets <- orders, readings <- lineitem. Every
expression is a built-in Column; nothing leaves the JVM. The mapping is 1:1 or a
grouping, so its work grows linearly with the input tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.temporal import add_days, add_minutes, ntz_literal

# Fixed values of the test mapping.
REGISTRATION_TS = "1995-01-01 00:00:00"
BATCH1_END = "1998-07-01 00:00:00"      # batch 1 = readings created before this
CHANGED_BALANCE = 2000                   # batch 2 marks these customers INACTIVE
CUSTOMERS_MOVED = "1996-01-01 00:00:00"  # history: when they became so
ASSET_RUNS_DAYS = 60                     # history: an INACTIVE asset was ACTIVE so long

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events", "documents", "embeddings", "pages",
                 "benchmark", "labels", "conversations")


def read_tables(spark: SparkSession, sf_dir: str, names=("region", "nation", "customer",
                                                           "orders", "lineitem", "events")
                ) -> dict[str, DataFrame]:
    base = sf_dir.rstrip("/")
    return {n: spark.read.parquet(f"{base}/{n}.parquet") for n in names}


def _s(c: str) -> Column:
    return F.col(c).cast("string")


def _null_ts() -> Column:
    return F.lit(None).cast("timestamp_ntz")


def _account_id(custkey: str, priority: str) -> Column:
    return F.concat(F.lit("ACC"), _s(custkey), F.lit("-"), F.substring(priority, 1, 1))


def customers(t: dict[str, DataFrame], changed: bool = False) -> DataFrame:
    c, n, r = t["customer"], t["nation"], t["region"]
    status = F.when(F.col("c_acctbal") < 0, "INACTIVE").otherwise("ACTIVE")
    if changed:
        status = F.when(F.col("c_acctbal") < CHANGED_BALANCE, "INACTIVE").otherwise(status)
    reg = ntz_literal(REGISTRATION_TS)
    return (c.join(n, c.c_nationkey == n.n_nationkey)
             .join(r, n.n_regionkey == r.r_regionkey)
             .select(F.concat(F.lit("INST"), _s("c_custkey")).alias("installation_id"),
                     F.col("c_name").alias("customer_name"),
                     F.col("c_mktsegment").alias("customer_type"),
                     F.lit(None).cast("string").alias("address"),
                     F.col("r_name").alias("city"),
                     F.lit(None).cast("string").alias("postal_code"),
                     F.col("n_name").alias("country"),
                     reg.alias("registration_date"),
                     reg.alias("last_modified"),
                     status.alias("status")))


def customer_accounts(t: dict[str, DataFrame]) -> DataFrame:
    o = t["orders"]
    g = (o.groupBy("o_custkey", "o_orderpriority")
          .agg(F.min("o_orderdate").alias("opened"), F.max("o_orderdate").alias("last")))
    prio = F.col("o_orderpriority")
    closed = prio == "4-NOT SPECIFIED"
    return g.select(
        _account_id("o_custkey", "o_orderpriority").alias("account_id"),
        F.concat(F.lit("INST"), _s("o_custkey")).alias("installation_id"),
        F.concat(F.lit("A-"), _s("o_custkey"), F.lit("-"),
                 F.substring("o_orderpriority", 1, 1)).alias("account_number"),
        F.when(prio == "5-LOW", "PREPAID").otherwise("POSTPAID").alias("account_type"),
        F.when(prio == "1-URGENT", "MONTHLY").when(prio == "2-HIGH", "QUARTERLY")
         .alias("billing_cycle"),
        F.col("opened").alias("account_opened_date"),
        F.when(closed, F.col("last")).alias("account_closed_date"),
        F.col("last").alias("last_modified"),
        F.when(closed, "CLOSED").otherwise("ACTIVE").alias("status"))


def assets(t: dict[str, DataFrame]) -> DataFrame:
    o = t["orders"]
    st = F.col("o_orderstatus")
    return o.select(
        F.concat(F.lit("METER"), _s("o_orderkey")).alias("asset_id"),
        _account_id("o_custkey", "o_orderpriority").alias("account_id"),
        F.concat(F.lit("SN-"), _s("o_orderkey")).alias("asset_serial_number"),
        F.when(st == "F", "ELECTRIC").when(st == "O", "GAS").otherwise("WATER")
         .alias("asset_type"),
        F.col("o_orderpriority").alias("manufacturer"),
        F.lit(None).cast("string").alias("model"),
        F.col("o_orderdate").alias("installation_date"),
        _null_ts().alias("last_calibration_date"),
        _null_ts().alias("next_calibration_date"),
        F.col("o_orderdate").alias("last_modified"),
        F.when(F.col("o_totalprice") < 50000, "INACTIVE").otherwise("ACTIVE").alias("status"))


def readings(t: dict[str, DataFrame]) -> DataFrame:
    li = t["lineitem"]
    rf = F.col("l_returnflag")
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("int").alias("id"),
        F.concat(F.lit("METER"), _s("l_orderkey")).alias("asset_id"),
        F.col("l_quantity").cast("decimal(15,3)").alias("reading_value"),
        F.col("l_shipdate").alias("interval_start"),
        add_days("l_shipdate", 1).alias("interval_end"),
        add_minutes("l_shipdate", F.col("l_linenumber")).alias("creation_time"),
        F.when(rf == "A", "DEMAND").otherwise("CONSUMPTION").alias("reading_type"),
        F.when(rf == "R", "L").otherwise("kWh").alias("unit_of_measure"),
        F.when(F.col("l_discount") > 0.08, "SUSPECT").otherwise("GOOD").alias("quality_code"),
        F.when(F.col("l_linestatus") == "O", "ESTIMATED").otherwise("VALID").alias("status"),
        F.when(rf == "N", F.lit(None).cast("string")).otherwise("METER_SYSTEM")
         .alias("source_system"))


def events_as_readings(t: dict[str, DataFrame]) -> DataFrame:
    """The ``events`` stream seen as meter readings (asset = user, ts = creation)."""
    e = t["events"]
    return e.select(
        F.col("event_id").cast("int").alias("id"),
        F.concat(F.lit("METER"), _s("user_id")).alias("asset_id"),
        F.col("value").cast("decimal(15,3)").alias("reading_value"),
        F.col("ts").alias("interval_start"),
        add_minutes("ts", 15).alias("interval_end"),
        F.col("ts").alias("creation_time"),
        F.upper(F.col("event_type")).alias("reading_type"),
        F.lit("kWh").alias("unit_of_measure"),
        F.when(F.col("value") < 0, "SUSPECT").otherwise("GOOD").alias("quality_code"),
        F.lit("VALID").alias("status"),
        F.lit("EVENT_STREAM").alias("source_system"))


@dataclass(frozen=True)
class Sources:
    customers: DataFrame
    customer_accounts: DataFrame
    assets: DataFrame
    readings: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return {"customers": self.customers, "customer_accounts": self.customer_accounts,
                "assets": self.assets, "readings": self.readings}


def sources(spark: SparkSession, sf_dir: str, changed: bool = False,
            batch: int | None = None) -> Sources:
    """The four source entities. ``batch=1`` keeps readings created before
    ``BATCH1_END``; ``changed`` applies the batch-2 customer status change."""
    t = read_tables(spark, sf_dir)
    r = readings(t)
    if batch == 1:
        r = r.filter(F.col("creation_time") < ntz_literal(BATCH1_END))
    return Sources(customers(t, changed=changed), customer_accounts(t), assets(t), r)


def history(spark: SparkSession, sf_dir: str) -> Sources:
    """The source entities with row versions of the dimensions: customers that became inactive, accounts that were open
    before they closed, and assets that ran before they were taken out."""
    t = read_tables(spark, sf_dir)
    c, moved = customers(t), customers(t, changed=True)
    was = c.select("installation_id", F.col("status").alias("was"))
    moved = (moved.join(was, "installation_id").filter(F.col("status") != F.col("was")).drop("was")
             .withColumn("last_modified", ntz_literal(CUSTOMERS_MOVED)))
    a = customer_accounts(t)
    opened = (a.filter((F.col("status") == "CLOSED") & (F.col("account_opened_date") < F.col("last_modified")))
              .withColumns({"status": F.lit("ACTIVE"), "account_closed_date": _null_ts(),
                            "last_modified": F.col("account_opened_date")}))
    s = assets(t)
    off = F.col("status") == "INACTIVE"
    ran = s.filter(off).withColumn("status", F.lit("ACTIVE"))
    s = s.withColumn("last_modified", F.when(off, add_days("installation_date", ASSET_RUNS_DAYS)).otherwise(F.col("last_modified")))
    return Sources(c.unionByName(moved), a.unionByName(opened), s.unionByName(ran), readings(t))
