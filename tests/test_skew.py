"""One asset holding a third of all readings: results stay exact, AQE splits it."""

import duckdb
import pytest
from pyspark.sql import functions as F

from vaultline.operators import business
from vaultline.operators.staging import seen_rows, stage_asset_span, stage_readings
from vaultline.operators.vault import (HUB_CUSTOMER, LINK_ACCOUNT_ASSET, VaultFrames, hub_rows,
                                       link_rows, measurement_rows)
from vaultline.sources import fixtures

from .conftest import SF_SMALL, rows

HOT = "METER1"
AQE_SKEW = {
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1024",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1024",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture()
def skew_conf(spark):
    before = {k: spark.conf.get(k, None) for k in AQE_SKEW}
    for k, v in AQE_SKEW.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def skewed_sources(spark, root=None):
    s = fixtures.sources(spark, SF_SMALL)
    # every third reading moves to one meter (by a hash, so all dates and types mix)
    hot = (F.abs(F.xxhash64("id", "creation_time")) % 3) == 0
    r = s.readings.withColumn("asset_id", F.when(hot, F.lit(HOT)).otherwise(F.col("asset_id")))
    if root is not None:
        # as a multi-file source: AQE splits a skewed partition at map-task
        # boundaries, so it needs more than the single task of a one-row-group file
        r.repartition(8).write.parquet(f"{root}/readings")
        r = spark.read.parquet(f"{root}/readings")
    return r, s


def test_hot_asset_results_are_exact_and_join_is_split(spark, skew_conf, tmp_root):
    r, s = skewed_sources(spark, tmp_root)
    n_hot = r.filter(F.col("asset_id") == HOT).count()
    assert n_hot * 4 > r.count()  # roughly a third on one key
    st = stage_readings(r, s.assets, s.customer_accounts, s.customers)
    meas = measurement_rows(st)
    # reference semantics computed independently in DuckDB from the same rows
    con = duckdb.connect()
    con.register("r", r.toPandas())
    con.register("a", s.assets.select("asset_id", "account_id").toPandas())
    con.register("ca", s.customer_accounts.select("account_id", "installation_id").toPandas())
    con.register("c", s.customers.select("installation_id").toPandas())
    expected_meas = con.execute("""SELECT count(*) FROM r JOIN a USING (asset_id)
        JOIN ca USING (account_id) JOIN c USING (installation_id)""").fetchone()[0]
    assert len(meas.collect()) == expected_meas
    plan = meas._jdf.queryExecution().executedPlan().toString()  # final adaptive plan
    assert "skew=true" in plan or "isSkewJoin=true" in plan, plan[:2000]

    first = seen_rows(stage_asset_span(r, s.assets, s.customer_accounts, s.customers), "first")
    assert rows(hub_rows(first, HUB_CUSTOMER)) == rows(hub_rows(st, HUB_CUSTOMER))
    assert rows(link_rows(first, LINK_ACCOUNT_ASSET)) == rows(link_rows(st, LINK_ACCOUNT_ASSET))
    exp_hub = con.execute("""SELECT installation_id, min(creation_time) FROM r
        JOIN a USING (asset_id) JOIN ca USING (account_id) JOIN c USING (installation_id)
        GROUP BY 1""").fetchall()
    got_hub = {(x.customer_hk, x.load_ts) for x in hub_rows(first, HUB_CUSTOMER).collect()}
    assert got_hub == {(k, t) for k, t in exp_hub}


def test_hot_asset_view_join(spark, skew_conf):
    r, s = skewed_sources(spark)
    st = stage_readings(r, s.assets, s.customer_accounts, s.customers)
    first = seen_rows(stage_asset_span(r, s.assets, s.customer_accounts, s.customers), "first")
    v = VaultFrames(*[None] * 9)
    v.hub_asset = hub_rows(first, HUB_CUSTOMER.__class__("hub_asset", "asset_hk", "asset_id"))
    v.sat_asset_measurements = measurement_rows(st)
    v.current_asset = seen_rows(stage_asset_span(r, s.assets, s.customer_accounts, s.customers),
                                "last").select("asset_hk", "load_ts", "asset_type",
                                               "asset_installation_date", "asset_status") \
        .groupBy("asset_hk").agg(F.max(F.struct("load_ts", "asset_type",
                                               "asset_installation_date",
                                               "asset_status")).alias("x")) \
        .select("asset_hk", "x.*")
    bv = business.asset_measurements(v)
    assert bv.count() == st.count()
    assert bv.filter(F.col("meter_id") == HOT).count() == st.filter(F.col("asset_id") == HOT).count()
