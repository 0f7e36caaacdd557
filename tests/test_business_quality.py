import datetime as dt

from pyspark.sql import functions as F

from vaultline.operators import business, quality, reports
from vaultline.operators.references import REFERENCE_ROWS, reference_codes, reference_table
from vaultline.operators.staging import stage_readings
from vaultline.operators.vault import build_vault

from .conftest import rows
from .test_vault import T, sources, t


def vault(spark):
    return build_vault(stage_readings(*sources(spark)))


def test_hierarchy_and_asset_details(spark):
    v = vault(spark)
    h = business.customer_asset_hierarchy(v)
    assert rows(h.select("installation_id", "account_meter_id", "asset_meter_id", "meter_status")) \
        == [("I1", "A1", "M1", "ACTIVE"), ("I2", "A2", "M2", "INACTIVE")]
    d = business.asset_details(v)
    assert d.count() == 2 and d.filter("detail_load_ts is null").count() == 0


def test_customer_accounts_and_measurements(spark):
    v = vault(spark)
    ca = business.customer_accounts(v)
    assert rows(ca.select("installation_id", "meter_id")) == [("I1", "A1"), ("I2", "A2")]
    m = business.asset_measurements(v)
    assert m.count() == 4 and set(m.columns) >= {"meter_id", "meter_type", "measurement_load_ts"}


def test_meters_legacy_keeps_assets_without_readings(spark):
    r, s, a, c = sources(spark)
    m = business.meters(s, a, r)
    got = {x.meter_id: (x.installation_id, x.last_read_date) for x in m.collect()}
    assert got["M9"] == (None, T + dt.timedelta(minutes=60))
    assert got["M1"] == ("I1", T + dt.timedelta(minutes=120))


def test_as_of(spark):
    v = vault(spark)
    past = business.as_of(v.sat_asset_measurements, t(2))
    assert past.count() == 3
    latest = business.as_of(v.sat_customer_details, t(2), keys=["customer_hk"])
    assert latest.count() == 1


def test_reports(spark):
    v = vault(spark)
    counts = {r.entity: r.record_count for r in reports.hub_counts(v).collect()}
    assert counts == {"Customers": 2, "Accounts": 2, "Assets": 2}
    q = reports.quality_counts(v.sat_asset_measurements).collect()
    assert q[0].reading_count == 3
    recent = reports.recent_measurements(business.asset_measurements(v))
    assert recent.count() == 4
    active = reports.active_hierarchy(business.customer_asset_hierarchy(v),
                                      business.current_customer(v))
    assert [r.customer_name for r in active.collect()] == ["Ann"]


def test_reference_tables(spark):
    for name, (code, label, rows_) in REFERENCE_ROWS.items():
        df = reference_table(spark, name, "2025-01-01 00:00:00")
        assert df.columns == [code, label, "description", "load_ts", "record_source"]
        assert df.count() == len(rows_)
    assert reference_codes(spark, "ref_status").count() == 4


def test_planted_faults_are_caught(spark):
    df = spark.createDataFrame(
        [("k1", "A", "GOOD"), ("k1", "B", "GOOD"), (None, "C", "BAD"), ("k2", None, "SUSPECT"),
         ("k3", "D", None)], "hk string, bk string, code string")
    nn = {r.column_name: r.failures for r in quality.not_null(df, "t", ["hk", "bk"]).collect()}
    assert nn == {"hk": 1, "bk": 1}
    assert quality.unique(df, "t", "hk").first().failures == 1
    parent = spark.createDataFrame([("A",), ("B",)], "bk string")
    assert quality.orphans(df, "t", "bk", parent, "bk").first().failures == 2
    codes = [r[0] for r in REFERENCE_ROWS["ref_quality_code"][2]]
    dom = quality.accepted_values(df, "t", {"code": codes}).first()
    assert dom.failures == 1 and dom.passed is False


def test_run_checks_on_clean_vault_pass(spark):
    res = quality.run_checks(vault(spark).as_dict())
    assert res.count() == 44
    assert res.filter(~F.col("passed")).count() == 0
    quality.raise_on_failure(res)


def test_one_pass_checks_equal_separate_checks(spark):
    df = spark.createDataFrame(
        [("k1", "A", None), ("k1", "B", "x"), (None, "C", "y"), (None, None, "z"), ("k2", "D", "w"),
         ("k3", "E", None), ("k3", "E", None), ("k3", "F", "v")], "hk string, bk string, v string")
    sep = quality.not_null(df, "t", ["hk", "bk", "v"]).unionByName(quality.unique(df, "t", "hk"))
    one = quality.not_null_and_unique(df, "t", ["hk", "bk", "v"], "hk")
    assert rows(one) == rows(sep)
    empty = df.limit(0)
    assert {r.failures for r in quality.not_null_and_unique(empty, "t", ["hk", "v"], "hk")
            .collect()} == {0}


def test_source_checks_report_declared_integrity(spark):
    from vaultline.sources import fixtures
    from .conftest import SF_SMALL
    src = fixtures.sources(spark, SF_SMALL).as_dict()
    res = {(r.table_name, r.column_name, r.test): r.failures
           for r in quality.source_checks(src).collect()}
    assert res[("customers", "installation_id", "unique")] == 0
    assert res[("readings", "asset_id", "relationships")] == 0
    assert res[("customer_accounts", "status", "accepted_values")] > 0  # CLOSED is not coded
    assert res[("readings", "id", "unique")] > 0  # the mapped reading id repeats
