import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from vaultline.operators.staging import STAGED_COLUMNS, seen_rows, stage_asset_span, stage_readings
from vaultline.operators.vault import (HUB_ASSET, HUB_CUSTOMER, LINK_ACCOUNT_ASSET,
                                       SAT_ASSET_MEASUREMENTS, SAT_CUSTOMER_DETAILS,
                                       build_vault, hub_rows, link_rows, measurement_rows,
                                       merge_current, satellite_rows, upsert_rows)

from .conftest import SF_SMALL, rows

T = dt.datetime(2025, 10, 1)


def t(minutes):
    return T + dt.timedelta(minutes=minutes)


CUST = "installation_id string, customer_name string, customer_type string, address string, " \
       "city string, postal_code string, country string, registration_date timestamp_ntz, " \
       "last_modified timestamp_ntz, status string"
ACC = "account_id string, installation_id string, account_number string, account_type string, " \
      "billing_cycle string, account_opened_date timestamp_ntz, " \
      "account_closed_date timestamp_ntz, last_modified timestamp_ntz, status string"
ASSET = "asset_id string, account_id string, asset_serial_number string, asset_type string, " \
        "manufacturer string, model string, installation_date timestamp_ntz, " \
        "last_calibration_date timestamp_ntz, next_calibration_date timestamp_ntz, " \
        "last_modified timestamp_ntz, status string"
READ = "id int, asset_id string, reading_value decimal(15,3), interval_start timestamp_ntz, " \
       "interval_end timestamp_ntz, creation_time timestamp_ntz, reading_type string, " \
       "unit_of_measure string, quality_code string, status string, source_system string"


def sources(spark, status="ACTIVE"):
    c = spark.createDataFrame([
        ("I1", "Ann", "RESIDENTIAL", None, "X", None, "USA", T, T, status),
        ("I2", "Bob", "COMMERCIAL", "st", "Y", "1", "USA", T, T, "ACTIVE"),
        ("I3", "Cid", "INDUSTRIAL", None, "Z", None, "USA", T, T, "ACTIVE")], CUST)
    a = spark.createDataFrame([
        ("A1", "I1", "N1", "PREPAID", "MONTHLY", T, None, T, "ACTIVE"),
        ("A2", "I2", "N2", "POSTPAID", None, T, None, T, "CLOSED")], ACC)
    s = spark.createDataFrame([
        ("M1", "A1", "S1", "ELECTRIC", "m", None, T, None, None, T, "ACTIVE"),
        ("M2", "A2", "S2", "GAS", None, None, T, None, None, T, "INACTIVE"),
        ("M9", "A9", "S9", "WATER", None, None, T, None, None, T, "ACTIVE")], ASSET)
    r = spark.createDataFrame([
        (1, "M1", Decimal("1.5"), t(0), t(60), t(1), "CONSUMPTION", "kWh", "GOOD", "VALID", None),
        (2, "M1", Decimal("2.5"), t(60), t(120), t(2), "CONSUMPTION", "kWh", "GOOD", "VALID", "SYS"),
        (3, "M1", Decimal("2.5"), t(60), t(120), t(2), "DEMAND", "kWh", "GOOD", "VALID", "SYS"),
        (4, "M2", Decimal("9.0"), t(0), t(60), t(5), "CONSUMPTION", "m3", "SUSPECT", "ESTIMATED",
         None),
        (5, "M9", Decimal("1.0"), t(0), t(60), t(7), "CONSUMPTION", "L", "GOOD", "VALID", None),
        (6, "MX", Decimal("1.0"), t(0), t(60), t(8), "CONSUMPTION", "L", "GOOD", "VALID", None),
    ], READ)
    return r, s, a, c


@pytest.fixture()
def staged(spark):
    return stage_readings(*sources(spark))


def test_staging_drops_unmatched_and_keeps_columns(staged):
    assert staged.columns == STAGED_COLUMNS
    # M9's account does not exist, MX has no asset: both vanish
    assert sorted(r.reading_id for r in staged.collect()) == [1, 2, 3, 4]
    assert {r.record_source for r in staged.collect()} == {"METER_DATA_SYSTEM", "SYS"}


def test_md5_key_mode(spark):
    st = stage_readings(*sources(spark), key_mode="md5")
    r = st.filter("reading_id = 1").first()
    assert r.customer_hk != r.customer_id and len(r.customer_hk) == 32


def test_hub_first_seen_and_incremental(staged, spark):
    hub = hub_rows(staged, HUB_CUSTOMER)
    assert rows(hub) == [("I1", "I1", t(1), "METER_DATA_SYSTEM"),
                         ("I2", "I2", t(5), "METER_DATA_SYSTEM")]
    existing = hub.filter("customer_hk = 'I1'")
    assert [r.customer_hk for r in hub_rows(staged, HUB_CUSTOMER, existing).collect()] == ["I2"]


def test_load_twice_equals_load_once(staged):
    hub = hub_rows(staged, HUB_ASSET)
    assert hub_rows(staged, HUB_ASSET, existing=hub).count() == 0
    link = link_rows(staged, LINK_ACCOUNT_ASSET)
    assert link_rows(staged, LINK_ACCOUNT_ASSET, existing=link).count() == 0
    meas = measurement_rows(staged)
    assert measurement_rows(staged, existing=meas).count() == 0


def test_two_half_batches_equal_one_full_batch(staged):
    first = staged.filter(F.col("load_ts") < t(3))
    h1 = hub_rows(first, HUB_CUSTOMER)
    h2 = hub_rows(staged, HUB_CUSTOMER, existing=h1)
    assert rows(h1.unionByName(h2)) == rows(hub_rows(staged, HUB_CUSTOMER))


def test_satellite_first_load_keeps_every_row(staged):
    assert satellite_rows(staged, SAT_CUSTOMER_DETAILS).count() == 4


def test_satellite_incremental_inserts_changed_versions_only(spark, staged):
    first = satellite_rows(staged, SAT_CUSTOMER_DETAILS)
    unchanged = satellite_rows(staged, SAT_CUSTOMER_DETAILS, existing=first)
    assert unchanged.count() == 0
    changed = stage_readings(*sources(spark, status="INACTIVE"))
    new = satellite_rows(changed, SAT_CUSTOMER_DETAILS, existing=first)
    assert {r.customer_hk for r in new.collect()} == {"I1"}
    assert new.count() == 3  # every staged row of the changed customer


def test_satellite_compact_keeps_change_points(spark, staged):
    c = satellite_rows(staged, SAT_CUSTOMER_DETAILS, compact=True)
    assert sorted(r.customer_hk for r in c.collect()) == ["I1", "I2"]


def test_measurement_key_with_load_day_partition(staged):
    from vaultline.operators.vault import with_load_day
    existing = with_load_day(measurement_rows(staged).filter("reading_id <= 2"))
    new = measurement_rows(staged, existing=existing)
    assert sorted(r.reading_id for r in new.collect()) == [3, 4]


def test_upsert_replaces_matching_keys_and_dedups_source(spark):
    tgt = spark.createDataFrame([("k", t(1), "old"), ("k", t(2), "keep")],
                                "hk string, load_ts timestamp_ntz, v string")
    src = spark.createDataFrame([("k", t(1), "new1"), ("k", t(1), "new2"), ("j", t(3), "ins")],
                                "hk string, load_ts timestamp_ntz, v string")
    got = rows(upsert_rows(tgt, src, ["hk", "load_ts"]))
    assert got == [("j", t(3), "ins"), ("k", t(1), "new2"), ("k", t(2), "keep")]


def test_build_vault_has_nine_tables(staged):
    v = build_vault(staged).as_dict()
    assert len(v) == 9
    assert v[SAT_ASSET_MEASUREMENTS.name].count() == 4


def test_hub_plan_is_anti_join_without_python(staged):
    hub = hub_rows(staged, HUB_CUSTOMER, existing=hub_rows(staged, HUB_CUSTOMER))
    plan = hub._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan
    assert "Python" not in plan


def test_one_row_per_key_is_skew_safe(staged):
    """No window over the key (a hot key would be sorted in one task); the
    aggregate runs partially before the exchange, reducing a hot key per task."""
    for df in (hub_rows(staged, HUB_CUSTOMER), link_rows(staged, LINK_ACCOUNT_ASSET),
               satellite_rows(staged, SAT_CUSTOMER_DETAILS,
                              existing=satellite_rows(staged, SAT_CUSTOMER_DETAILS))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan
        assert "partial_" in plan


def test_asset_grain_rows_reach_their_hub_by_one_shuffle(spark):
    """The staging at asset grain has next to no repeats: collapsing them first would shuffle all its rows once more."""
    def shuffles(df):
        return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    r, s, a, c = sources(spark)
    first = seen_rows(stage_asset_span(r, s, a, c), "first")
    assert shuffles(hub_rows(first, HUB_CUSTOMER, reduced=True)) == shuffles(hub_rows(first, HUB_CUSTOMER)) - 1
    assert shuffles(link_rows(first, LINK_ACCOUNT_ASSET, reduced=True)) == shuffles(link_rows(first, LINK_ACCOUNT_ASSET)) - 1
    twice = first.unionByName(first).unionByName(first.withColumn("load_ts", F.lit(None).cast("timestamp_ntz")))
    for df in (first, twice):
        assert rows(hub_rows(df, HUB_CUSTOMER, reduced=True)) == rows(hub_rows(df, HUB_CUSTOMER))
        assert rows(link_rows(df, LINK_ACCOUNT_ASSET, reduced=True)) == rows(link_rows(df, LINK_ACCOUNT_ASSET))


def test_the_hierarchy_takes_its_keys_from_asset_grain_by_one_shuffle_each(spark):
    from vaultline.operators import business
    from vaultline.plans.catalog import LazyVault
    v = LazyVault(spark, SF_SMALL)
    plan = business.customer_asset_hierarchy(v)._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if "Exchange hashpartitioning(customer_hk" in x and "record_source" in x]


def test_merging_current_versions_collapses_repeats_before_it_sorts(spark):
    rows_ = spark.createDataFrame([("a", T, "x"), ("a", t(1), "x"), ("a", t(1), "y"), ("b", None, "z")],
                                  "customer_hk string, load_ts timestamp_ntz, customer_hashdiff string")
    merged = merge_current(None, rows_, SAT_CUSTOMER_DETAILS)
    assert rows(merged) == rows(spark.createDataFrame([("a", t(1), "y"), ("b", None, "z")], rows_.schema))
    assert "max(load_ts" in merged._jdf.queryExecution().executedPlan().toString()


def test_staging_shuffles_intervals_as_spans_and_gives_every_value_back(spark):
    _, s, a, c = sources(spark)
    some = [None, t(0), dt.datetime(1, 1, 1), dt.datetime(9999, 12, 31, 23, 59, 59, 999999), dt.datetime(2025, 3, 30, 2, 30, 0, 1)]
    times = [(x, y, z) for x in some for y in some for z in some]
    r = spark.createDataFrame([(i, "M1", None, *xyz, "T", "kWh", "GOOD", "VALID", None) for i, xyz in enumerate(times)], READ)
    st = stage_readings(r, s, a, c)
    got = {x.reading_id: (x.interval_start, x.interval_end, x.load_ts) for x in st.collect()}
    assert got == dict(enumerate(times))
    assert dict(st.dtypes)["interval_start"] == dict(st.dtypes)["interval_end"] == "timestamp_ntz"
    met = st.select("asset_id", "interval_end")._jdf.queryExecution().optimizedPlan().toString().split("Join Inner")
    # the fact has its spans where it is shuffled, and accounts have met their customers before the assets meet them
    assert " - coalesce(interval_start" in met[1]
    assert "account_id" in met[2].split("\n")[0] and "installation_id" in met[3].split("\n")[0]
    # columns of other types are staged as they are
    other = r.withColumn("interval_end", F.to_date("interval_end"))
    assert rows(stage_readings(other, s, a, c).select("reading_id", "interval_start", "interval_end")) == \
        rows(other.select("id", "interval_start", "interval_end"))
