"""State that is kept up to date batch by batch: view folds, check counts, key filters, bucketed targets."""

import datetime as dt
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from vaultline.operators import business, quality
from vaultline.operators.sketch import Sketch, possible
from vaultline.operators.staging import seen_rows, stage_asset_span, stage_readings, stage_readings_only
from vaultline.operators.vault import (HUB_CUSTOMER, HUBS, LINKS, LOAD_TS, SAT_ASSET_MEASUREMENTS, hub_rows, link_rows,
                                       measurement_rows, with_load_day)
from vaultline.plans import build as builds
from vaultline.plans import folds, measurements
from vaultline.plans.build import _day_ranges, read_vault, run_build, table_path
from vaultline.plans.check_state import CheckState, new_repeats
from vaultline.plans.sinks import append
from vaultline.plans.targets import CatalogTarget
from vaultline.session import delete_path
from vaultline.sources import fixtures

from .conftest import SF_SMALL, rows

BUILD = {"run_checks": True, "raise_on_check_failure": False}


@pytest.fixture(scope="module")
def deliveries(spark, tmp_path_factory):
    """The first delivery and all, with load times drawn together so that they fall on few days."""
    out = []
    for batch in (1, None):
        s = fixtures.sources(spark, SF_SMALL, batch=batch)
        day = F.date_trunc("YEAR", F.col("creation_time")).cast("timestamp_ntz")
        path = str(tmp_path_factory.mktemp("readings"))
        s.readings.withColumn("creation_time", F.timestamp_add("MINUTE", F.col("id") % 1440, day)).write.mode("overwrite").parquet(path)
        out.append(replace(s, readings=spark.read.parquet(path)))
    return out


# -- folds -------------------------------------------------------------------------

def test_folds_of_batches_equal_a_full_recompute_and_read_each_batch_once(spark, tmp_root):
    first, whole = fixtures.sources(spark, SF_SMALL, batch=1), fixtures.sources(spark, SF_SMALL)
    second = whole.readings.filter(F.col("creation_time") >= F.to_timestamp_ntz(F.lit(fixtures.BATCH1_END)))
    f = folds.meter_reads()
    assert folds.folded(spark, tmp_root, f) is None
    assert folds.fold(spark, tmp_root, f, first.readings, 1) > 0
    assert folds.fold(spark, tmp_root, f, second, 2) > 0
    assert folds.fold(spark, tmp_root, f, second, 2) == 0  # a batch that is run again
    state = folds.folded(spark, tmp_root, f)
    expected = whole.readings.groupBy("asset_id").agg(F.max("interval_end").alias("last_read"), F.count(F.lit(1)).alias("readings"))
    assert rows(state) == rows(expected)
    got = business.meters(whole.assets, whole.customer_accounts, last=state)
    assert rows(got) == rows(business.meters(whole.assets, whole.customer_accounts, whole.readings))
    assert folds.fold(spark, tmp_root, f, second.limit(0), 3) == 0


def test_an_interrupted_fold_is_finished_and_counted_once(spark, tmp_root, monkeypatch):
    rows_ = spark.createDataFrame([(f"k{i % 40}", i) for i in range(400)], "k string, v long")
    f = folds.Fold("sums", ("k",), {"n": ("count", F.col("v") % 2 == 0), "s": ("sum", F.col("v")), "lo": ("min", F.col("v"))})
    folds.fold(spark, tmp_root, f, rows_, 1)
    from vaultline.plans import sinks
    real = sinks._replace

    def dying(*a):
        raise RuntimeError("died before the replacement")
    monkeypatch.setattr(sinks, "_replace", dying)
    with pytest.raises(RuntimeError):
        folds.fold(spark, tmp_root, f, rows_, 2)
    monkeypatch.setattr(sinks, "_replace", real)
    assert folds.fold(spark, tmp_root, f, rows_, 2) == 0  # the read finished it
    twice = rows_.unionByName(rows_).groupBy("k").agg(F.count_if(F.col("v") % 2 == 0), F.sum("v"), F.min("v"))
    assert rows(folds.folded(spark, tmp_root, f)) == rows(twice)


# -- checks ------------------------------------------------------------------------

def test_checks_of_a_second_build_add_up_without_reading_the_vault(spark, tmp_root, deliveries, monkeypatch):
    first, whole = deliveries
    root = f"{tmp_root}/vault"
    run_build(spark, first, root, **BUILD)
    scans = []
    real = quality.run_checks
    monkeypatch.setattr(builds.quality, "run_checks", lambda *a, **k: scans.append(a) or real(*a, **k))
    got = run_build(spark, whole, root, **BUILD)
    assert not scans
    assert rows(got.checks) == rows(real(read_vault(spark, root).as_dict()))
    # a planted fault: NULLs and a repeated key in a delivery that a load wrote without counting
    hub = spark.read.parquet(table_path(root, "hub_customer"))
    bad = hub.limit(3).withColumn("record_source", F.lit(None).cast("string"))
    append(bad, table_path(root, "hub_customer"))
    CheckState(spark, f"{root}/_check_state").mark(["hub_customer"], builds.new_load_id())
    got = run_build(spark, whole, root, **BUILD)
    assert len(scans) == 1 and set(scans[0][1]) == {"hub_customer"}  # the marked table alone is read
    full = rows(real(read_vault(spark, root).as_dict()))
    assert rows(got.checks) == full
    assert {(r[1], r[2]): r[3] for r in full if r[0] == "hub_customer" and r[3]} == {("record_source", "not_null"): 3, ("customer_hk", "unique"): 3}
    got = run_build(spark, whole, root, **BUILD)
    assert len(scans) == 1 and rows(got.checks) == full


def test_a_build_that_died_leaves_its_tables_to_a_full_check(spark, tmp_root, deliveries, monkeypatch):
    first, whole = deliveries
    root = f"{tmp_root}/vault"
    run_build(spark, first, root, **BUILD)
    real = builds._load_satellite
    monkeypatch.setattr(builds, "_load_satellite", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
    with pytest.raises(RuntimeError):
        run_build(spark, whole, root, **BUILD)
    monkeypatch.setattr(builds, "_load_satellite", real)
    assert CheckState(spark, f"{root}/_check_state").known() == {}
    got = run_build(spark, whole, root, **BUILD)
    assert rows(got.checks) == rows(quality.run_checks(read_vault(spark, root).as_dict()))


def test_a_build_stages_once_and_releases_its_shuffles(spark, tmp_root, deliveries, monkeypatch):
    """Hubs and links come from the staging that is stored already, and shuffle files go with the query that made them."""
    from vaultline.operators import staging
    from vaultline.session import RELEASE
    joined, seen, real, run = [], [], staging.keyed_dimensions, builds._run_build
    monkeypatch.setattr(staging, "keyed_dimensions", lambda *a, **kw: joined.append(a) or real(*a, **kw))
    monkeypatch.setattr(builds, "_run_build", lambda *a: seen.append(spark.conf.get(RELEASE)) or run(*a))
    before = spark.conf.get(RELEASE)
    run_build(spark, deliveries[0], f"{tmp_root}/v", **BUILD)
    assert len(joined) == 1 and seen == ["true"] and spark.conf.get(RELEASE) == before
    s = deliveries[0]
    first = seen_rows(stage_asset_span(s.readings, s.assets, s.customer_accounts, s.customers), "first")
    for b in (*HUBS, *LINKS):
        made = hub_rows(first, b) if b in HUBS else link_rows(first, b)
        assert rows(spark.read.parquet(f"{tmp_root}/v/{b.name}")) == rows(made)


def test_released_shuffles_leave_no_files(spark):
    import time

    from vaultline.session import released_shuffles

    def files():
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}
    before = files()
    with released_shuffles(spark):
        df = spark.range(5000).withColumn("k", F.col("id") % 97).groupBy("k").count()
        assert sum(r["count"] for r in df.collect()) == 5000
        end = time.time() + 20
        while files() - before and time.time() < end:
            time.sleep(0.2)
    assert not files() - before


def test_new_repeats_count_each_key_once(spark):
    def keys(*k):
        return spark.createDataFrame([(x,) for x in k], "k string")
    stored = keys("a", "b", "b", "c", None)
    assert new_repeats(keys("a", "b", "d", "d", "e", None, None), stored, "k").first()[0] == 2  # a and d; b is one already
    assert new_repeats(keys("x", "x", "y"), None, "k").first()[0] == 1
    assert new_repeats(keys(), stored, "k").first()[0] == 0


def test_check_state_compaction_keeps_the_sums(spark, tmp_root):
    st = CheckState(spark, f"{tmp_root}/state")
    st.most_files = 6
    for load in range(1, 9):
        st.mark(["t", "u"], load)
        st.add(load, {"t": {("c", "not_null"): 1, ("k", "unique"): 2}}, ["t"] if load == 3 else [])
    assert len(st._files()) <= 7
    assert st.known() == {"t": {("c", "not_null"): 6, ("k", "unique"): 12}}
    st.compact()
    assert st.known() == {"t": {("c", "not_null"): 6, ("k", "unique"): 12}}


# -- days of a batch ---------------------------------------------------------------

def test_day_ranges_join_neighbours_and_stay_few():
    d = dt.date(2024, 1, 1)
    days = [d + dt.timedelta(days=x) for x in (0, 1, 2, 10, 11, 300, 900)]
    assert _day_ranges(days) == [(days[0], days[2]), (days[3], days[4]), (days[5], days[5]), (days[6], days[6])]
    assert _day_ranges(days, 2) == [(days[0], days[5]), (days[6], days[6])]
    assert _day_ranges([]) == []


def test_a_late_version_reads_its_own_day_only(spark, tmp_root, deliveries):
    from vaultline.operators.vault import SAT_CUSTOMER_DETAILS
    first, _ = deliveries
    stored = measurement_rows(stage_readings_only(first.readings))
    assert stored is not None
    sat = stage_readings(first.readings, first.assets, first.customer_accounts, first.customers)
    stored_sat = sat.select(*SAT_CUSTOMER_DETAILS.columns)
    stored_sat.write.parquet(f"{tmp_root}/sat")
    stored_sat = spark.read.parquet(f"{tmp_root}/sat")
    ends = stored_sat.agg(F.min(LOAD_TS), F.max(LOAD_TS)).first()
    batch = stored_sat.filter(F.col(LOAD_TS).isin([ends[0], ends[1]]))
    out = builds._unstored(batch, stored_sat, SAT_CUSTOMER_DETAILS)
    assert out.count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(And(" in plan


# -- key filter --------------------------------------------------------------------

def test_filter_never_misses_a_key_and_rarely_errs(spark):
    rng = random.Random(1)
    s = Sketch(("k", "n"), ("d",), blocks=60)  # 25 keys a block
    data = [(d, f"k{i}", i % 5 or None) for d in ("x", "y") for i in range(1500)]
    held = spark.createDataFrame(data, "d string, k string, n int")
    one, two = held.filter("k < 'k5'"), held.filter("k >= 'k5'")
    whole = s.build(held)
    assert rows(s.merge(s.build(one), s.build(two))) == rows(whole)
    other = spark.createDataFrame([(rng.choice("xyz"), f"new{i}", 1) for i in range(6000)], "d string, k string, n int")
    new, maybe = possible(held.unionByName(other), s, whole)
    assert maybe.join(held, ["d", "k"], "left_semi").count() == len(data)
    errors = maybe.filter("k LIKE 'new%'").count()
    assert new.count() + maybe.count() == len(data) + 6000
    assert errors < 6000 * 0.05 and maybe.filter("d = 'z'").isEmpty()
    assert "Python" not in maybe._jdf.queryExecution().executedPlan().toString()


def test_new_readings_are_loaded_without_a_look_at_the_table(spark, tmp_root, deliveries, monkeypatch):
    path = f"{tmp_root}/sat_asset_measurements"
    first, whole = deliveries
    a, b = stage_readings_only(first.readings), stage_readings_only(whole.readings)
    measurements.load(spark, a, path, use_sketch=True)
    # readings of days that are stored already, with new keys
    again = a.withColumn("reading_type", F.lit("NEW"))
    read = []
    real = measurements.measurement_rows

    def spy(staged, m=SAT_ASSET_MEASUREMENTS, existing=None, prune_days=False):
        out = real(staged, m, existing, prune_days=prune_days)
        if existing is not None:
            read.append(staged.count())
        return out
    monkeypatch.setattr(measurements, "measurement_rows", spy)
    n = again.count()
    measurements.load(spark, again, path, use_sketch=True)
    assert read[-1] < n / 50
    measurements.load(spark, b, path, use_sketch=True)
    measurements.load(spark, b, path, use_sketch=True)
    got = spark.read.parquet(path).select(*SAT_ASSET_MEASUREMENTS.columns)
    expected = real(b).unionByName(real(again)).select(*SAT_ASSET_MEASUREMENTS.columns)
    assert rows(got) == rows(expected)
    # a lost filter is built from the table
    delete_path(spark, measurements.filter_path(path))
    measurements.load(spark, b, path, use_sketch=True)
    assert spark.read.parquet(path).count() == expected.count()


def test_the_filter_is_read_for_the_months_of_the_batch(spark, tmp_root, deliveries, monkeypatch):
    path = f"{tmp_root}/sat_asset_measurements"
    staged = stage_readings_only(deliveries[1].readings)
    measurements.load(spark, staged, path, use_sketch=True)
    month = F.trunc(F.to_date(LOAD_TS), "month")
    some = rows(staged.select(month).distinct())[0][0]
    batch = staged.filter(month == F.lit(some)).withColumn("reading_type", F.lit("NEW"))
    asked = []
    real = Sketch.probe

    def spy(sketch, batch_rows, filters, name="maybe"):
        asked.append(filters)
        return real(sketch, batch_rows, filters, name)
    monkeypatch.setattr(Sketch, "probe", spy)
    scratch = f"{tmp_root}/scratch"
    out = measurements.unseen(spark, batch, path, scratch)
    assert out.count() == batch.count()
    plan = asked[0]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load_month" in plan or "PartitionFilters: [load_month" in plan
    assert {r[0] for r in asked[0].select(F.trunc("load_day", "month")).distinct().collect()} == {some}
    # the batch's own plan has run: what is left reads its stored answers, and the table
    files = {f.split("/scratch/")[-1].split("/")[0] for f in out.inputFiles() if "/scratch/" in f}
    assert files == {"asked"} and all("/scratch/" in f or "/sat_asset_measurements/" in f for f in out.inputFiles())


def test_every_writer_teaches_the_filter(spark, tmp_root, deliveries):
    path = f"{tmp_root}/sat_asset_measurements"
    _, whole = deliveries
    staged = stage_readings_only(whole.readings)
    part = F.col("reading_id") % 3
    measurements.load(spark, staged.filter(part == 0), path, use_sketch=True)
    measurements.load(spark, staged.filter(part == 1), path)  # a load that does not ask the filter
    measurements.load(spark, staged, path, use_sketch=True)
    assert spark.read.parquet(path).count() == staged.count()


def test_a_load_adds_to_the_filter_and_asks_it_for_days_that_it_has(spark, tmp_root, monkeypatch):
    path = f"{tmp_root}/sat_asset_measurements"
    start = dt.datetime(2024, 1, 1)

    def batch(days, ids):
        rows_ = [(f"A{i}", i, start, start, "T", "kWh", "GOOD", "VALID", None if d is None else start + dt.timedelta(days=d), "S")
                 for d in days for i in ids]
        return spark.createDataFrame(rows_, "asset_hk string, reading_id int, interval_start timestamp_ntz, interval_end timestamp_ntz, "
                                     "reading_type string, unit_of_measure string, quality_code string, reading_status string, "
                                     "load_ts timestamp_ntz, record_source string").withColumn("reading_value", F.lit(1).cast("decimal(15,3)"))
    asked, compared = [], []
    real, real_rows = Sketch.probe, measurements.measurement_rows

    def probe(sketch, batch_rows, filters, name="maybe"):
        asked.append({r[0] and r[0].day for r in batch_rows.select("load_day").distinct().collect()})
        return real(sketch, batch_rows, filters, name)

    def compare(staged, m=SAT_ASSET_MEASUREMENTS, existing=None, prune_days=False):
        if existing is not None:
            compared.append({r[0] and r[0].day for r in staged.select("load_day").distinct().collect()})
        return real_rows(staged, m, existing, prune_days=prune_days)
    monkeypatch.setattr(Sketch, "probe", probe)
    monkeypatch.setattr(measurements, "measurement_rows", compare)
    measurements.load(spark, batch([0, 1], range(20)), path, use_sketch=True)
    before = set(spark.read.parquet(measurements.filter_path(path)).inputFiles())
    # day 0 has new keys alone, day 1 both kinds, day 2 is new
    one = batch([0], range(50, 60)).unionByName(batch([1], range(10, 30))).unionByName(batch([2], range(5)))
    measurements.load(spark, one, path, use_sketch=True)
    assert before < set(spark.read.parquet(measurements.filter_path(path)).inputFiles())  # nothing was written again
    assert asked == [{1, 2}] and compared == [{2}]
    assert spark.read.parquet(path).count() == 40 + 10 + 10 + 5
    # keys of either load are known; rows without a time meet nothing, as in a load without a filter
    both = batch([0, 1], range(60)).unionByName(batch([2, None], range(5)))
    for _ in range(2):
        n = spark.read.parquet(path).count()
        expected = real_rows(both, existing=spark.read.parquet(path), prune_days=True).count()
        measurements.load(spark, both, path, use_sketch=True)
        assert spark.read.parquet(path).count() == n + expected
    plan = measurements.SKETCH.build(with_load_day(both), ("m", F.trunc("load_day", "month")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    asking = real(measurements.SKETCH, with_load_day(both), measurements.SKETCH.build(with_load_day(one))).filter("maybe").select("load_day")
    exchanged = asking._jdf.queryExecution().optimizedPlan().toString().split("Join")[1]
    assert "reading_value" not in exchanged.split("LogicalRDD")[0] and "__w0" not in exchanged


def test_a_repeated_load_asks_a_slice_compares_keys_and_looks_up_new_rows_alone(spark, tmp_root, monkeypatch):
    path = f"{tmp_root}/sat_asset_measurements"
    start = dt.datetime(2024, 1, 1)

    def batch(days, ids, kind="T", value=1):
        rows_ = [(f"A{i}", i, None if i == 7 else start, start, kind, "kWh", "GOOD", "VALID", start + dt.timedelta(days=d), "S")
                 for d in days for i in ids]
        return spark.createDataFrame(rows_, "asset_hk string, reading_id int, interval_start timestamp_ntz, interval_end timestamp_ntz, "
                                     "reading_type string, unit_of_measure string, quality_code string, reading_status string, "
                                     "load_ts timestamp_ntz, record_source string").withColumn("reading_value", F.lit(value).cast("decimal(15,3)"))
    asked, compared = [], []
    real, real_rows = Sketch.probe, measurements.measurement_rows

    def probe(sketch, batch_rows, filters, name="maybe"):
        asked.append({r[0].day for r in batch_rows.select("load_day").distinct().collect()})
        return real(sketch, batch_rows, filters, name)

    def compare(staged, m=SAT_ASSET_MEASUREMENTS, existing=None, prune_days=False):
        out = real_rows(staged, m, existing, prune_days=prune_days)
        if existing is not None:
            compared.append(out)
        return out
    monkeypatch.setattr(Sketch, "probe", probe)
    monkeypatch.setattr(measurements, "measurement_rows", compare)
    stored = batch([0, 1, 2], range(10, 1500))
    measurements.load(spark, stored, path, use_sketch=True)
    # days 0 and 1 come again; day 1 has new keys as well, one twice with other values, and one with a NULL; day 3 is new
    more = [batch([1], range(1500, 1503)), batch([1], [1500], value=2), batch([1], [7]), batch([3], range(5))]
    second = batch([0, 1], range(10, 1500))
    for b in more:
        second = second.unionByName(b)
    expected = real_rows(second, existing=spark.read.parquet(path), prune_days=True)
    want = rows(expected.unionByName(stored.select(*expected.columns)))
    out = measurements.unseen(spark, second, path, f"{tmp_root}/scratch")
    assert rows(out.select(*expected.columns)) == rows(expected) and out.count() == 3 + 1 + 1 + 5
    assert asked == []  # no day was left to ask in full
    assert all("/scratch/" in f for f in out.inputFiles())
    assert sorted(spark.read.parquet(f"{tmp_root}/scratch/keys").columns) == sorted({"load_day", *SAT_ASSET_MEASUREMENTS.key})
    assert {r[0].day for r in spark.read.parquet(f"{tmp_root}/scratch/rows").select(F.to_date("load_ts")).distinct().collect()} == {2}
    measurements.load(spark, second, path, use_sketch=True)
    assert rows(spark.read.parquet(path).select(*expected.columns)) == want
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = compared[0].select(*SAT_ASSET_MEASUREMENTS.key)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "reading_value" not in plan.split("Relation")[0]
    # keys outside the slice are still found: a day with few stored keys is asked in full
    for i in range(1490, 1500):
        n = spark.read.parquet(path).count()
        measurements.load(spark, batch([2], [i]), path, use_sketch=True)
        assert spark.read.parquet(path).count() == n
    assert {3} in asked


# -- targets -----------------------------------------------------------------------

def test_bucketed_target_is_met_where_it_lies(spark, deliveries):
    first, whole = deliveries
    t = CatalogTarget(spark, "vault_buckets_" + str(random.randrange(10 ** 9)), buckets=16)

    def hub(s, existing=None):
        staged = seen_rows(stage_asset_span(s.readings, s.assets, s.customer_accounts, s.customers), "first")
        return hub_rows(staged, HUB_CUSTOMER, existing)
    assert t.read("hub_customer") is None
    t.append(hub(first), "hub_customer")
    new = hub(whole, t.read("hub_customer"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = new._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    anti = plan[plan.index("LeftAnti"):]
    stored_side = anti[anti.rindex("FileScan") - 400:]
    assert "Bucketed: true" in stored_side and "SelectedBucketsCount: 16 out of 16" in stored_side
    assert "Exchange" not in anti[anti.rindex("Filter isnotnull(customer_hk"):]
    t.append(new, "hub_customer")
    assert rows(t.read("hub_customer")) == rows(hub(first).unionByName(hub(whole, hub(first))))


def test_build_into_a_catalog_equals_the_build_into_folders(spark, tmp_root, deliveries):
    first, whole = deliveries
    name = "vault_catalog_" + str(random.randrange(10 ** 9))
    for s in (first, whole):
        a = run_build(spark, s, f"{tmp_root}/folders", **BUILD)
        b = run_build(spark, s, f"{tmp_root}/state", catalog=name, buckets=4, **BUILD)
        assert a.appended == b.appended and rows(a.checks) == rows(b.checks)
    one, two = read_vault(spark, f"{tmp_root}/folders").as_dict(), read_vault(spark, "", CatalogTarget(spark, name)).as_dict()
    for n in one:
        assert rows(one[n].select(*sorted(one[n].columns))) == rows(two[n].select(*sorted(two[n].columns))), n
    with pytest.raises(ValueError):
        run_build(spark, whole, f"{tmp_root}/state", catalog=name, key_sketch=True)


def test_build_with_a_key_filter_equals_the_build_without(spark, tmp_root, deliveries):
    first, whole = deliveries
    for s in (first, whole):
        a = run_build(spark, s, f"{tmp_root}/plain", **BUILD)
        b = run_build(spark, s, f"{tmp_root}/sketch", key_sketch=True, **BUILD)
        assert a.appended == b.appended and rows(a.checks) == rows(b.checks)
