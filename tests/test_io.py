import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultline.plans.build import read_vault, register_views, run_build, table_path
from vaultline.plans.ingest import (ingest, ingest_all, plan_ingest, register_new_files)
from vaultline.plans.sinks import append, path_exists, upsert
from vaultline.sources import fixtures
from vaultline.sources.readers import extract, read_source, source_frame
from vaultline.sources.schema import (FieldDef, TableDef, meter_tables, parse_tables, to_config,
                                      to_struct)
from vaultline.sources.state import WatermarkStore

from .conftest import SF_SMALL, rows


def test_parse_config_layout_and_defaults():
    cfg = to_config(meter_tables().values())
    tables = parse_tables(json.dumps(cfg))
    assert [t.name for t in tables] == ["customers", "customer_accounts", "assets", "readings"]
    r = tables[3]
    assert r.is_incremental and r.incremental_field == "creation_time"
    assert to_struct(r)["reading_value"].dataType == T.DecimalType(15, 3)
    assert to_struct(r)["creation_time"].dataType == T.TimestampNTZType()


def test_decimal_scale_zero_is_kept_and_unknown_type_rejected():
    assert FieldDef("x", "decimal", precision=10, scale=0).spark_type() == T.DecimalType(10, 0)
    assert FieldDef("x", "decimal").spark_type() == T.DecimalType(15, 3)
    with pytest.raises(ValueError):
        FieldDef("x", "varchar")
    with pytest.raises(ValueError):
        parse_tables({"tables": [{"name": "t", "is_incremental": True,
                                  "fields": [{"name": "a", "type": "string"}]}]})


def test_extract_casts_and_fills_defaults_for_absent_columns(spark):
    t = meter_tables()["readings"]
    df = spark.createDataFrame([(1, "M1", None)], "id long, asset_id string, status string")
    out = extract(df, t)
    assert out.columns == t.names
    r = out.first()
    assert r.status is None            # explicit NULL stays NULL
    assert r.source_system == "METER_SYSTEM"   # absent column takes its default
    assert dict(out.dtypes)["id"] == "int"


def test_file_readers_use_declared_schema(spark, tmp_root):
    t = TableDef("x", (FieldDef("a", "integer"), FieldDef("b", "string")))
    df = spark.createDataFrame([(1, "p"), (2, "q")], "a int, b string")
    df.write.csv(f"{tmp_root}/csv", header=True)
    df.write.json(f"{tmp_root}/json")
    for kind in ("csv", "json"):
        got = read_source(spark, kind, {"path": f"{tmp_root}/{kind}"}, to_struct(t))
        assert rows(got) == [(1, "p"), (2, "q")]
    spark.createDataFrame([(1, "p")], "a int, b string").createOrReplaceTempView("src_view")
    q = TableDef("x", t.fields, source_query="select a, b from src_view")
    assert rows(source_frame(spark, q, "table", {})) == [(1, "p")]


def test_jdbc_partitioned_read_from_embedded_database(spark):
    url = "jdbc:derby:memory:vaultline_test;create=true"
    driver = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    try:
        df = spark.range(1, 101).select(F.col("id").cast("int").alias("ID"),
                                        F.concat(F.lit("M"), F.col("id").cast("string"))
                                        .alias("ASSET_ID"))
        df.write.format("jdbc").options(url=url, driver=driver, dbtable="READINGS") \
            .mode("overwrite").save()
    except Exception as ex:  # the embedded driver is not on every classpath
        pytest.skip(f"embedded JDBC unavailable: {ex}")
    got = read_source(spark, "jdbc", {"url": url, "driver": driver, "dbtable": "READINGS",
                                      "partitionColumn": "ID", "numPartitions": "4"})
    assert got.count() == 100
    assert got.rdd.getNumPartitions() == 4
    q = read_source(spark, "jdbc", {"url": url, "driver": driver,
                                    "query": "SELECT ID FROM READINGS WHERE ID > 90"})
    assert q.count() == 10


def test_watermark_store(spark, tmp_root):
    st = WatermarkStore(spark, f"{tmp_root}/state")
    assert st.last_value("readings", "creation_time") is None
    st.save("readings", "creation_time", "2021-01-01 00:00:00", load_id=1)
    st.save("readings", "creation_time", "2022-01-01 00:00:00", load_id=2)
    assert st.last_value("readings", "creation_time") == "2022-01-01 00:00:00"
    st.save("readings", "window_end", "2020-01-01 00:00:00", load_id=3)  # a window's end comes first
    assert st.last_value("readings", "creation_time") == "2020-01-01 00:00:00"


def test_incremental_ingest_advances_watermark_and_is_idempotent(spark, tmp_root):
    t = meter_tables()["readings"]
    r = fixtures.sources(spark, SF_SMALL).readings
    st = WatermarkStore(spark, f"{tmp_root}/state")
    target = f"{tmp_root}/raw"
    first = r.filter(F.col("creation_time") < F.to_timestamp_ntz(F.lit(fixtures.BATCH1_END)))
    res1 = ingest(spark, t, "parquet", {}, target, st, source=first)
    assert res1.rows == first.count() and res1.watermark is not None
    res2 = ingest(spark, t, "parquet", {}, target, st, source=r)
    assert res1.rows + res2.rows == r.count()
    assert ingest(spark, t, "parquet", {}, target, st, source=r).rows == 0


def test_dimension_ingest_adds_only_new_versions(spark, tmp_root):
    t = meter_tables()["customers"]
    c = fixtures.sources(spark, SF_SMALL).customers
    target = f"{tmp_root}/customers"
    n = ingest(spark, t, "parquet", {}, target, source=c).rows
    assert n == c.count()
    assert ingest(spark, t, "parquet", {}, target, source=c).rows == 0
    changed = fixtures.sources(spark, SF_SMALL, changed=True).customers
    n_changed = changed.join(c, ["installation_id", "status"], "left_anti").count()
    assert ingest(spark, t, "parquet", {}, target, source=changed).rows == n_changed


def test_ingest_all_reports_and_raises_after_all_tables(spark, tmp_root):
    tables = list(meter_tables().values())
    s = fixtures.sources(spark, SF_SMALL).as_dict()
    export = {}
    for name, df in s.items():
        export[name] = f"{tmp_root}/export/{name}"
        if name != "assets":  # assets export missing -> that table fails
            df.write.parquet(export[name])
    with pytest.raises(RuntimeError, match="assets"):
        ingest_all(spark, tables, "parquet", lambda t: {"path": export[t.name]},
                   lambda t: f"{tmp_root}/lake/{t.name}")
    assert path_exists(spark, f"{tmp_root}/lake/readings")  # later tables still loaded


def test_register_new_files_exactly_once(spark, tmp_root):
    schema = to_struct(meter_tables()["readings"])
    r = fixtures.sources(spark, SF_SMALL).readings
    landing, target = f"{tmp_root}/landing", f"{tmp_root}/raw"
    r.limit(100).write.mode("append").parquet(landing)
    assert register_new_files(spark, landing, schema, target) == 100
    assert register_new_files(spark, landing, schema, target) == 0
    r.write.mode("append").parquet(landing)
    assert register_new_files(spark, landing, schema, target) == r.count()


def test_partitioned_append_and_upsert(spark, tmp_root):
    p = f"{tmp_root}/t"
    d = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("k", d, "a"), ("j", d + dt.timedelta(days=1), "b")],
                               "hk string, load_ts timestamp_ntz, v string") \
        .withColumn("load_day", F.to_date("load_ts"))
    append(df, p, ["load_day"])
    src = spark.createDataFrame([("k", d, "a2"), ("n", d, "c")],
                                "hk string, load_ts timestamp_ntz, v string") \
        .withColumn("load_day", F.to_date("load_ts"))
    with pytest.raises(ValueError):  # a key could move to another partition
        upsert(spark, src, p, ["hk", "load_ts"], partition_by=["load_day"])
    upsert(spark, src, p, ["hk", "load_ts", "load_day"], partition_by=["load_day"])
    got = rows(spark.read.parquet(p).select("hk", "v"))
    assert got == [("j", "b"), ("k", "a2"), ("n", "c")]


def test_build_twice_is_idempotent_and_views_answer_sql(spark, tmp_root):
    src = fixtures.sources(spark, SF_SMALL)
    root = f"{tmp_root}/vault"
    first = run_build(spark, src, root, load_ts="2025-01-01 00:00:00")
    assert first.appended["hub_customer"] > 0
    assert first.checks.filter(~F.col("passed")).count() == 0
    second = run_build(spark, src, root, load_ts="2025-01-01 00:00:00")
    assert all(n == 0 for n in second.appended.values())
    v = read_vault(spark, root)
    assert v.hub_asset.count() == first.appended["hub_asset"]
    assert "load_day" in spark.read.parquet(table_path(root, "sat_asset_measurements")).columns
    register_views(spark, root)
    n = spark.sql("SELECT count(*) AS n FROM bv_customer_asset_hierarchy "
                  "WHERE meter_status = 'ACTIVE'").first().n
    assert n > 0


def test_as_of_on_stored_table_prunes_partitions(spark, tmp_root):
    from vaultline.operators.business import as_of
    src = fixtures.sources(spark, SF_SMALL)
    root = f"{tmp_root}/vault"
    run_build(spark, src, root, run_checks=False)
    m = spark.read.parquet(table_path(root, "sat_asset_measurements"))
    plan = as_of(m, "1997-01-01 00:00:00")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load_day" in plan


def test_late_filter_uses_target_maximum_minus_lookback(spark):
    from vaultline.plans.ingest import late_filter
    d = dt.datetime(2024, 1, 2, 12)
    existing = spark.createDataFrame([(d,)], "ts timestamp_ntz")
    new = spark.createDataFrame([(d - dt.timedelta(hours=h),) for h in (30, 20, 0, -5)],
                                "ts timestamp_ntz")
    assert late_filter(new, None, "ts").count() == 4
    got = sorted(r.ts for r in late_filter(new, existing, "ts", 24).collect())
    assert got == [d - dt.timedelta(hours=20), d, d + dt.timedelta(hours=5)]


def test_time_travel_falls_back_to_load_time_filter(spark, tmp_root):
    from vaultline.operators.business import time_travel
    d = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("k", d, "a"), ("k", d + dt.timedelta(days=2), "b")],
                               "hk string, load_ts timestamp_ntz, v string")
    df.createOrReplaceTempView("tt_sat")
    got = time_travel(spark, "tt_sat", "2024-01-02 00:00:00", keys=["hk"])
    assert [r.v for r in got.collect()] == ["a"]


def test_jdbc_source_joins_lake_table_in_one_plan(spark, tmp_root):
    url = "jdbc:derby:memory:vaultline_join;create=true"
    driver = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    try:
        spark.createDataFrame([("M1", "ACC1"), ("M2", "ACC2")], "ASSET_ID string, ACCOUNT_ID string") \
            .write.format("jdbc").options(url=url, driver=driver, dbtable="ASSETS") \
            .mode("overwrite").save()
    except Exception as ex:
        pytest.skip(f"embedded JDBC unavailable: {ex}")
    spark.createDataFrame([("M1", 1.0), ("M1", 2.0), ("M3", 3.0)], "asset_id string, v double") \
        .write.parquet(f"{tmp_root}/readings")
    src = read_source(spark, "jdbc", {"url": url, "driver": driver, "dbtable": "ASSETS"})
    lake = spark.read.parquet(f"{tmp_root}/readings")
    got = lake.join(src, lake.asset_id == src.ASSET_ID).groupBy("ACCOUNT_ID").count().collect()
    assert [(r.ACCOUNT_ID, r["count"]) for r in got] == [("ACC1", 2)]


def test_command_line_ingest_build_sql(spark, tmp_root, capsys):
    from vaultline.__main__ import main
    s = fixtures.sources(spark, SF_SMALL).as_dict()
    for name, df in s.items():
        df.write.parquet(f"{tmp_root}/export/{name}")
    lake, vault = f"{tmp_root}/lake", f"{tmp_root}/vault"
    assert main(["ingest", "--kind", "parquet", "--source-root", f"{tmp_root}/export",
                 "--lake", lake]) == 0
    assert main(["ingest", "--kind", "parquet", "--source-root", f"{tmp_root}/export",
                 "--lake", lake]) == 0  # second run: nothing new
    assert spark.read.parquet(f"{lake}/readings").count() == s["readings"].count()
    assert spark.read.parquet(f"{lake}/customers").count() == s["customers"].count()
    assert main(["build", "--lake", lake, "--vault", vault, "--load-ts",
                 "2025-01-01 00:00:00"]) == 0
    assert main(["sql", "--vault", vault,
                 "SELECT count(*) AS n FROM bv_asset_measurements"]) == 0
    assert main(["check", "--vault", vault, "--lake", lake]) == 0  # source findings only report
    out = capsys.readouterr().out
    assert "hub_customer: +" in out


def test_incremental_build_equals_pure_loaders_and_survives_stale_current(spark, tmp_root):
    from vaultline.operators.staging import stage_readings
    from vaultline.operators.vault import (HUB_CUSTOMER, SAT_CUSTOMER_DETAILS, hub_rows,
                                           latest_versions, measurement_rows, satellite_rows)
    root = f"{tmp_root}/vault"
    b1 = fixtures.sources(spark, SF_SMALL, batch=1)
    b2 = fixtures.sources(spark, SF_SMALL, changed=True)
    run_build(spark, b1, root, run_checks=False)
    r2 = run_build(spark, b2, root, run_checks=False)

    def st(s):
        return stage_readings(s.readings, s.assets, s.customer_accounts, s.customers)
    sat1 = satellite_rows(st(b1), SAT_CUSTOMER_DETAILS)
    sat_new = satellite_rows(st(b2), SAT_CUSTOMER_DETAILS, existing=sat1)
    assert r2.appended["sat_customer_details"] == sat_new.count() > 0
    stored_sat = spark.read.parquet(table_path(root, "sat_customer_details"))
    assert rows(stored_sat) == rows(sat1.unionByName(sat_new))
    m_new = measurement_rows(st(b2), existing=measurement_rows(st(b1)))
    assert r2.appended["sat_asset_measurements"] == m_new.count()
    assert rows(spark.read.parquet(table_path(root, "hub_customer"))) == \
        rows(hub_rows(st(b2), HUB_CUSTOMER))
    cur = spark.read.parquet(table_path(root, "sat_customer_details__current"))
    assert rows(cur.select("customer_hk", "customer_hashdiff")) == \
        rows(latest_versions(stored_sat, SAT_CUSTOMER_DETAILS))
    # a run that died before replacing the current table leaves a stale marker
    spark.range(1).select(F.lit(-1).cast("long").alias("sat_rows")).write.mode("overwrite") \
        .option("partitionOverwriteMode", "static") \
        .parquet(table_path(root, "sat_customer_details__current_marker"))
    r3 = run_build(spark, b2, root, run_checks=False)
    assert all(n == 0 for n in r3.appended.values())


def test_documented_sql_queries_run_on_the_views(spark, tmp_root):
    root = f"{tmp_root}/vault"
    run_build(spark, fixtures.sources(spark, SF_SMALL), root, run_checks=False)
    register_views(spark, root)
    active = spark.sql("""SELECT installation_id, customer_name, customer_type, account_meter_id,
        meter_type, meter_status FROM rpt_active_hierarchy WHERE meter_status = 'ACTIVE'
        ORDER BY installation_id""").collect()
    assert active and all(r.customer_name for r in active)
    day = spark.sql("SELECT max(DATE(interval_start)) AS d FROM bv_asset_measurements").first().d
    recent = spark.sql(f"""SELECT meter_id AS asset_id, reading_value, interval_start, reading_type,
        unit_of_measure, quality_code FROM bv_asset_measurements
        WHERE DATE(interval_start) = DATE'{day}' ORDER BY interval_start DESC LIMIT 20""").collect()
    assert 0 < len(recent) <= 20
    q = spark.sql("""SELECT quality_code, reading_status, COUNT(*) AS reading_count
        FROM sat_asset_measurements GROUP BY 1, 2 ORDER BY 3 DESC""").collect()
    assert q[0].reading_count >= q[-1].reading_count
    counts = spark.sql("""SELECT 'Customers' AS entity, COUNT(*) AS n FROM hub_customer
        UNION ALL SELECT 'Accounts', COUNT(*) FROM hub_customer_account
        UNION ALL SELECT 'Assets', COUNT(*) FROM hub_asset""").collect()
    assert {r.entity: r.n for r in counts} == \
        {r.entity: r.record_count for r in spark.table("rpt_hub_counts").collect()}
    assert spark.sql("SELECT * FROM bv_customer_asset_hierarchy LIMIT 5").count() == 5


def test_register_new_files_recovers_a_run_that_died_before_the_manifest(spark, tmp_root, monkeypatch):
    from vaultline.plans import ingest as module
    schema = to_struct(meter_tables()["readings"])
    r = fixtures.sources(spark, SF_SMALL).readings
    landing, target = f"{tmp_root}/landing", f"{tmp_root}/raw"
    r.write.mode("append").parquet(landing)

    def dies(files, target):
        raise RuntimeError("killed")
    with monkeypatch.context() as m:
        m.setattr(module, "_record", dies)
        with pytest.raises(RuntimeError):
            register_new_files(spark, landing, schema, target)
    assert register_new_files(spark, landing, schema, target) == 0
    assert spark.read.parquet(target).count() == r.count()
    assert "_manifest" not in " ".join(spark.read.parquet(target).inputFiles())


def test_watermark_filter_reaches_the_parquet_scan(spark, tmp_root):
    t = meter_tables()["readings"]
    lake = f"{tmp_root}/lake_readings"
    fixtures.sources(spark, SF_SMALL).readings.write.parquet(lake)
    st = WatermarkStore(spark, f"{tmp_root}/state")
    st.save("readings", "creation_time", "1998-01-01 00:00:00", load_id=1)
    rows_ = plan_ingest(spark, t, source_frame(spark, t, "parquet", {"path": lake}),
                        f"{tmp_root}/raw", st)
    plan = rows_._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(creation_time" in plan


def test_shuffle_sizing_only_raises_and_restores(spark):
    from vaultline.session import INITIAL_PARTITIONS, sized_shuffles
    before = spark.conf.get(INITIAL_PARTITIONS, None)
    base = int(before or spark.conf.get("spark.sql.shuffle.partitions"))
    joined = fixtures.sources(spark, SF_SMALL).customers  # a 3-way join over small files
    for df, size, more in ((joined, 128 << 20, False), (spark.range(10), 1, True)):
        with sized_shuffles(spark, df, size) as n:
            assert int(spark.conf.get(INITIAL_PARTITIONS)) == n
            assert n > base if more else n == base
        assert spark.conf.get(INITIAL_PARTITIONS, None) == before


def test_null_and_tied_timestamps_are_loaded_once(spark, tmp_root):
    t = TableDef("t", (FieldDef("id", "integer", required=True), FieldDef("at", "timestamp")),
                 is_incremental=True, incremental_field="at")
    st = WatermarkStore(spark, f"{tmp_root}/state")
    d = dt.datetime(2024, 1, 1)

    def load(*data):
        df = spark.createDataFrame(list(data), "id int, at timestamp_ntz")
        return ingest(spark, t, "parquet", {}, f"{tmp_root}/t", st, source=df)
    first = [(1, d), (2, None), (None, d), (4, dt.datetime(1800, 1, 1))]
    r = load(*first)
    assert (r.rows, r.null_required) == (4, 1)
    assert load(*first, (5, d), (6, None)).rows == 2
    assert load(*first, (5, d), (6, None)).rows == 0


def test_lookback_of_the_definition_finds_late_rows(spark, tmp_root):
    t = TableDef("t", (FieldDef("id", "integer"), FieldDef("at", "timestamp")), is_incremental=True,
                 incremental_field="at", lookback_hours=24, dedup_keys=("id",))
    assert parse_tables(to_config([t]))[0] == t
    st = WatermarkStore(spark, f"{tmp_root}/state")
    d = dt.datetime(2024, 1, 3)

    def load(*data):
        df = spark.createDataFrame(list(data), "id int, at timestamp_ntz")
        return ingest(spark, t, "parquet", {}, f"{tmp_root}/t", st, source=df).rows
    assert load((1, d)) == 1
    hour = dt.timedelta(hours=1)
    assert load((1, d), (2, d - 23 * hour), (3, d - 25 * hour)) == 1
    assert st.last_value("t", "at").startswith("2024-01-03")  # late rows don't move it back


def test_reverted_dimension_row_is_a_new_version(spark, tmp_root):
    t = TableDef("t", (FieldDef("k", "string"), FieldDef("v", "string")), primary_key="k")

    def load(*data):
        df = spark.createDataFrame(list(data), "k string, v string")
        return ingest(spark, t, "parquet", {}, f"{tmp_root}/t", source=df).rows
    assert [load(("a", x), (None, "n"), ("b", "same")) for x in "ABAA"] == [3, 1, 1, 0]
    from vaultline.operators.staging import dedup_by_key
    stored = spark.read.parquet(f"{tmp_root}/t").withColumn("last_modified", F.lit(1))
    now = dedup_by_key(stored, "k")
    assert {r.k: r.v for r in now.collect()} == {"a": "A", "b": "same", None: "n"}


def test_storage_errors_are_raised(spark):
    with pytest.raises(Exception, match="nosuchscheme"):
        path_exists(spark, "nosuchscheme://store/table")


def test_cluster_sessions_need_a_checkpoint_folder():
    from vaultline.session import checkpoint_root

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())


def test_interrupted_upsert_is_finished_by_the_next_read(spark, tmp_root, monkeypatch):
    from vaultline.plans import sinks
    p = f"{tmp_root}/t"
    spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int").write.parquet(p)
    change = spark.createDataFrame([("b", 3), ("c", 4), ("c", 5)], "k string, v int")  # no load_ts column

    def dies(*a):
        raise RuntimeError("killed")
    with monkeypatch.context() as m:
        m.setattr(sinks, "_replace", dies)
        with pytest.raises(RuntimeError):
            upsert(spark, change, p, ["k"])
    assert rows(sinks.read_or_none(spark, p)) == [("a", 1), ("b", 3), ("c", 5)]
    upsert(spark, change, p, ["k"])
    assert rows(spark.read.parquet(p)) == [("a", 1), ("b", 3), ("c", 5)]


def test_build_leaves_no_scratch_and_reads_the_fact_once_per_staging(spark, tmp_root):
    import os
    from vaultline.session import checkpoint_root
    root = checkpoint_root(spark).removeprefix("file:")
    before = set(os.listdir(root))
    run_build(spark, fixtures.sources(spark, SF_SMALL, batch=1), f"{tmp_root}/vault", run_checks=False)
    left = {x for x in set(os.listdir(root)) - before if not x.startswith("test-")}
    assert not left


def test_incremental_ingest_survives_lost_watermark(spark, tmp_root):
    from vaultline.session import delete_path
    t = meter_tables()["readings"]
    r = fixtures.sources(spark, SF_SMALL).readings
    st = WatermarkStore(spark, f"{tmp_root}/state")
    target = f"{tmp_root}/raw"
    first = r.filter(F.col("creation_time") < F.to_timestamp_ntz(F.lit(fixtures.BATCH1_END)))
    ingest(spark, t, "parquet", {}, target, st, source=first)
    delete_path(spark, f"{tmp_root}/state")  # the run died before saving its watermark
    st = WatermarkStore(spark, f"{tmp_root}/state")
    res = ingest(spark, t, "parquet", {}, target, st, source=r)
    assert res.rows == r.count() - first.count()
    assert spark.read.parquet(target).count() == r.count()


def test_stream_load_satellites_and_all_tables_match_batch(spark, tmp_root):
    from vaultline.streaming import stream_load
    s = fixtures.sources(spark, SF_SMALL)
    schema = to_struct(meter_tables()["readings"])
    landing, ckpt, vault = f"{tmp_root}/landing", f"{tmp_root}/ckpt", f"{tmp_root}/vault"
    names = ["hub_customer", "link_account_asset", "sat_customer_details",
             "sat_asset_measurements"]
    first = F.col("creation_time") < F.to_timestamp_ntz(F.lit(fixtures.BATCH1_END))
    for wave in (first, ~first):
        s.readings.filter(wave).write.mode("append").parquet(landing)
        stream_load(spark, landing, schema, vault, ckpt, names,
                    lambda: (s.assets, s.customer_accounts, s.customers))
    batch = f"{tmp_root}/batch"
    run_build(spark, fixtures.sources(spark, SF_SMALL, batch=1), batch, run_checks=False)
    run_build(spark, s, batch, run_checks=False)
    for n in names:
        a = spark.read.parquet(f"{vault}/{n}")
        b = spark.read.parquet(table_path(batch, n))
        assert rows(a.select(*sorted(a.columns))) == rows(b.select(*sorted(b.columns))), n
