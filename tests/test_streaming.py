"""Stream state, the ledger of epochs, and the small journals behind them."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import StreamingQueryException

from vaultline.sources import fixtures
from vaultline.sources.journal import Journal
from vaultline.sources.schema import meter_tables, to_struct
from vaultline.sources.state import STATE_SCHEMA, WatermarkStore
from vaultline.streaming import dedup, ledger, loads, stream_dedup, stream_load

from .conftest import SF_SMALL, rows

SCHEMA = to_struct(meter_tables()["readings"])
T0 = dt.datetime(2024, 5, 1)


def reading(i, hour, asset="M", value="1.000"):
    at = None if hour is None else T0 + dt.timedelta(hours=hour)
    start = T0 + dt.timedelta(hours=hour or 0)
    return (i, asset, Decimal(value), start, start, at, "CONSUMPTION", "kWh", "GOOD", "VALID", "S")


def land(spark, path, *data):
    spark.createDataFrame(list(data), SCHEMA).coalesce(1).write.mode("append").parquet(path)


def places(root):
    return f"{root}/landing", f"{root}/vault", f"{root}/ckpt"


def stored(spark, vault):
    return sorted(r.reading_id for r in spark.read.parquet(f"{vault}/sat_asset_measurements").collect())


def test_state_and_table_together_store_every_reading_once(spark, tmp_root, monkeypatch):
    landing, vault, ckpt = places(tmp_root)
    looked = []
    real = dedup.measurement_rows

    def spy(rows, m, existing=None, prune_days=False):
        looked.append(existing is not None)
        return real(rows, m, existing, prune_days=prune_days)
    monkeypatch.setattr(dedup, "measurement_rows", spy)

    def run():
        stream_dedup(spark, landing, SCHEMA, vault, ckpt, dt.timedelta(hours=6))
    land(spark, landing, reading(1, 0), reading(1, 0), reading(2, 1))
    run()
    assert stored(spark, vault) == [1, 2]
    land(spark, landing, reading(2, 1), reading(3, 2))  # a repeat within the delay, after a restart
    run()
    assert stored(spark, vault) == [1, 2, 3]
    land(spark, landing, reading(4, 100))
    run()
    # far behind: a repeat, a row that never came (twice), rows without a time or an asset
    land(spark, landing, reading(1, 0), reading(5, 3), reading(5, 3), reading(6, None), reading(7, 90, asset=None), reading(8, 99))
    run()
    land(spark, landing, reading(5, 3), reading(9, 101))
    run()
    assert stored(spark, vault) == [1, 2, 3, 4, 5, 6, 8, 9]  # without an asset there is no hub key
    assert not any(looked[::2])  # the way on time never looks at the table


@pytest.mark.parametrize("died", ["before the append", "after the append"])
def test_a_dedup_batch_that_died_is_finished_without_repeats(spark, tmp_root, monkeypatch, died):
    landing, vault, ckpt = places(tmp_root)
    land(spark, landing, reading(1, 0))
    stream_dedup(spark, landing, SCHEMA, vault, ckpt)
    land(spark, landing, reading(1, 0), reading(2, 1), reading(3, -500))
    real = dedup.store

    def failing(*a):
        if died == "after the append":
            real(*a)
        raise RuntimeError("the driver died")
    monkeypatch.setattr(dedup, "store", failing)
    with pytest.raises(StreamingQueryException):
        stream_dedup(spark, landing, SCHEMA, vault, ckpt)
    monkeypatch.setattr(dedup, "store", real)
    stream_dedup(spark, landing, SCHEMA, vault, ckpt)
    assert stored(spark, vault) == [1, 2, 3]


def test_a_killed_batch_resumes_at_the_table_it_reached(spark, tmp_root, monkeypatch):
    landing, vault, ckpt = places(tmp_root)
    s = fixtures.sources(spark, SF_SMALL)
    names = ["hub_customer", "link_account_asset", "sat_asset_measurements"]
    dims = lambda: (s.assets, s.customer_accounts, s.customers)
    s.readings.write.parquet(landing)
    real, tried = loads._load_one, []

    def failing(spark_, staged, name, root):
        tried.append(name)
        if name == names[1] and tried.count(name) == 1:
            raise RuntimeError("killed")
        real(spark_, staged, name, root)
    monkeypatch.setattr(loads, "_load_one", failing)
    with pytest.raises(StreamingQueryException):
        stream_load(spark, landing, SCHEMA, vault, ckpt, names, dims)
    assert tried == names[:2]
    stream_load(spark, landing, SCHEMA, vault, ckpt, names, dims)
    assert tried == [*names[:2], *names[1:]]  # the first table is not loaded again
    told = ledger.Ledger(spark, f"{vault}/{loads.LEDGER}", ledger.stream_name(spark, ckpt))
    assert told.steps(0) == {n: ledger.DONE for n in names}
    # a new checkpoint is a new stream: its epoch 0 is not taken for the old one
    stream_load(spark, landing, SCHEMA, vault, f"{ckpt}-new", names[:1], dims)
    assert tried[-1] == names[0]
    assert spark.read.parquet(f"{vault}/hub_customer").groupBy("customer_hk").count().filter("count > 1").isEmpty()


def test_ledger_compaction_keeps_what_is_asked_for(spark, tmp_root):
    told = ledger.Ledger(spark, f"{tmp_root}/ledger", "s")
    told.most_files = 5
    for e in range(6):
        told.note(e, "t", ledger.BEGUN)
        told.note(e, "t", ledger.DONE, T0 + dt.timedelta(hours=10 - e))
        told.note(e, "u", ledger.DONE)
    other = ledger.Ledger(spark, f"{tmp_root}/ledger", "other")
    assert len(told._files()) <= 6
    assert told.steps(5) == {"t": ledger.DONE, "u": ledger.DONE} and other.steps(5) == {}
    assert told.high(6, "t") == T0 + dt.timedelta(hours=10) and told.high(6, "u") is None


def test_journal_keeps_all_rows_whenever_compaction_dies(spark, tmp_root):
    j = Journal(spark, f"{tmp_root}/j", STATE_SCHEMA, most_files=3)
    for i in range(3):
        j.append(("t", "f", str(i), i, T0))
    j.append(("t", "f", "3", 3, T0))
    assert len(j._files()) == 1 and j.frame().count() == 4
    # the old files were not deleted yet: rows are there twice, which readers do not mind
    j.needed(j.frame()).coalesce(1).write.mode("append").parquet(j.path)
    assert rows(j.frame().distinct()) == rows(j.needed(j.frame()))


def test_watermarks_survive_compaction_and_the_later_load_counts(spark, tmp_root):
    st = WatermarkStore(spark, f"{tmp_root}/state")
    st.most_files = 4
    st.save("readings", "window_end", "2020-06-01 00:00:00", load_id=1)  # from an older job
    for n in range(2, 8):
        st.save("readings", "creation_time", f"2020-0{n}-01 00:00:00", load_id=n)
    assert len(st._files()) <= 5
    assert st.last_value("readings", "creation_time") == "2020-07-01 00:00:00"
    assert st.last_value("customers", "creation_time") is None


def test_on_time_rows_and_raw_rows_share_one_stateful_plan(spark, tmp_root):
    landing = f"{tmp_root}/landing"
    land(spark, landing, reading(1, 0))
    stream = spark.readStream.schema(SCHEMA).parquet(landing)
    out = dedup.both_ways(stream, dedup.KEYS, "creation_time", "60 seconds")
    assert out.isStreaming and out.columns == [*SCHEMA.names, "__event", "__on_time"]
    plan = out._jdf.queryExecution().logical().toString()
    assert "DeduplicateWithinWatermark" in plan


def test_a_stream_of_hubs_stages_assets_and_one_of_a_satellite_keeps_no_copy(spark, tmp_root, monkeypatch):
    """Hubs and links need the first row per asset, not every reading with all columns."""
    s = fixtures.sources(spark, SF_SMALL)
    s.readings.coalesce(1).write.parquet(f"{tmp_root}/landing")
    staged, real = [], loads.stage_readings

    def spy(*args, **kwargs):
        staged.append(args)
        return real(*args, **kwargs)
    monkeypatch.setattr(loads, "stage_readings", spy)
    dims = lambda: (s.assets, s.customer_accounts, s.customers)
    stream_load(spark, f"{tmp_root}/landing", SCHEMA, f"{tmp_root}/hubs", f"{tmp_root}/c1", ["hub_customer", "link_account_asset"], dims)
    assert not staged
    kept = []
    frame = type(s.readings)
    persist = frame.persist
    monkeypatch.setattr(frame, "persist", lambda df, *a: kept.append(df) or persist(df, *a))
    stream_load(spark, f"{tmp_root}/landing", SCHEMA, f"{tmp_root}/sat", f"{tmp_root}/c2", ["sat_customer_details"], dims)
    assert staged and not kept
    everything = real(s.readings, *dims())
    for name, build, root in (("hub_customer", loads.hub_rows, "hubs"), ("link_account_asset", loads.link_rows, "hubs")):
        assert rows(spark.read.parquet(f"{tmp_root}/{root}/{name}")) == rows(build(everything, loads.BINDINGS[name]))
    assert spark.read.parquet(f"{tmp_root}/sat/sat_customer_details").count() == everything.count()
