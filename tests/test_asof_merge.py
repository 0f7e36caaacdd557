"""The join to the version in force, and merges whose source has several rows per key."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from vaultline.operators.asof import BEGIN, as_of_join, chained, timeline
from vaultline.operators.merge import MergeConflict, contested_keys, split_conflicts
from vaultline.operators.staging import STAGED_COLUMNS, stage_as_of, stage_readings
from vaultline.operators.vault import SAT_CUSTOMER_DETAILS, satellite_rows
from vaultline.plans.sinks import merge
from vaultline.sources import fixtures

from .conftest import SF_SMALL, rows
from .test_vault import sources, t

T0 = dt.datetime(2024, 1, 1)


def h(hours):
    return T0 + dt.timedelta(hours=hours)


VERSIONS = "k string, changed timestamp_ntz, v string"
FACTS = "id int, k string, at timestamp_ntz"


def brute(facts, versions):
    """Last version not after the fact; the first one before all; the last one without a time."""
    out = []
    for i, k, at in facts:
        mine = sorted(((c is not None, c or T0, v) for kk, c, v in versions if kk == k and k is not None))
        held = [v for n, (_, c, v) in enumerate(mine) if at is None or n == 0 or c <= at]
        # of versions that share the first time the last one counts
        first = [v for has, c, v in mine if (has, c) == mine[0][:2]] if mine else []
        if mine:
            out.append((i, max([held[-1]]) if len(held) > len(first) else first[-1]))
    return sorted(out)


@pytest.mark.parametrize("unit", ["HOUR", "DAY", "YEAR"])
def test_as_of_join_equals_brute_force(spark, unit):
    rng = random.Random(3)
    keys = [f"k{i}" for i in range(12)] + [None]
    versions = [(k, rng.choice([None, *[h(x) for x in range(0, 400, 7)]]), f"v{n:03}") for n, k in
                enumerate(rng.choices(keys, k=70))]
    facts = [(i, rng.choice([*keys, "unknown"]), rng.choice([None, *[h(x) for x in range(-50, 450, 5)]])) for i in range(600)]
    line = timeline(spark.createDataFrame(versions, VERSIONS), "k", "changed").select("k", "v", "valid_from")
    got = as_of_join(spark.createDataFrame(facts, FACTS), line, "k", "at", unit)
    assert sorted((r.id, r.v) for r in got.collect()) == brute(facts, versions)
    kept = as_of_join(spark.createDataFrame(facts, FACTS), line, "k", "at", unit, how="left")
    assert sorted(r.id for r in kept.collect()) == list(range(600))
    assert sorted((r.id, r.v) for r in kept.filter("v is not null").collect()) == brute(facts, versions)


def test_as_of_join_of_nothing_and_clashing_columns(spark):
    line = timeline(spark.createDataFrame([("a", T0, "x")], VERSIONS), "k", "changed").select("k", "v", "valid_from")
    facts = spark.createDataFrame([(1, "a", T0)], FACTS)
    assert as_of_join(facts.limit(0), line, "k", "at").count() == 0
    assert as_of_join(facts, line.limit(0), "k", "at").count() == 0
    assert as_of_join(facts, line.limit(0), "k", "at", how="left").count() == 1
    with pytest.raises(ValueError):
        as_of_join(facts.withColumn("v", F.lit(1)), line, "k", "at")


def test_as_of_join_shuffles_the_fact_once_and_has_no_range_join(spark):
    line = timeline(spark.createDataFrame([("a", T0, "x")], VERSIONS), "k", "changed").select("k", "v", "valid_from")
    plan = as_of_join(spark.createDataFrame([(1, "a", T0)], FACTS), line, "k", "at")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Join" not in plan


def test_hot_key_is_spread_over_pieces(spark):
    """A third of all facts on one key: no window partition holds more of them than one piece."""
    facts = spark.range(60_000).select(
        F.col("id").cast("int").alias("id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("k"),
        F.timestamp_add("HOUR", (F.col("id") % 2000).cast("int"), F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00"))).alias("at"))
    versions = spark.createDataFrame([("hot", h(100 * i), f"{i:02}") for i in range(15)]
                                     + [(f"k{i}", T0, "only") for i in range(500)], VERSIONS)
    line = timeline(versions, "k", "changed").select("k", "v", "valid_from")
    got = as_of_join(facts, line, "k", "at")
    expected = facts.withColumn("v", F.when(F.col("k") == "hot", F.lpad((F.least(
        F.floor((F.col("id") % 2000) / 100), F.lit(14))).cast("string"), 2, "0")).otherwise("only"))
    assert got.count() == 60_000
    assert got.select("id", "v").exceptAll(expected.select("id", "v")).isEmpty()
    keys = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(__key" in keys and "__piece" in keys
    widest = facts.groupBy("k", F.to_date("at")).count().agg(F.max("count")).first()[0]
    assert widest < 60_000 / 50


def test_chained_timelines_equal_daily_lookups(spark):
    rng = random.Random(8)
    children = [(f"c{i % 5}", h(24 * rng.randrange(60)), f"p{rng.randrange(3)}", f"c{i}") for i in range(15)]
    parents = [(f"p{i % 3}", h(24 * rng.randrange(60)), f"p{i}") for i in range(9)]
    c = timeline(spark.createDataFrame(children, "child string, changed timestamp_ntz, p string, cv string"), "child", "changed").drop("changed")
    p = timeline(spark.createDataFrame(parents, "p string, changed timestamp_ntz, pv string"), "p", "changed").drop("changed")
    chain = sorted((tuple(r) for r in chained(c, p, "child", "p").select("child", "valid_from", "cv", "p", "pv").collect()))

    def at(line, key, when):
        own = [r for r in line if r[0] == key and r[1] <= when]
        return max(own, key=lambda r: r[1])
    cs = [tuple(r) for r in c.select("child", "valid_from", "p", "cv").collect()]
    ps = [tuple(r) for r in p.select("p", "valid_from", "pv").collect()]
    begin = dt.datetime.fromisoformat(BEGIN)
    assert {r[1] for r in cs} >= {begin}
    for child in sorted({r[0] for r in cs}):
        for day in range(-1, 62):
            one = at(cs, child, h(24 * day))
            assert at(chain, child, h(24 * day))[2:] == (one[3], one[2], at(ps, one[2], h(24 * day))[2])


def test_a_changed_customer_leaves_history_alone(spark):
    r, s, a, c = sources(spark)
    before = stage_as_of(r, s, a, c)
    assert before.columns == [*STAGED_COLUMNS, "change_ts"]
    assert rows(before.select(*STAGED_COLUMNS)) == rows(stage_readings(r, s, a, c))
    moved = c.filter("installation_id = 'I1'").withColumns({"status": F.lit("INACTIVE"), "last_modified": F.lit(t(2)).cast("timestamp_ntz")})
    after = stage_as_of(r, s, a, c.unionByName(moved))
    told = {x.reading_id: (x.customer_status, x.change_ts) for x in after.collect()}
    assert told == {1: ("ACTIVE", None), 2: ("INACTIVE", t(2)), 3: ("INACTIVE", t(2)), 4: ("ACTIVE", None)}
    # the satellite of the first load meets nothing new for the older reading
    first = satellite_rows(before, SAT_CUSTOMER_DETAILS)
    new = satellite_rows(after, SAT_CUSTOMER_DETAILS, existing=first)
    assert sorted(x.load_ts for x in new.collect()) == [t(2), t(2)]


def test_stage_as_of_keeps_readings_without_a_time_and_rejects_bad_modes(spark):
    r, s, a, c = sources(spark)
    r = r.withColumn("creation_time", F.when(F.col("id") != 1, F.col("creation_time")))
    got = stage_as_of(r, s, a, c, key_mode="md5")
    assert sorted(x.reading_id for x in got.collect()) == [1, 2, 3, 4]
    with pytest.raises(ValueError):
        stage_as_of(r, s, a, c, key_mode="other")


# -- merge -----------------------------------------------------------------------

ROW = "k string, j int, at int, v string"
MIXED = [("a", 1, 1, "x"), ("a", 1, 1, "x"),             # a repeat
         ("b", 1, 1, "old"), ("b", 1, 2, "new"),          # a conflict settled by the order
         ("c", 1, 1, "one"), ("c", 1, 1, "two"), ("c", 1, 1, None),  # a tie on the order
         (None, 1, 1, "lost"), ("d", None, 1, "lost"), ("d", None, 1, "lost"), ("e", 2, 1, None)]


def test_conflicts_are_split_off_with_a_reason_and_no_row_is_lost(spark):
    src = spark.createDataFrame(MIXED, ROW).repartition(3)
    assert rows(contested_keys(src, ["k", "j"])) == [("b", 1, 2), ("c", 1, 3)]
    clean, rejected = split_conflicts(src, ["k", "j"], ["at"])
    assert rows(clean) == [("a", 1, 1, "x"), ("b", 1, 2, "new"), ("c", 1, 1, "two"), ("e", 2, 1, None)]
    assert rows(rejected) == rows(spark.createDataFrame(
        [("b", 1, 1, "old", "CONFLICTING_KEY"), ("c", 1, 1, "one", "CONFLICTING_KEY"), ("c", 1, 1, None, "CONFLICTING_KEY"),
         (None, 1, 1, "lost", "NULL_KEY"), ("d", None, 1, "lost", "NULL_KEY")], ROW + ", reject_reason string"))
    together = clean.unionByName(rejected.drop("reject_reason"))
    assert rows(together) == rows(src.distinct())
    for part in split_conflicts(src.limit(0), ["k", "j"], ["at"]):
        assert part.count() == 0


def test_merge_fails_on_conflicts_before_it_writes(spark, tmp_root):
    path = f"{tmp_root}/t"
    merge(spark, spark.createDataFrame([("a", 1, 0, "was")], ROW), path, ["k", "j"])
    src = spark.createDataFrame(MIXED, ROW)
    with pytest.raises(MergeConflict, match="share a merge key"):
        merge(spark, src, path, ["k", "j"])
    with pytest.raises(MergeConflict, match="NULL"):
        merge(spark, src.filter("k is null"), path, ["k", "j"])
    assert rows(spark.read.parquet(path)) == [("a", 1, 0, "was")]
    merge(spark, src.filter("k = 'a'"), path, ["k", "j"])  # repeats are no conflict
    assert rows(spark.read.parquet(path)) == [("a", 1, 1, "x")]


def test_merge_routes_losers_to_rejects_once_per_batch(spark, tmp_root):
    path, rejects = f"{tmp_root}/t", f"{tmp_root}/rejects"
    src = spark.createDataFrame(MIXED, ROW)
    for batch in ("one", "one", "two"):  # a batch that is merged again replaces its rejects
        merge(spark, src, path, ["k", "j"], order=["at"], rejects=rejects, batch=batch)
    assert rows(spark.read.parquet(path)) == [("a", 1, 1, "x"), ("b", 1, 2, "new"), ("c", 1, 1, "two"), ("e", 2, 1, None)]
    assert {r.batch: r["count"] for r in spark.read.parquet(rejects).groupBy("batch").count().collect()} == {"one": 5, "two": 5}


def test_hot_contested_key_is_settled_without_gathering_it(spark):
    """A third of all rows are different versions of one key."""
    src = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
                                     F.col("id").alias("v"))
    clean, rejected = split_conflicts(src, ["k"], ["v"])
    assert clean.count() == 20_001 and rejected.count() == 9_999
    assert clean.filter("k = 'hot'").first().v == 29_997
    plan = clean.unionByName(rejected.drop("reject_reason"))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_history_fixture_has_versions(spark):
    s = fixtures.history(spark, SF_SMALL)
    for df, key in ((s.customers, "installation_id"), (s.customer_accounts, "account_id"), (s.assets, "asset_id")):
        assert df.count() > df.select(key).distinct().count()


def test_history_true_staging_repeats_no_version_columns_in_the_sequence(spark, monkeypatch):
    """Every piece of time with readings repeats the version that opens it: only its time goes there."""
    from vaultline.operators import staging
    asked = []

    def watched(facts, versions, *args, **kwargs):
        asked.append(versions.columns)
        return as_of_join(facts, versions, *args, **kwargs)
    monkeypatch.setattr(staging, "as_of_join", watched)
    r, s, a, c = sources(spark)
    off = a.withColumns({"status": F.lit("CLOSED"), "last_modified": F.lit(t(2)).cast("timestamp_ntz")})
    got = staging.stage_as_of(r, s, a.unionByName(off), c)
    assert asked == [["asset_id", "valid_from"]]
    assert {x.reading_id: x.account_status for x in got.collect()} == {
        x.reading_id: "CLOSED" if x.load_ts >= t(2) else "ACTIVE" for x in stage_readings(r, s, a, c).collect()}


def test_facts_are_asked_for_their_pieces_where_they_lie(spark):
    """The pieces with facts, their openings and the sequence itself share the one exchange of the facts."""
    facts = [(i, f"k{i % 7}", h(i % 50)) for i in range(200)]
    versions = [(f"k{i % 5}", h(9 * i), f"v{i:02}") for i in range(12)]
    line = timeline(spark.createDataFrame(versions, VERSIONS), "k", "changed").select("k", "v", "valid_from")
    got = as_of_join(spark.createDataFrame(facts, FACTS), line, "k", "at")
    assert sorted((r.id, r.v) for r in got.collect()) == brute(facts, versions)
    final = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final
    union = final.index("Union")
    assert "Exchange" not in final[:union]  # the sequence is put together where its parts lie


def test_history_true_staging_puts_changes_alone_into_the_sequence(spark, monkeypatch):
    """An asset's first version needs no place there, and a version is sent without keys and hash diffs."""
    from vaultline.operators import staging
    asked, hashed = [], []
    real = staging._keys_and_hashes

    def watched(facts, versions, *args, **kwargs):
        asked.append(versions)
        return as_of_join(facts, versions, *args, **kwargs)
    monkeypatch.setattr(staging, "as_of_join", watched)
    monkeypatch.setattr(staging, "_keys_and_hashes", lambda chain, mode: hashed.append(chain.columns) or real(chain, mode))
    r, s, a, c = sources(spark)
    got = staging.stage_as_of(r, s, a, c)
    assert asked[0].count() == 0
    assert "reading_id" in hashed[-1]
    assert rows(got.select(*STAGED_COLUMNS)) == rows(stage_readings(r, s, a, c))


def test_a_merge_settles_its_source_in_one_pass(spark, tmp_root, monkeypatch):
    """One row per key and the contested keys come from one grouping; the upsert does not group a settled source again."""
    from vaultline.operators import vault
    from vaultline.plans import sinks
    seen = []
    monkeypatch.setattr(vault, "latest_by", lambda df, *args, **kwargs: seen.append(df) or df)
    src = spark.createDataFrame(MIXED, ROW)
    sinks.merge(spark, src, f"{tmp_root}/t", ["k", "j"], order=["at"], rejects=f"{tmp_root}/r")
    assert not seen
    assert rows(spark.read.parquet(f"{tmp_root}/t")) == [("a", 1, 1, "x"), ("b", 1, 2, "new"), ("c", 1, 1, "two"), ("e", 2, 1, None)]
    assert spark.read.parquet(f"{tmp_root}/r").count() == 5


def test_merge_of_nothing_with_rejects(spark, tmp_root):
    src = spark.createDataFrame(MIXED, ROW)
    merge(spark, src, f"{tmp_root}/t", ["k", "j"], order=["at"], rejects=f"{tmp_root}/r")
    merge(spark, src.limit(0), f"{tmp_root}/t", ["k", "j"], order=["at"], rejects=f"{tmp_root}/r", batch="1")
    assert spark.read.parquet(f"{tmp_root}/t").count() == 4
