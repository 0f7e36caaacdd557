import datetime as dt
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from vaultline.operators.window import change_points, first_by, latest_by

from .conftest import rows

T0 = dt.datetime(2024, 1, 1)


def ts(h):
    return T0 + dt.timedelta(hours=h)


def test_first_by_takes_earliest_and_breaks_ties_by_other_columns(spark):
    df = spark.createDataFrame(
        [("k1", ts(2), "B"), ("k1", ts(1), "Z"), ("k1", ts(1), "A"), ("k2", ts(5), "C")],
        "k string, load_ts timestamp_ntz, src string")
    got = rows(first_by(df, ["k"], ["load_ts"]))
    assert got == [("k1", ts(1), "A"), ("k2", ts(5), "C")]


def test_latest_by_takes_latest_with_nulls_ranked_last(spark):
    df = spark.createDataFrame(
        [("k", ts(1), "a"), ("k", ts(3), None), ("k", ts(3), "b"), ("j", None, "x")],
        "k string, load_ts timestamp_ntz, v string")
    got = rows(latest_by(df, ["k"], ["load_ts"]))
    assert got == [("j", None, "x"), ("k", ts(3), "b")]


def test_first_by_empty_input(spark):
    df = spark.createDataFrame([], "k string, load_ts timestamp_ntz, v string")
    assert first_by(df, ["k"], ["load_ts"]).count() == 0


def test_first_by_keeps_column_order(spark):
    df = spark.createDataFrame([("a", ts(1), "k")], "v string, load_ts timestamp_ntz, k string")
    assert first_by(df, ["k"], ["load_ts"]).columns == ["v", "load_ts", "k"]


def brute_change_points(data):
    out = []
    by_key = {}
    for r in data:
        by_key.setdefault(r[0], []).append(r)
    for k, rs in by_key.items():
        rs.sort(key=lambda r: (r[1], r[2], r[3]))
        prev = object()
        for r in rs:
            if r[2] != prev:
                out.append(r)
            prev = r[2]
    return sorted(out, key=lambda t: tuple(str(v) for v in t))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 96),
                          st.sampled_from(["H1", "H2", "H3"]), st.integers(0, 3)),
                min_size=0, max_size=40))
def test_change_points_matches_brute_force(spark, data):
    data = [(k, ts(h), v, str(p)) for k, h, v, p in data]
    df = spark.createDataFrame(data, "k string, load_ts timestamp_ntz, hd string, p string")
    got = rows(change_points(df, ["k"], ["load_ts"], "hd"))
    assert got == brute_change_points(data)


def test_change_points_across_day_pieces(spark):
    # A -> A (next day) -> B -> A: kept A(first), B, A
    data = [("k", ts(1), "A", "x"), ("k", ts(30), "A", "x"), ("k", ts(31), "B", "x"),
            ("k", ts(60), "A", "x")]
    random.Random(1).shuffle(data)
    df = spark.createDataFrame(data, "k string, load_ts timestamp_ntz, hd string, p string")
    got = rows(change_points(df, ["k"], ["load_ts"], "hd"))
    assert [r[2] for r in sorted(got, key=lambda r: r[1])] == ["A", "B", "A"]


def test_change_points_passes_rows_without_key_through(spark):
    data = [("k", ts(1), "A", "x"), ("k", ts(2), "A", "x"), (None, ts(1), "A", "x"),
            (None, ts(2), "A", "x")]
    df = spark.createDataFrame(data, "k string, load_ts timestamp_ntz, hd string, p string")
    got = rows(change_points(df, ["k"], ["load_ts"], "hd"))
    assert got == rows(spark.createDataFrame([data[0], data[2], data[3]], df.schema))


def test_change_points_compare_missing_times_and_values(spark):
    # a row without a time comes first, and a missing value is a value
    data = [("k", None, None, "x"), ("k", None, "A", "x"), ("k", ts(1), "A", "x"), ("k", ts(2), None, "y"), ("k", ts(2), None, "x"),
            ("k", ts(30), None, "x"), ("k", ts(31), "A", "x"), ("j", None, None, "x"), ("j", ts(1), None, "x")]
    df = spark.createDataFrame(data, "k string, load_ts timestamp_ntz, hd string, p string")
    got = rows(change_points(df, ["k"], ["load_ts"], "hd"))
    assert got == rows(spark.createDataFrame([data[i] for i in (0, 1, 4, 6, 7)], df.schema))


def test_change_points_shuffle_the_other_columns_once(spark):
    data = [("k", ts(h % 7), f"H{h % 3}", f"p{h}") for h in range(40)]
    df = spark.createDataFrame(data, "k string, load_ts timestamp_ntz, hd string, p string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = change_points(df, ["k"], ["load_ts"], "hd")
        assert rows(out) == brute_change_points([("k", *min(r[1:] for r in data if (r[1], r[2]) == key)) for key in
                                                 {(r[1], r[2]) for r in data}])
        plans = out._jdf.queryExecution()
        final, lines = plans.executedPlan().toString(), plans.optimizedPlan().toString().split("\n")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    dealt = [lines[i + 1] for i, line in enumerate(lines) if "RepartitionByExpression" in line]
    assert dealt and all("Project [k#" in line and " p#" not in line and "__pick" not in line for line in dealt)
    assert "ReusedExchange" in final.split("== Initial Plan ==")[0]


def test_change_points_send_hashes_as_bytes(spark):
    one, two = "0A" * 16, "F" * 32
    values = [one, two, one.lower(), one[:-1] + "G", one[:-2], one + "00", "", "H1"]
    data = [("k", ts(i // 3), values[(i * 5) % len(values)], f"p{i}") for i in range(60)] + [("j", ts(1), two, "x"), ("j", ts(2), two, "y")]
    df = spark.createDataFrame(data, "k string, load_ts timestamp_ntz, hd string, p string")
    out = change_points(df, ["k"], ["load_ts"], "hd")
    first = {}
    for r in data:
        first[r[:3]] = min(first.get(r[:3], r), r)
    assert rows(out) == brute_change_points(list(first.values()))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "unhex(hd#" in plan


def test_satellite_history_is_staged_once_for_its_two_readers(spark):
    """The history's rows and its change detection, which reads three columns of them, share their exchanges."""
    from vaultline.plans import catalog
    from .conftest import SF_SMALL
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = catalog.q_sat_compact(spark, SF_SMALL)
        out.collect()
        final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum("FileScan parquet [l_orderkey" in line for line in final.split("\n")) == 2  # of each delivery
