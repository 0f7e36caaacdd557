import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from vaultline.functions.keys import hash_key, with_hash


def md5u(s: str) -> str:
    return hashlib.md5(s.encode("utf-8")).hexdigest().upper()


def test_single_column_has_no_separator(spark):
    df = spark.createDataFrame([("INST1",), (None,)], "k string")
    got = sorted(r.h for r in df.select(hash_key("k").alias("h")).collect())
    assert got == sorted([md5u("INST1"), md5u("")])


def test_multi_column_two_pipe_separator_and_null_as_empty(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None), (None, None)], "x string, y string")
    got = sorted(r.h for r in df.select(hash_key("x", "y").alias("h")).collect())
    assert got == sorted([md5u("a||b"), md5u("a||"), md5u("||")])


def test_null_and_empty_hash_alike(spark):
    df = spark.createDataFrame([("",), (None,)], "k string")
    assert len({r.h for r in df.select(hash_key("k").alias("h")).collect()}) == 1


def test_timestamp_renders_six_fraction_digits(spark):
    ts = dt.datetime(2025, 10, 1, 0, 0, 0)
    df = spark.createDataFrame([("s", ts)], "s string, t timestamp_ntz")
    got = with_hash(df, "h", ["s", "t"]).first().h
    assert got == md5u("s||2025-10-01 00:00:00.000000")


def test_integer_and_decimal_render_plainly(spark):
    df = spark.sql("select 42 as i, cast(1.5 as decimal(15,3)) as d")
    assert with_hash(df, "h", ["i", "d"]).first().h == md5u("42||1.500")


def test_float_columns_are_rejected(spark):
    df = spark.createDataFrame([(1.0,)], "f double")
    with pytest.raises(TypeError):
        with_hash(df, "h", ["f"])


def test_upper_case_hex(spark):
    df = spark.createDataFrame([("x",)], "k string")
    h = df.select(hash_key("k").alias("h")).first().h
    assert h == h.upper() and len(h) == 32


def test_hash_stays_in_jvm(spark):
    df = spark.createDataFrame([("x", "y")], "a string, b string")
    plan = df.select(hash_key("a", "b")).select(F.lit(1))._jdf.queryExecution().toString()
    assert "PythonUDF" not in plan
