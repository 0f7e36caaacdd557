"""Registration by listing, splits of equal depth, per-table source options, required columns."""

import glob
import json
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from vaultline.__main__ import _table_options, main
from vaultline.plans import ingest as ingests
from vaultline.plans.ingest import ingest, ingest_all, listed_files, register_new_files
from vaultline.sources.readers import equal_depth_predicates
from vaultline.sources.schema import FieldDef, TableDef, parse_tables, to_config


def land(spark, path, first, n=5):
    spark.range(first, first + n).coalesce(1).write.mode("append").parquet(path)


@pytest.mark.parametrize("overlap", [None, 1])
def test_a_second_run_opens_new_files_only(spark, tmp_path, overlap):
    landing, target = str(tmp_path / "a folder"), str(tmp_path / "target")
    schema = spark.range(1).schema
    land(spark, landing, 0)
    assert register_new_files(spark, landing, schema, target, overlap_hours=overlap) == 5
    for f in glob.glob(f"{landing}/part-*"):  # the old file cannot be read any more; it is not asked for
        with open(f, "r+b") as fh:
            fh.write(b"damaged")
    assert register_new_files(spark, landing, schema, target, overlap_hours=overlap) == 0
    land(spark, landing, 5)
    assert register_new_files(spark, landing, schema, target, overlap_hours=overlap) == 5
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == list(range(10))
    manifest = ingests.registered_files(spark, target)
    assert manifest.count() == 2 and manifest.filter("modified_at IS NULL").isEmpty()


def test_the_whole_listing_finds_files_that_kept_their_time(spark, tmp_path):
    landing, target = str(tmp_path / "landing"), str(tmp_path / "target")
    land(spark, landing, 0)
    register_new_files(spark, landing, spark.range(1).schema, target)
    old = set(glob.glob(f"{landing}/part-*"))
    land(spark, landing, 5)
    (copied,) = set(glob.glob(f"{landing}/part-*")) - old
    os.utime(copied, (1_000_000_000, 1_000_000_000))
    assert listed_files(spark, landing).count() == 2
    assert register_new_files(spark, landing, spark.range(1).schema, target, overlap_hours=1) == 0  # the stated limit
    assert register_new_files(spark, landing, spark.range(1).schema, target) == 5


def test_a_manifest_of_an_earlier_version_is_still_read(spark, tmp_path):
    landing, target = str(tmp_path / "landing"), str(tmp_path / "target")
    land(spark, landing, 0)
    files = listed_files(spark, landing).select("file_path", F.localtimestamp().alias("registered_at"))
    files.write.parquet(ingests.manifest_path(target))
    assert register_new_files(spark, landing, spark.range(1).schema, target, overlap_hours=1) == 0


def test_splits_of_equal_depth_take_every_row_once_and_are_bounded(spark):
    rng = random.Random(7)
    skewed = [int(1.02 ** rng.uniform(0, 900)) for _ in range(8000)] + [5] * 900 + [None] * 100  # equal width: nearly all in one
    df = spark.createDataFrame([(v,) for v in skewed], "k long")
    cuts = equal_depth_predicates(df, "k", 8)
    sizes = [df.filter(c).count() for c in cuts]
    assert sum(sizes) == len(skewed) and sizes[-1] == 100
    frequent = Counter(skewed).most_common(1)[0][1]
    assert max(sizes) <= 8900 / 8 + frequent + 10 and len(cuts) <= 9
    lo, hi = min(x for x in skewed if x), max(x for x in skewed if x)
    width = max(df.filter((F.col("k") - lo >= (hi - lo) * i / 8) & (F.col("k") - lo <= (hi - lo) * (i + 1) / 8)).count() for i in range(8))
    assert width > 3 * max(sizes)
    for empty in (df.limit(0), df.filter("k IS NULL")):
        assert equal_depth_predicates(empty, "k", 8) == ["k IS NOT NULL", "k IS NULL"]
    assert len(equal_depth_predicates(df, "k", 1)) == 2


def test_source_options_of_a_table_go_round_the_config_and_the_command_line(spark, tmp_path, capsys):
    spark.createDataFrame([(1, "a"), (2, None)], "id int, v string").write.option("header", "true").csv(str(tmp_path / "elsewhere"))
    config = {"tables": [{"name": "t", "fields": [{"name": "id", "type": "integer"}, {"name": "v", "type": "string", "required": True}],
                          "source_kind": "csv", "source_options": {"path": str(tmp_path / "nowhere"), "header": "true"}}]}
    (t,) = parse_tables(config)
    assert t.source_kind == "csv" and parse_tables(to_config([t])) == [t]
    assert _table_options(["t:path=/x=y", "t:sep=;", "u:a=b"]) == {"t": {"path": "/x=y", "sep": ";"}, "u": {"a": "b"}}
    with pytest.raises(ValueError):
        _table_options(["path=/x"])
    (tmp_path / "c.json").write_text(json.dumps(config))
    run = ["ingest", "--config", str(tmp_path / "c.json"), "--lake", str(tmp_path / "lake"), "--table-option", f"t:path={tmp_path}/elsewhere"]
    assert main(run) == 0
    assert spark.read.parquet(str(tmp_path / "lake/t")).count() == 2
    assert main([*run, "--fail-on-null"]) == 1
    assert "1 NULLs in required columns" in capsys.readouterr().out.replace("  ", " ")


def test_nulls_in_required_columns_fail_the_table_that_has_them(spark, tmp_path):
    good = TableDef("good", (FieldDef("id", "integer", required=True),))
    bad = TableDef("bad", (FieldDef("id", "integer", required=True),))
    spark.createDataFrame([(1,), (None,)], "id int").write.parquet(str(tmp_path / "bad"))
    spark.createDataFrame([(1,)], "id int").write.parquet(str(tmp_path / "good"))

    def run(**k):
        return ingest_all(spark, [bad, good], "parquet", lambda t: {"path": str(tmp_path / t.name)},
                          lambda t: str(tmp_path / "lake" / t.name), **k)
    with pytest.raises(RuntimeError, match="bad .1 NULLs"):
        run(fail_on_null=True)
    status = {r.table_name: (r.rows, r.error is None) for r in run(fail_on_null=True, raise_on_error=False).collect()}
    assert status == {"bad": (2, False), "good": (1, True)}
    assert run().filter("error IS NOT NULL").isEmpty()
    assert ingest(spark, bad, "parquet", {"path": str(tmp_path / "bad")}, str(tmp_path / "x")).null_required == 1
