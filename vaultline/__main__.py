"""Command line: ingest sources into the lake, build the vault, query the views.

    python -m vaultline ingest --config tables.json --kind parquet --source-root DIR --lake LAKE
    python -m vaultline ingest --config tables.json --kind jdbc --option url=... \\
        --option driver=... --source-schema meter_data --lake LAKE
    python -m vaultline build --lake LAKE --vault VAULT
    python -m vaultline check --vault VAULT --lake LAKE
    python -m vaultline sql --vault VAULT "SELECT ... FROM bv_customer_asset_hierarchy"

Runs on whatever master ``spark-submit`` / ``SPARK_*`` settings provide; the
local session is only a fallback.
"""

from __future__ import annotations

import argparse
import sys
from dataclasses import replace

from pyspark.sql import SparkSession

from .session import apply_conf


def _session() -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        return apply_conf(active)
    builder = SparkSession.builder.appName("vaultline")
    try:
        return apply_conf(builder.getOrCreate())
    except Exception:
        from .session import build_session
        return build_session()


def _options(pairs: list[str]) -> dict:
    out = {}
    for p in pairs or []:
        k, _, v = p.partition("=")
        out[k] = v
    return out


def _table_options(pairs: list[str]) -> dict[str, dict]:
    """``table:key=value`` settings by table."""
    out: dict[str, dict] = {}
    for p in pairs or []:
        name, colon, rest = p.partition(":")
        if not colon:
            raise ValueError(f"--table-option takes TABLE:KEY=VALUE, not {p!r}")
        out.setdefault(name, {}).update(_options([rest]))
    return out


def cmd_ingest(a) -> int:
    from .plans.ingest import ingest_all
    from .sources.schema import load_config, meter_tables
    from .sources.state import WatermarkStore
    spark = _session()
    tables = load_config(a.config) if a.config else list(meter_tables().values())
    if a.lookback_hours is not None:
        tables = [replace(t, lookback_hours=a.lookback_hours) for t in tables]
    base = _options(a.option)
    lake = a.lake.rstrip("/")

    by_table = _table_options(a.table_option)

    def options_for(t):
        """The run's options, over them those of the table's definition, and over those the command line's for it."""
        o = {**base, **dict(t.source_options), **by_table.get(t.name, {})}
        kind = t.source_kind or a.kind
        if kind == "jdbc":
            o.setdefault("dbtable", f"{a.source_schema}.{t.name}" if a.source_schema else t.name)
        elif kind == "table":
            o.setdefault("name", f"{a.source_schema}.{t.name}" if a.source_schema else t.name)
        elif kind != "sql":
            o.setdefault("path", f"{(a.source_root or '').rstrip('/')}/{t.name}")
        return o

    state = WatermarkStore(spark, a.state or f"{lake}/_load_state")
    status = ingest_all(spark, tables, a.kind, options_for, lambda t: f"{lake}/{t.name}", state,
                        raise_on_error=False, fail_on_null=a.fail_on_null)
    status.show(len(tables), truncate=False)
    return 1 if status.filter("error IS NOT NULL").count() else 0


def cmd_build(a) -> int:
    from .plans.build import run_build
    from .sources.fixtures import Sources
    spark = _session()
    lake = a.lake.rstrip("/")
    src = Sources(*(spark.read.parquet(f"{lake}/{n}")
                    for n in ("customers", "customer_accounts", "assets", "readings")))
    res = run_build(spark, src, a.vault, load_ts=a.load_ts, key_mode=a.key_mode,
                    dedup_sources=True, run_checks=not a.no_checks,
                    raise_on_check_failure=False, compact=a.compact,
                    lookback_hours=a.lookback_hours, catalog=a.catalog, buckets=a.buckets, key_sketch=a.key_sketch)
    for name, n in res.appended.items():
        print(f"{name}: +{n}")
    if res.checks is not None:
        res.checks.orderBy("table_name", "column_name", "test").show(res.checks.count(), truncate=False)
        return 1 if res.checks.filter("NOT passed").count() else 0
    return 0


def cmd_run(a) -> int:
    """The whole pipeline: later steps run only if the earlier ones succeeded."""
    return cmd_ingest(a) or cmd_build(a) or cmd_check(a)


def cmd_check(a) -> int:
    from pyspark.sql import functions as F

    from .operators import quality
    from .operators.staging import dedup_by_key
    from .plans.build import read_vault
    spark = _session()
    vault = quality.run_checks(read_vault(spark, a.vault).as_dict()) \
        .withColumn("scope", F.lit("vault"))
    report = vault
    if a.lake:
        lake = a.lake.rstrip("/")
        src = {n: spark.read.parquet(f"{lake}/{n}")
               for n in ("customers", "customer_accounts", "assets", "readings")}
        # the lake keeps row versions of the dimensions; judge the current ones
        for n, pk in (("customers", "installation_id"), ("customer_accounts", "account_id"),
                      ("assets", "asset_id")):
            src[n] = dedup_by_key(src[n], pk)
        report = report.unionByName(quality.source_checks(src)
                                    .withColumn("scope", F.lit("source")))
    report = report.persist()  # a few dozen rows, shown and counted
    report.orderBy("scope", "table_name", "column_name", "test").show(report.count(), truncate=False)
    failed = report.filter("scope = 'vault' AND NOT passed").count()
    report.unpersist()
    return 1 if failed else 0


def cmd_sql(a) -> int:
    from .plans.build import register_views
    spark = _session()
    register_views(spark, a.vault)
    out = spark.sql(a.query)
    if a.output:  # the whole answer, as files
        out.write.mode("errorifexists").format(a.format).save(a.output)
    else:
        out.show(a.limit, truncate=False)
    return 0


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="vaultline")
    sub = ap.add_subparsers(dest="cmd", required=True)
    i = sub.add_parser("ingest", help="load source tables into the raw lake")
    i.add_argument("--config", help="table config JSON (default: the four meter tables)")
    i.add_argument("--kind", default="parquet",
                   choices=["jdbc", "parquet", "csv", "json", "orc", "table"])
    i.add_argument("--option", action="append", help="reader option key=value")
    i.add_argument("--table-option", action="append", help="reader option of one table, TABLE:key=value")
    i.add_argument("--fail-on-null", action="store_true", help="NULLs in required columns fail the table's load")
    i.add_argument("--source-root", help="folder with one sub-folder per table (files)")
    i.add_argument("--source-schema", help="schema/namespace of the source tables")
    i.add_argument("--lake", required=True)
    i.add_argument("--state", help="watermark table path (default LAKE/_load_state)")
    i.add_argument("--lookback-hours", type=int, help="look this far behind the watermark for late rows")
    i.set_defaults(fn=cmd_ingest)
    b = sub.add_parser("build", help="stage, load the raw vault, run the checks")
    b.add_argument("--lake", required=True)
    b.add_argument("--vault", required=True)
    b.add_argument("--load-ts", help="fixed load time for reference tables")
    b.add_argument("--key-mode", default="natural", choices=["natural", "md5"])
    b.add_argument("--no-checks", action="store_true")
    b.add_argument("--compact", action="store_true", help="satellites keep change points only")
    b.add_argument("--catalog", help="store the tables in this namespace; VAULT keeps the build's own state")
    b.add_argument("--buckets", type=int, default=0, help="bucket catalog tables by their key")
    b.add_argument("--key-sketch", action="store_true", help="keep a filter of the measurements' keys")
    b.add_argument("--lookback-hours", type=int, help="stage only readings this far behind the newest")
    b.set_defaults(fn=cmd_build)
    r = sub.add_parser("run", help="ingest, build and check in one job")
    for p in (i, b):
        for arg in p._actions[1:]:
            if arg.option_strings[0] not in {x for y in r._actions for x in y.option_strings}:
                r._add_action(arg)
    r.set_defaults(fn=cmd_run)
    c = sub.add_parser("check", help="data-quality report: vault tests and source integrity")
    c.add_argument("--vault", required=True)
    c.add_argument("--lake", help="raw lake with the four source tables (source checks)")
    c.set_defaults(fn=cmd_check)
    q = sub.add_parser("sql", help="run SQL over the vault and business views")
    q.add_argument("--vault", required=True)
    q.add_argument("--limit", type=int, default=20, help="rows shown (not written)")
    q.add_argument("--output", help="write the whole result to this folder instead")
    q.add_argument("--format", default="parquet", choices=["parquet", "csv", "json", "orc"])
    q.add_argument("query")
    q.set_defaults(fn=cmd_sql)
    a = ap.parse_args(argv)
    return a.fn(a)


if __name__ == "__main__":
    sys.exit(main())
