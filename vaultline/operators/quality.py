"""Declarative data-quality checks, evaluated as Spark aggregates.

Every check yields rows ``(table_name, column_name, test, failures, passed)``.
All ``not_null`` checks of one table are a single pass (one ``count_if`` per
column, partially aggregated), and so are its code-domain checks; ``unique`` is a grouped
count per key; orphan checks are ``left_anti`` joins.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RESULT_COLUMNS = ["table_name", "column_name", "test", "failures", "passed"]


def _result(df_one_row: DataFrame, table: str, column: str, test: str) -> DataFrame:
    return df_one_row.select(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"),
                             F.lit(test).alias("test"), F.col("failures").cast("long"),
                             (F.col("failures") == 0).alias("passed"))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """One aggregate over the table counting NULLs of every listed column."""
    cols = list(columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = counts.unpivot([], cols, "column_name", "failures")
    return long.select(F.lit(table).alias("table_name"), "column_name",
                       F.lit("not_null").alias("test"), F.col("failures").cast("long"),
                       (F.col("failures") == 0).alias("passed"))


def unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """Number of non-null key values that occur more than once."""
    dup = (df.select(column).filter(F.col(column).isNotNull())
             .groupBy(column).count().filter(F.col("count") > 1))
    return _result(dup.agg(F.count(F.lit(1)).alias("failures")), table, column, "unique")


def orphans(child: DataFrame, table: str, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-null foreign key has no parent row."""
    c = child.select(F.col(fk).alias("__k")).filter(F.col("__k").isNotNull())
    p = parent.select(F.col(pk).alias("__k"))
    bad = c.join(p, "__k", "left_anti")
    return _result(bad.agg(F.count(F.lit(1)).alias("failures")), table, fk, "relationships")


def accepted_values(df: DataFrame, table: str, codes: dict[str, Sequence[str]]) -> DataFrame:
    """Rows whose non-null code is not in the column's code list, for all listed columns of
    a table in one aggregate (the lists are a handful of fixed values)."""
    cols = list(codes)
    counts = df.agg(*[F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(list(codes[c]))).alias(c) for c in cols])
    long = counts.unpivot([], cols, "column_name", "failures")
    return long.select(F.lit(table).alias("table_name"), "column_name",
                       F.lit("accepted_values").alias("test"), F.col("failures").cast("long"),
                       (F.col("failures") == 0).alias("passed"))


@dataclass
class TableChecks:
    not_null: list[str] = field(default_factory=list)
    unique: list[str] = field(default_factory=list)


# The column tests of the raw vault (fixed list).
VAULT_CHECKS = {
    "hub_customer": TableChecks(["customer_hk", "customer_id", "load_ts", "record_source"],
                                ["customer_hk"]),
    "hub_customer_account": TableChecks(
        ["customer_account_hk", "customer_account_id", "load_ts", "record_source"],
        ["customer_account_hk"]),
    "hub_asset": TableChecks(["asset_hk", "asset_id", "load_ts", "record_source"], ["asset_hk"]),
    "link_customer_account": TableChecks(
        ["link_customer_account_hk", "customer_hk", "customer_account_hk", "load_ts",
         "record_source"], ["link_customer_account_hk"]),
    "link_account_asset": TableChecks(
        ["link_account_asset_hk", "customer_account_hk", "asset_hk", "load_ts",
         "record_source"], ["link_account_asset_hk"]),
    "sat_customer_details": TableChecks(
        ["customer_hk", "customer_hashdiff", "load_ts", "record_source"]),
    "sat_customer_acc_details": TableChecks(
        ["customer_account_hk", "customer_account_hashdiff", "load_ts", "record_source"]),
    "sat_asset_details": TableChecks(
        ["asset_hk", "asset_details_hashdiff", "load_ts", "record_source"]),
    "sat_asset_measurements": TableChecks(
        ["asset_hk", "reading_value", "interval_start", "load_ts", "record_source"]),
}


def check(df: DataFrame, table: str, not_null_cols: Sequence[str] = (),
          unique_cols: Sequence[str] = ()) -> DataFrame | None:
    parts = []
    if not_null_cols:
        parts.append(not_null(df, table, not_null_cols))
    parts += [unique(df, table, c) for c in unique_cols]
    return _union(parts) if parts else None


def not_null_and_unique(df: DataFrame, table: str, not_null_cols: Sequence[str],
                        key: str) -> DataFrame:
    """``not_null`` on several columns and ``unique`` on ``key`` in one pass: a
    grouped count per key (NULL counts of the other columns ride along, all
    fixed-width, partially aggregated), then one global sum."""
    others = [c for c in not_null_cols if c != key]
    g = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n"),
                            *[F.count_if(F.col(c).isNull()).alias(c) for c in others])
    zero = F.lit(0).cast("long")
    tot = g.agg(*[F.coalesce(F.sum(c), zero).alias(c) for c in others],
                F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("__n"))), zero).alias("__key"),
                F.count_if(F.col(key).isNotNull() & (F.col("__n") > 1)).alias("__dup"))
    cols = [c if c != key else "__key" for c in not_null_cols]
    nn = tot.select(*[F.col(c).cast("long").alias(n) for c, n in zip(cols, not_null_cols)]) \
        .unpivot([], list(not_null_cols), "column_name", "failures")
    nn = nn.select(F.lit(table).alias("table_name"), "column_name",
                   F.lit("not_null").alias("test"), F.col("failures").cast("long"),
                   (F.col("failures") == 0).alias("passed"))
    return nn.unionByName(_result(tot.select(F.col("__dup").alias("failures")), table, key,
                                  "unique"))


def run_checks(tables: dict[str, DataFrame], checks: dict[str, TableChecks] = VAULT_CHECKS,
               tests: Sequence[str] = ("not_null", "unique")) -> DataFrame:
    """All configured checks over the given tables, as one DataFrame. A table
    with both kinds of checks is read once."""
    parts = []
    for name, tc in checks.items():
        df = tables[name]
        both = "not_null" in tests and "unique" in tests and tc.not_null and tc.unique
        if both:
            parts.append(not_null_and_unique(df, name, tc.not_null, tc.unique[0]))
            parts += [unique(df, name, c) for c in tc.unique[1:]]
            continue
        if "not_null" in tests and tc.not_null:
            parts.append(not_null(df, name, tc.not_null))
        if "unique" in tests:
            parts += [unique(df, name, c) for c in tc.unique]
    return _union(parts)


# Integrity the source schema declares (primary keys, unique and NOT NULL columns),
# foreign keys and code domains (fixed lists).
SOURCE_CHECKS = {
    "customers": TableChecks(["installation_id", "customer_name", "customer_type",
                              "registration_date"], ["installation_id"]),
    "customer_accounts": TableChecks(["account_id", "installation_id", "account_number",
                                      "account_type", "account_opened_date"],
                                     ["account_id", "account_number"]),
    "assets": TableChecks(["asset_id", "account_id", "asset_serial_number", "asset_type",
                           "installation_date"], ["asset_id", "asset_serial_number"]),
    "readings": TableChecks(["id", "asset_id", "reading_value", "interval_start",
                             "interval_end", "creation_time", "reading_type",
                             "unit_of_measure"], ["id"]),
}
SOURCE_REFERENCES = (("customer_accounts", "installation_id", "customers", "installation_id"),
                     ("assets", "account_id", "customer_accounts", "account_id"),
                     ("readings", "asset_id", "assets", "asset_id"))
SOURCE_DOMAINS = (("assets", "asset_type", "ref_meter_type"),
                  ("readings", "reading_type", "ref_reading_type"),
                  ("readings", "quality_code", "ref_quality_code"),
                  ("customers", "status", "ref_status"),
                  ("customer_accounts", "status", "ref_status"),
                  ("assets", "status", "ref_status"),
                  ("readings", "status", "ref_status"))


def code_checks(sources: dict[str, DataFrame]) -> DataFrame:
    """Values outside the reference code lists, one pass per table."""
    from .references import REFERENCE_ROWS
    by_table: dict[str, dict[str, list[str]]] = {}
    for t, col, ref in SOURCE_DOMAINS:
        by_table.setdefault(t, {})[col] = [r[0] for r in REFERENCE_ROWS[ref][2]]
    return _union([accepted_values(sources[t], t, codes) for t, codes in by_table.items()])


def source_checks(sources: dict[str, DataFrame]) -> DataFrame:
    """Declared integrity of the four source tables: not-null and unique columns,
    orphaned foreign keys and values outside the reference code lists."""
    parts = [run_checks(sources, SOURCE_CHECKS)]
    parts += [orphans(sources[c], c, fk, sources[p], pk) for c, fk, p, pk in SOURCE_REFERENCES]
    parts.append(code_checks(sources))
    return _union(parts)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)`` for each table."""
    return _union([df.agg(F.count(F.lit(1)).alias("row_count"))
                     .select(F.lit(name).alias("table_name"), "row_count")
                   for name, df in tables.items()])


def raise_on_failure(results: DataFrame) -> None:
    """Fail the run if any check failed (the failing rows are bounded by the check list)."""
    failed = results.filter(~F.col("passed")).collect()
    if failed:
        lines = ", ".join(f"{r.table_name}.{r.column_name} {r.test}: {r.failures}" for r in failed)
        raise AssertionError(f"data quality checks failed: {lines}")
