"""Declared table definitions: config dict/JSON -> TableDef -> Spark StructType.

Schemas are fixed and declared, never inferred. ``required`` is kept as a
checked expectation (a ``not_null`` data-quality test) rather than a type
constraint, because file sources make every column nullable on read.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import Any

from pyspark.sql import types as T

DEFAULT_PRECISION = 15
DEFAULT_SCALE = 3

_SIMPLE = {
    "string": T.StringType(),
    "integer": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    # the source timestamps carry no zone
    "timestamp": T.TimestampNTZType(),
}
FIELD_TYPES = tuple(_SIMPLE) + ("decimal",)


@dataclass(frozen=True)
class FieldDef:
    name: str
    type: str
    precision: int | None = None
    scale: int | None = None
    required: bool = False
    default: Any = None

    def __post_init__(self):
        if self.type not in FIELD_TYPES:
            raise ValueError(f"unknown field type {self.type!r} for {self.name!r}; "
                             f"expected one of {FIELD_TYPES}")

    def spark_type(self) -> T.DataType:
        if self.type == "decimal":
            p = DEFAULT_PRECISION if self.precision is None else self.precision
            s = DEFAULT_SCALE if self.scale is None else self.scale
            return T.DecimalType(p, s)
        return _SIMPLE[self.type]


@dataclass(frozen=True)
class TableDef:
    name: str
    fields: tuple[FieldDef, ...]
    source_query: str | None = None
    partition_field: str | None = None
    is_incremental: bool = False
    incremental_field: str | None = None
    primary_key: str | None = None
    lookback_hours: int = 0  # how far behind the watermark late rows are looked for
    dedup_keys: tuple[str, ...] = ()  # what makes a row the same row (default: all columns)
    source_kind: str | None = None  # the reader of this table, if not the run's
    source_options: tuple[tuple[str, str], ...] = ()  # of its reader, over the run's own

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.fields if f.required]

    def field(self, name: str) -> FieldDef:
        for f in self.fields:
            if f.name == name:
                return f
        raise KeyError(name)


def to_struct(table: TableDef) -> T.StructType:
    """Declared types -> StructType (every column nullable, as in the lake)."""
    return T.StructType([T.StructField(f.name, f.spark_type(), True) for f in table.fields])


def parse_tables(config: dict | str) -> list[TableDef]:
    """Config (dict or JSON text) -> table definitions, with defaults filled in."""
    if isinstance(config, str):
        config = json.loads(config)
    tables = []
    for t in config.get("tables", []):
        fields = tuple(FieldDef(name=f["name"], type=f["type"], precision=f.get("precision"),
                                scale=f.get("scale"), required=bool(f.get("required", False)),
                                default=f.get("default"))
                       for f in t.get("fields", []))
        if not fields:
            raise ValueError(f"table {t.get('name')!r} declares no fields")
        inc = bool(t.get("is_incremental", False))
        if inc and not t.get("incremental_field"):
            raise ValueError(f"table {t['name']!r} is incremental but names no incremental_field")
        tables.append(TableDef(name=t["name"], fields=fields, source_query=t.get("source_query"),
                               partition_field=t.get("partition_field"), is_incremental=inc,
                               incremental_field=t.get("incremental_field"),
                               primary_key=t.get("primary_key"),
                               lookback_hours=int(t.get("lookback_hours") or 0),
                               dedup_keys=tuple(t.get("dedup_keys") or ()), source_kind=t.get("source_kind"),
                               source_options=tuple((k, str(v)) for k, v in (t.get("source_options") or {}).items())))
    return tables


def load_config(path: str) -> list[TableDef]:
    with open(path, encoding="utf-8") as fh:
        return parse_tables(json.load(fh))


def _f(name, type_, **kw):
    return FieldDef(name, type_, **kw)


# Built-in definitions of the four operational tables (fixed list), with the
# column defaults of the source DDL.
METER_TABLES: tuple[TableDef, ...] = (
    TableDef("customers", (
        _f("installation_id", "string", required=True), _f("customer_name", "string"),
        _f("customer_type", "string"), _f("address", "string"), _f("city", "string"),
        _f("postal_code", "string"), _f("country", "string", default="USA"),
        _f("registration_date", "timestamp"), _f("last_modified", "timestamp"),
        _f("status", "string", default="ACTIVE")), primary_key="installation_id"),
    TableDef("customer_accounts", (
        _f("account_id", "string", required=True), _f("installation_id", "string"),
        _f("account_number", "string"), _f("account_type", "string"),
        _f("billing_cycle", "string"), _f("account_opened_date", "timestamp"),
        _f("account_closed_date", "timestamp"), _f("last_modified", "timestamp"),
        _f("status", "string", default="ACTIVE")), primary_key="account_id"),
    TableDef("assets", (
        _f("asset_id", "string", required=True), _f("account_id", "string"),
        _f("asset_serial_number", "string"), _f("asset_type", "string"),
        _f("manufacturer", "string"), _f("model", "string"),
        _f("installation_date", "timestamp"), _f("last_calibration_date", "timestamp"),
        _f("next_calibration_date", "timestamp"), _f("last_modified", "timestamp"),
        _f("status", "string", default="ACTIVE")), primary_key="asset_id"),
    TableDef("readings", (
        _f("id", "integer"), _f("asset_id", "string"),
        _f("reading_value", "decimal", precision=15, scale=3),
        _f("interval_start", "timestamp"), _f("interval_end", "timestamp"),
        _f("creation_time", "timestamp"), _f("reading_type", "string"),
        _f("unit_of_measure", "string"), _f("quality_code", "string"),
        _f("status", "string", default="VALID"),
        _f("source_system", "string", default="METER_SYSTEM")),
        is_incremental=True, incremental_field="creation_time"),
)


def meter_tables() -> dict[str, TableDef]:
    return {t.name: t for t in METER_TABLES}


def to_config(tables) -> dict:
    """TableDefs -> config dict (the inverse of ``parse_tables``)."""
    out = []
    for t in tables:
        d: dict[str, Any] = {"name": t.name, "fields": []}
        for f in t.fields:
            fd: dict[str, Any] = {"name": f.name, "type": f.type}
            if f.precision is not None:
                fd["precision"] = f.precision
            if f.scale is not None:
                fd["scale"] = f.scale
            if f.required:
                fd["required"] = True
            if f.default is not None:
                fd["default"] = f.default
            d["fields"].append(fd)
        for k in ("source_query", "partition_field", "incremental_field", "primary_key"):
            if getattr(t, k):
                d[k] = getattr(t, k)
        if t.is_incremental:
            d["is_incremental"] = True
        if t.lookback_hours:
            d["lookback_hours"] = t.lookback_hours
        if t.dedup_keys:
            d["dedup_keys"] = list(t.dedup_keys)
        if t.source_kind:
            d["source_kind"] = t.source_kind
        if t.source_options:
            d["source_options"] = dict(t.source_options)
        out.append(d)
    return {"tables": out}
