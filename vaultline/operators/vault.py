"""Generic raw-vault loaders: hubs, links, satellites, measurement satellites.

Each ``*_rows`` function is pure: staged rows (and optionally the rows already in
the target) in, the rows to append out. ``existing=None`` is a first load.
Change detection is a ``left_anti`` join; the ``NOT IN`` of the models equals it
because keys are filtered to NOT NULL first, and ``left_anti`` is free to
shuffle instead of broadcasting the whole key set.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .window import change_points, first_by, latest_by

LOAD_TS = "load_ts"
RECORD_SOURCE = "record_source"
LOAD_DAY = "load_day"


def _not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df.filter(cond)


@dataclass(frozen=True)
class Hub:
    name: str
    hk: str
    bk: str

    @property
    def columns(self) -> list[str]:
        return [self.hk, self.bk, LOAD_TS, RECORD_SOURCE]


@dataclass(frozen=True)
class Link:
    name: str
    hk: str
    fks: tuple[str, ...]

    @property
    def columns(self) -> list[str]:
        return [self.hk, *self.fks, LOAD_TS, RECORD_SOURCE]


@dataclass(frozen=True)
class Satellite:
    name: str
    hk: str
    hashdiff: str
    payload: tuple[str, ...]

    @property
    def columns(self) -> list[str]:
        return [self.hk, self.hashdiff, *self.payload, LOAD_TS, RECORD_SOURCE]


@dataclass(frozen=True)
class Measurements:
    name: str
    hk: str
    payload: tuple[str, ...]
    key: tuple[str, ...]
    partition_by: tuple[str, ...] = field(default=(LOAD_DAY,))

    @property
    def columns(self) -> list[str]:
        return [self.hk, *self.payload, LOAD_TS, RECORD_SOURCE]


# The meter model as bindings of the generic loaders (fixed names).
HUB_CUSTOMER = Hub("hub_customer", "customer_hk", "customer_id")
HUB_CUSTOMER_ACCOUNT = Hub("hub_customer_account", "customer_account_hk", "customer_account_id")
HUB_ASSET = Hub("hub_asset", "asset_hk", "asset_id")
LINK_CUSTOMER_ACCOUNT = Link("link_customer_account", "link_customer_account_hk",
                             ("customer_hk", "customer_account_hk"))
LINK_ACCOUNT_ASSET = Link("link_account_asset", "link_account_asset_hk",
                          ("customer_account_hk", "asset_hk"))
SAT_CUSTOMER_DETAILS = Satellite(
    "sat_customer_details", "customer_hk", "customer_hashdiff",
    ("customer_id", "customer_name", "customer_type", "address", "city", "postal_code",
     "country", "registration_date", "customer_status"))
SAT_CUSTOMER_ACC_DETAILS = Satellite(
    "sat_customer_acc_details", "customer_account_hk", "customer_account_hashdiff",
    ("customer_account_id", "account_number", "account_type", "billing_cycle",
     "account_opened_date", "account_closed_date", "account_status"))
SAT_ASSET_DETAILS = Satellite(
    "sat_asset_details", "asset_hk", "asset_details_hashdiff",
    ("asset_id", "asset_serial_number", "asset_type", "manufacturer", "model",
     "asset_installation_date", "last_calibration_date", "next_calibration_date",
     "asset_status"))
SAT_ASSET_MEASUREMENTS = Measurements(
    "sat_asset_measurements", "asset_hk",
    ("reading_id", "reading_value", "interval_start", "interval_end", "reading_type",
     "unit_of_measure", "quality_code", "reading_status"),
    ("asset_hk", "interval_start", "interval_end", "reading_type", "load_ts"))

HUBS = (HUB_CUSTOMER, HUB_CUSTOMER_ACCOUNT, HUB_ASSET)
LINKS = (LINK_CUSTOMER_ACCOUNT, LINK_ACCOUNT_ASSET)
SATELLITES = (SAT_CUSTOMER_DETAILS, SAT_CUSTOMER_ACC_DETAILS, SAT_ASSET_DETAILS)


def hub_rows(staged: DataFrame, hub: Hub, existing: DataFrame | None = None, reduced: bool = False) -> DataFrame:
    """First-seen row per hub key (by load time, then record source); new keys only. ``reduced``: the staging is at
    asset grain (``seen_rows``), where a pass that collapses repeats first would shuffle all rows once more for little."""
    src = _not_null(staged.select(*hub.columns), [hub.hk])
    rows = first_by(src, [hub.hk], [LOAD_TS, RECORD_SOURCE], reduce_first=not reduced)
    if existing is not None:
        rows = rows.join(existing.select(hub.hk), hub.hk, "left_anti")
    return rows


def link_rows(staged: DataFrame, link: Link, existing: DataFrame | None = None, reduced: bool = False) -> DataFrame:
    """First-seen row per link key; new link keys only. ``reduced`` as for ``hub_rows``."""
    src = _not_null(staged.select(*link.columns), [link.hk, *link.fks])
    rows = first_by(src, [link.hk], [LOAD_TS, RECORD_SOURCE], reduce_first=not reduced)
    if existing is not None:
        rows = rows.join(existing.select(link.hk), link.hk, "left_anti")
    return rows


def latest_versions(existing: DataFrame, sat: Satellite) -> DataFrame:
    """(hk, hashdiff) of the latest stored version per key (ties: larger hashdiff)."""
    return latest_by(existing.select(sat.hk, LOAD_TS, sat.hashdiff), [sat.hk], [LOAD_TS],
                     reduce_first=True).select(sat.hk, sat.hashdiff)


def satellite_rows(staged: DataFrame, sat: Satellite, existing: DataFrame | None = None,
                   compact: bool = False, current: DataFrame | None = None) -> DataFrame:
    """Satellite rows to insert.

    First load: every staged row (one per reading, as the models do). Later
    loads: rows whose (hk, hashdiff) differs from the latest stored version.
    ``current`` may supply those latest (hk, hashdiff) pairs directly (a
    maintained one-row-per-key table) instead of deriving them from ``existing``.
    ``compact=True`` additionally keeps only change points of each key's history.
    """
    src = _not_null(staged.select(*sat.columns), [sat.hk])
    rows = src
    if current is not None:
        rows = src.join(current.select(sat.hk, sat.hashdiff), [sat.hk, sat.hashdiff], "left_anti")
    elif existing is not None:
        rows = src.join(latest_versions(existing, sat), [sat.hk, sat.hashdiff], "left_anti")
    if compact:
        rows = change_points(rows, [sat.hk], [LOAD_TS], sat.hashdiff)
    return rows


def merge_current(current: DataFrame | None, new_rows: DataFrame, sat: Satellite) -> DataFrame:
    """The one-row-per-key current-version table after appending ``new_rows``."""
    cols = [sat.hk, LOAD_TS, sat.hashdiff]
    parts = new_rows.select(*cols)
    if current is not None:
        parts = current.select(*cols).unionByName(parts)
    return latest_by(parts, [sat.hk], [LOAD_TS], reduce_first=True)


def compact_satellite(sat_table: DataFrame, sat: Satellite) -> DataFrame:
    """Keep only the rows where a key's hashdiff changes (first row of each run)."""
    return change_points(sat_table.select(*sat.columns), [sat.hk], [LOAD_TS], sat.hashdiff)


def measurement_rows(staged: DataFrame, m: Measurements = SAT_ASSET_MEASUREMENTS,
                     existing: DataFrame | None = None, prune_days: bool = False) -> DataFrame:
    """Measurement rows to insert: all on a first load, else unseen 5-part keys.

    When the stored target carries the ``load_day`` partition column it joins
    too (same ``load_ts`` implies same day, so the result is unchanged), and
    with ``prune_days`` the batch's days are computed first (as many values as it
    touches days) so only those partitions of the target are read, however late a
    row is. Spark's dynamic partition pruning does not apply to anti-joins, hence the literals.
    """
    src = _not_null(staged.select(*m.columns), [m.hk])
    if existing is None:
        return src
    keys = list(m.key)
    if LOAD_DAY in existing.columns:
        src = src.withColumn(LOAD_DAY, F.to_date(LOAD_TS))
        keys = keys + [LOAD_DAY]
        ex = existing
        if prune_days:
            days = [r[0] for r in src.select(LOAD_DAY).distinct().collect()]
            ex = ex.filter(F.col(LOAD_DAY).isin(days))
        return src.join(ex.select(*keys), keys, "left_anti").drop(LOAD_DAY)
    return src.join(existing.select(*keys), keys, "left_anti")


def with_load_day(df: DataFrame) -> DataFrame:
    """Derived ``day(load_ts)`` partition column for the measurement table."""
    return df.withColumn(LOAD_DAY, F.to_date(LOAD_TS))


def upsert_rows(target: DataFrame | None, source: DataFrame, keys: Sequence[str], settled: bool = False) -> DataFrame:
    """Merge semantics on ``keys``: source rows replace target rows with the same key.

    Source rows are first reduced to one per key (latest by ``load_ts`` where there is one, then by
    the remaining columns) because a real MERGE rejects duplicate source keys; a ``settled`` source has one row
    per key already. NULL keys match nothing, as in a MERGE condition.
    """
    keys = list(keys)
    columns = source.columns if target is None else target.columns
    order = [LOAD_TS] if LOAD_TS in columns and LOAD_TS not in keys else []
    src = source.select(*columns) if settled else latest_by(source.select(*columns), keys, order)
    if target is None:
        return src
    return target.join(src.select(*keys), keys, "left_anti").unionByName(src)


@dataclass
class VaultFrames:
    """The raw-vault tables of one build, as DataFrames.

    ``current_asset`` / ``current_customer`` optionally carry the latest version
    per key, precomputed; without them the business views derive it from the
    satellites.
    """
    hub_customer: DataFrame
    hub_customer_account: DataFrame
    hub_asset: DataFrame
    link_customer_account: DataFrame
    link_account_asset: DataFrame
    sat_customer_details: DataFrame
    sat_customer_acc_details: DataFrame
    sat_asset_details: DataFrame
    sat_asset_measurements: DataFrame
    current_asset: DataFrame | None = None
    current_customer: DataFrame | None = None

    def as_dict(self) -> dict[str, DataFrame]:
        return {k: v for k, v in self.__dict__.items() if not k.startswith("current_")}


def build_vault(staged: DataFrame, existing: dict[str, DataFrame] | None = None,
                first_seen: DataFrame | None = None) -> VaultFrames:
    """All nine raw-vault loads over one staged input (lazy; rows to append).

    ``first_seen`` (asset-grain staging, see ``stage_asset_span``) feeds the hub and
    link loads when given; they then never touch the reading-grain rows.
    """
    ex = existing or {}
    keyed = first_seen if first_seen is not None else staged
    out = {}
    for h in HUBS:
        out[h.name] = hub_rows(keyed, h, ex.get(h.name))
    for ln in LINKS:
        out[ln.name] = link_rows(keyed, ln, ex.get(ln.name))
    for s in SATELLITES:
        out[s.name] = satellite_rows(staged, s, ex.get(s.name))
    out[SAT_ASSET_MEASUREMENTS.name] = measurement_rows(
        staged, SAT_ASSET_MEASUREMENTS, ex.get(SAT_ASSET_MEASUREMENTS.name))
    return VaultFrames(**out)
