"""Staging: one wide row per reading with business keys, hash keys and hash diffs.

Join order matters at scale. Readings are the fact (largest by far); assets,
accounts and customers are dimensions. The inner joins are associative, so the
dimension chain is joined first (its size is bounded by the asset count) and the
fact is joined once, on ``asset_id``: one exchange of the wide fact instead of
three. Whether a side is broadcast is left to Spark's size-checked
auto-broadcast and to AQE, which re-plans with the measured sizes; a skewed
``asset_id`` is split by AQE's skew-join handling.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from ..functions.keys import hash_key
from ..functions.temporal import ntz_literal
from .asof import BEGIN, VALID_FROM, as_of_join, chained, timeline
from .window import latest_by

# Hash diff payloads and the default record source.
CUSTOMER_HASHDIFF = ["customer_name", "customer_type", "address", "city",
                     "postal_code", "country", "customer_status"]
ACCOUNT_HASHDIFF = ["account_number", "account_type", "billing_cycle", "account_status"]
ASSET_HASHDIFF = ["asset_serial_number", "asset_type", "manufacturer", "model",
                  "asset_installation_date", "asset_status"]
DEFAULT_RECORD_SOURCE = "METER_DATA_SYSTEM"
LOAD_ID = "load_id"  # of raw row versions: which load wrote them

STAGED_COLUMNS = [
    "customer_id", "customer_account_id", "asset_id",
    "customer_hk", "customer_account_hk", "asset_hk",
    "link_customer_account_hk", "link_account_asset_hk",
    "customer_hashdiff", "customer_account_hashdiff", "asset_details_hashdiff",
    "customer_name", "customer_type", "address", "city", "postal_code", "country",
    "registration_date", "customer_status",
    "account_number", "account_type", "billing_cycle", "account_opened_date",
    "account_closed_date", "account_status",
    "asset_serial_number", "asset_type", "manufacturer", "model",
    "asset_installation_date", "last_calibration_date", "next_calibration_date",
    "asset_status",
    "reading_id", "reading_value", "interval_start", "interval_end", "reading_type",
    "unit_of_measure", "quality_code", "reading_status",
    "load_ts", "record_source",
]


def dedup_by_key(df: DataFrame, key: str, changed_col: str = "last_modified") -> DataFrame:
    """Latest row per primary key (for raw tables that were appended to twice): the last
    load's where loads are numbered, else the last changed."""
    order = ([LOAD_ID] if LOAD_ID in df.columns else []) + [changed_col]
    return latest_by(df, [key], order)


def _named(assets: DataFrame, accounts: DataFrame, customers: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three dimensions with staging's names; ``valid_from`` is kept where it is there."""
    def extra(df: DataFrame) -> list[str]:
        return [VALID_FROM] if VALID_FROM in df.columns else []
    a = assets.select(
        *extra(assets),
        "asset_id", "account_id", "asset_serial_number", "asset_type", "manufacturer",
        "model", F.col("installation_date").alias("asset_installation_date"),
        "last_calibration_date", "next_calibration_date",
        F.col("status").alias("asset_status"))
    ca = accounts.select(
        *extra(accounts), "account_id", "installation_id", "account_number", "account_type", "billing_cycle",
        "account_opened_date", "account_closed_date", F.col("status").alias("account_status"))
    c = customers.select(
        *extra(customers), "installation_id", "customer_name", "customer_type", "address", "city",
        "postal_code", "country", "registration_date",
        F.col("status").alias("customer_status"))
    return a, ca, c


def dimension_chain(assets: DataFrame, accounts: DataFrame, customers: DataFrame) -> DataFrame:
    """assets x accounts x customers, renamed to staging names (one row per asset). Accounts meet their customers first, as
    they are fewer: an asset is then shuffled once on its way to its account, not once more to its customer."""
    a, ca, c = _named(assets, accounts, customers)
    return a.join(ca.join(c, "installation_id"), "account_id")


def _keys_and_hashes(chain: DataFrame, key_mode: str) -> DataFrame:
    """Hub keys, link keys and hash diffs, computed once per asset (they depend on
    dimension columns only), before the chain meets the fact."""
    s = chain.schema

    def hk(c):
        return F.col(c) if key_mode == "natural" else hash_key(c)

    return chain.select(
        "*",
        hk("installation_id").alias("customer_hk"),
        hk("account_id").alias("customer_account_hk"),
        hk("asset_id").alias("asset_hk"),
        hash_key("installation_id", "account_id").alias("link_customer_account_hk"),
        hash_key("account_id", "asset_id").alias("link_account_asset_hk"),
        hash_key(*CUSTOMER_HASHDIFF, schema=s).alias("customer_hashdiff"),
        hash_key(*ACCOUNT_HASHDIFF, schema=s).alias("customer_account_hashdiff"),
        hash_key(*ASSET_HASHDIFF, schema=s).alias("asset_details_hashdiff"))


def keyed_dimensions(assets: DataFrame, accounts: DataFrame, customers: DataFrame,
                     key_mode: str = "natural", dedup_sources: bool = False) -> DataFrame:
    """The dimension chain with its keys and hash diffs: one row per asset."""
    if key_mode not in ("natural", "md5"):
        raise ValueError(f"key_mode must be 'natural' or 'md5', not {key_mode!r}")
    if dedup_sources:
        assets = dedup_by_key(assets, "asset_id")
        accounts = dedup_by_key(accounts, "account_id")
        customers = dedup_by_key(customers, "installation_id")
    chain = dimension_chain(assets, accounts, customers)
    chain = chain.filter(F.col("installation_id").isNotNull()
                         & F.col("account_id").isNotNull()
                         & F.col("asset_id").isNotNull())
    return _keys_and_hashes(chain, key_mode)


_DIM_OUT = [c for c in STAGED_COLUMNS[:33]]  # everything before the reading columns
_HASHES = STAGED_COLUMNS[6:11]


def _hashes(key_mode: str) -> list[str]:
    return [*_HASHES, *(STAGED_COLUMNS[3:6] if key_mode == "md5" else [])]


def _sent(dims: DataFrame, key_mode: str) -> DataFrame:
    """The dimensions as they are shuffled to the fact: hashes as their 16 bytes, not as text of twice that, which does not compress."""
    return dims.withColumns({c: F.unhex(c) for c in _hashes(key_mode)})


def _staged_dimension_columns(hashes: Sequence[str] = ()) -> list:
    """Staging's columns of the dimensions; ``hashes`` are those that ``_sent`` has made bytes."""
    return [F.col("installation_id").alias("customer_id"),
            F.col("account_id").alias("customer_account_id"),
            *[F.hex(c).alias(c) if c in hashes else F.col(c) for c in _DIM_OUT[2:]]]


def _spans(readings: DataFrame) -> tuple[tuple[Column, Column], tuple[Column, Column]]:
    """Two pairs of expressions: a reading's interval as time spans (of its start from ``creation_time``, of its end from its
    start; where that is NULL, from what comes before it), and the same columns read back from these. Every value and NULL comes
    back as it was. Columns of other types are left as they are."""
    start, end = F.col("interval_start"), F.col("interval_end")
    types = {readings.schema[c].dataType for c in ("creation_time", "interval_start", "interval_end")}
    if types != {TimestampNTZType()}:
        return (start, end), (start, end)
    base = F.coalesce("creation_time", ntz_literal(BEGIN))
    began = base + start
    return (start - base, end - F.coalesce(start, base)), (began, F.coalesce(began, base) + end)


def stage_readings(readings: DataFrame, assets: DataFrame, accounts: DataFrame,
                   customers: DataFrame, key_mode: str = "natural",
                   dedup_sources: bool = False) -> DataFrame:
    """Readings enriched with their asset, account and customer (inner joins).

    ``key_mode="natural"`` uses the business keys as hub keys (what the models
    compute); ``"md5"`` hashes them. ``dedup_sources`` keeps the latest row per
    primary key of each dimension first (needed when raw tables hold re-loads).

    The fact is shuffled with its codes side by side and its interval as time spans (``_spans``), which compresses better.
    """
    dims = keyed_dimensions(assets, accounts, customers, key_mode, dedup_sources)
    (begin, length), (start, end) = _spans(readings)
    r = readings.select(
        "reading_type", "unit_of_measure", "quality_code", F.col("status").alias("reading_status"), "source_system",
        length.alias("interval_end"), begin.alias("interval_start"), "creation_time", "reading_value",
        F.col("id").alias("reading_id"), "asset_id")
    enriched = r.join(_sent(dims, key_mode), "asset_id")
    return enriched.select(
        *_staged_dimension_columns(_hashes(key_mode)),
        "reading_id", "reading_value", start.alias("interval_start"), end.alias("interval_end"), "reading_type",
        "unit_of_measure", "quality_code", "reading_status",
        F.col("creation_time").alias("load_ts"),
        F.coalesce(F.col("source_system"), F.lit(DEFAULT_RECORD_SOURCE)).alias("record_source"),
    )


CHANGE_TS = "change_ts"


def dimension_history(assets: DataFrame, accounts: DataFrame, customers: DataFrame, key_mode: str = "natural",
                      changed: str = "last_modified") -> DataFrame:
    """The versions of the dimension chain, with keys and hash diffs: per asset one row from each change of the
    asset, its account or its customer on (``valid_from``). The inputs hold row versions (a lake's tables, or
    snapshots put together); each key's first version counts from the beginning of time, as nothing earlier is known."""
    def versions(df: DataFrame, key: str) -> DataFrame:
        return timeline(df, key, changed, [LOAD_ID] if LOAD_ID in df.columns else [])
    a, ca, c = _named(versions(assets, "asset_id"), versions(accounts, "account_id"), versions(customers, "installation_id"))
    chain = chained(a, chained(ca, c, "account_id", "installation_id"), "asset_id", "account_id")
    return _keys_and_hashes(chain, key_mode)


def stage_as_of(readings: DataFrame, assets: DataFrame, accounts: DataFrame, customers: DataFrame,
                key_mode: str = "natural", changed: str = "last_modified", unit: str = "DAY") -> DataFrame:
    """``stage_readings`` true to history: each reading gets the asset, account and customer as they were at its
    ``creation_time``, so a later change leaves what is staged for earlier readings alone.

    ``change_ts`` tells since when that state has been in force (NULL: since the beginning). A reading before the first known
    version takes the first one, one without a time the current one; readings without asset, account or customer vanish, as in
    ``stage_readings``. The fact is shuffled twice: by asset and piece of time (``unit``) to find the version's time, and by
    asset and that time to meet the version, which is stored and sent once and not once for each piece. Only changes go
    into the sequence: a reading that none of them precedes has its asset's first version, in force since the beginning.
    Keys and hash diffs are worked out after that, from the version's columns, as they would be over half of what is sent of it.
    """
    if key_mode not in ("natural", "md5"):
        raise ValueError(f"key_mode must be 'natural' or 'md5', not {key_mode!r}")
    dims = dimension_history(assets, accounts, customers, key_mode, changed)
    (begin, length), (start, end) = _spans(readings)
    r = readings.filter(F.col("asset_id").isNotNull()).select(
        "reading_type", "unit_of_measure", "quality_code", F.col("status").alias("reading_status"), "source_system",
        length.alias("interval_end"), begin.alias("interval_start"), "creation_time", "reading_value",
        F.col("id").alias("reading_id"), "asset_id")
    # in the sequence a version is its time alone, as it is repeated for every piece with facts; its columns join afterwards
    changes = dims.select("asset_id", VALID_FROM).filter(F.col(VALID_FROM) > ntz_literal(BEGIN))
    found = as_of_join(r, changes, "asset_id", "creation_time", unit, how="left")
    found = found.withColumn(VALID_FROM, F.coalesce(VALID_FROM, ntz_literal(BEGIN)))
    plain = dims.select(*[c for c in dims.columns if c not in STAGED_COLUMNS[3:11]])
    out = _keys_and_hashes(found.join(plain, ["asset_id", VALID_FROM]), key_mode).select(
        *_staged_dimension_columns(), "reading_id", "reading_value", start.alias("interval_start"), end.alias("interval_end"),
        "reading_type", "unit_of_measure", "quality_code", "reading_status", F.col("creation_time").alias("load_ts"),
        F.coalesce(F.col("source_system"), F.lit(DEFAULT_RECORD_SOURCE)).alias("record_source"), VALID_FROM)
    since = F.when(F.col(VALID_FROM) > ntz_literal(BEGIN), F.col(VALID_FROM))
    return out.withColumn(CHANGE_TS, since).drop(VALID_FROM)


def stage_asset_span(readings: DataFrame, assets: DataFrame, accounts: DataFrame,
                     customers: DataFrame, key_mode: str = "natural",
                     dedup_sources: bool = False) -> DataFrame:
    """Staging at asset grain: one row per asset and record source that has
    readings, with the first and last ``load_ts`` of those readings
    (``first_load_ts``, ``last_load_ts``) and all dimension columns and hashes.

    Hubs and links keep each key's first-seen row and current-state lookups keep
    the last one. Both are a ``min``/``max`` over readings and decompose: the min
    per customer is the min over its assets' minima. So readings are reduced per
    (asset, record source) first, by a hash aggregate that combines map-side
    before any shuffle, and only that result meets the dimensions. NULL load
    times follow the struct ordering used by ``first_by`` (NULL first).
    """
    r = readings.filter(F.col("asset_id").isNotNull()).select(
        "asset_id", F.col("creation_time").alias("load_ts"),
        F.coalesce(F.col("source_system"), F.lit(DEFAULT_RECORD_SOURCE)).alias("record_source"))
    ts = F.col("load_ts")
    per_asset = r.groupBy("asset_id", "record_source").agg(
        F.when(F.max(ts.isNull()), F.lit(None).cast("timestamp_ntz")).otherwise(F.min(ts))
         .alias("first_load_ts"),
        F.max(ts).alias("last_load_ts"))
    dims = keyed_dimensions(assets, accounts, customers, key_mode, dedup_sources)
    return per_asset.join(_sent(dims, key_mode), "asset_id").select(
        *_staged_dimension_columns(_hashes(key_mode)), "first_load_ts", "last_load_ts", "record_source")


def seen_rows(span: DataFrame, seen: str = "first") -> DataFrame:
    """Asset-grain staging rows with ``load_ts`` = first or last load time. Fed to
    ``hub_rows``/``link_rows`` (first) or current-state lookups (last), it gives
    exactly what those return on the full reading-grain staging."""
    if seen not in ("first", "last"):
        raise ValueError("seen must be 'first' or 'last'")
    cols = [c for c in span.columns if c not in ("first_load_ts", "last_load_ts",
                                                 "record_source")]
    t = "first_load_ts" if seen == "first" else "last_load_ts"
    return span.select(*cols, F.col(t).alias("load_ts"), "record_source")


def stage_readings_only(readings: DataFrame) -> DataFrame:
    """Readings as vault input without their dimensions: enough for the asset hub
    and the measurement satellite (hub keys are the natural keys)."""
    return (readings.filter(F.col("asset_id").isNotNull())
            .select(F.col("asset_id").alias("asset_hk"), "asset_id",
                    F.col("id").alias("reading_id"), "reading_value", "interval_start",
                    "interval_end", "reading_type", "unit_of_measure", "quality_code",
                    F.col("status").alias("reading_status"),
                    F.col("creation_time").alias("load_ts"),
                    F.coalesce(F.col("source_system"), F.lit(DEFAULT_RECORD_SOURCE))
                     .alias("record_source")))
