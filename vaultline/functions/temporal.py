"""Timestamp helpers that keep zone-less (NTZ) columns zone-less."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _n(n: int | str | Column) -> Column:
    return n if isinstance(n, Column) else (F.col(n) if isinstance(n, str) else F.lit(n))


def add_minutes(ts: str | Column, n: int | str | Column) -> Column:
    """``ts + n * INTERVAL '1' MINUTE``."""
    return F.timestamp_add("MINUTE", _n(n), _col(ts))


def add_hours(ts: str | Column, n: int | str | Column) -> Column:
    return F.timestamp_add("HOUR", _n(n), _col(ts))


def add_days(ts: str | Column, n: int | str | Column) -> Column:
    return F.timestamp_add("DAY", _n(n), _col(ts))


def day_of(ts: str | Column) -> Column:
    """``DATE(ts)`` / the ``day(ts)`` partition transform."""
    return F.to_date(_col(ts))


def ntz_literal(value: str | dt.datetime) -> Column:
    """A zone-less timestamp literal."""
    if isinstance(value, dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.to_timestamp_ntz(F.lit(value))


def ntz_now() -> Column:
    """``current_timestamp`` as a zone-less value (session time zone wall clock)."""
    return F.localtimestamp()
