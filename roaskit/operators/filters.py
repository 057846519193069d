"""Predicates (P4-P8, P11) written so Catalyst can push them into the scan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALL = "All"


def filter_dates(df: DataFrame, ts: str, lo, hi) -> DataFrame:
    """P5: inclusive range on the date part of ``ts``, written as a sargable
    half-open range ``lo <= ts < hi + 1 day`` so it prunes parquet row groups."""
    lo_d = dt.date.fromisoformat(str(lo)[:10])
    hi_d = dt.date.fromisoformat(str(hi)[:10]) + dt.timedelta(days=1)
    col = F.col(ts)
    lo_ts = F.to_timestamp_ntz(F.lit(f"{lo_d.isoformat()} 00:00:00"))
    hi_ts = F.to_timestamp_ntz(F.lit(f"{hi_d.isoformat()} 00:00:00"))
    return df.where((col >= lo_ts) & (col < hi_ts))


def filter_in(df: DataFrame, col: str, values) -> DataFrame:
    """Multi-select membership; choosing ``All`` adds no predicate."""
    values = list(values or [])
    if not values or ALL in values:
        return df
    return df.where(F.col(col).isin(values))


def matches(col: str, pattern: str, case_insensitive: bool = True, negate: bool = False) -> Column:
    """Regex predicate with NULL -> false (pandas ``str.contains(na=False)``)."""
    rx = f"(?i){pattern}" if case_insensitive else pattern
    m = F.coalesce(F.col(col).rlike(rx), F.lit(False))
    return ~m if negate else m


def drop_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Drop rows with NULL in any of ``keys``."""
    return df.dropna(subset=keys)
