"""Conditional / structural helpers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import _col


def first_existing(df: DataFrame, candidates: Iterable[str], data_type: str = "string") -> Column:
    """The first candidate *column present in the frame*.

    This is a plan-time choice over the header, not a per-row coalesce: if the
    first present candidate is null on a row, later candidates are ignored.
    """
    present = set(df.columns)
    for name in candidates:
        if name in present:
            return F.col(f"`{name}`")
    return F.lit(None).cast(data_type)


def ensure_columns(df: DataFrame, columns: Mapping[str, str] | Iterable[str]) -> DataFrame:
    """Add absent columns as typed nulls (string when no type is given)."""
    spec = dict(columns) if isinstance(columns, Mapping) else {c: "string" for c in columns}
    missing = [F.lit(None).cast(t).alias(c) for c, t in spec.items() if c not in df.columns]
    return df.select("*", *missing) if missing else df


def stable_id(*cols: Column | str) -> Column:
    """Deterministic surrogate id from natural keys.

    Every part is written with its length, a null part as ``~``: (a, null) and
    (null, a) have different ids.
    """
    def part(c: Column | str) -> Column:
        text = _col(c).cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("~"))

    return F.sha2(F.concat_ws("||", *[part(c) for c in cols]), 256)


def coalesce_event(mapped_event: Column | str, raw_event: Column | str, period: Column | str) -> Column:
    """C11: event id from the registry, else the row's own, else its period."""
    return F.coalesce(_col(mapped_event), _col(raw_event), _col(period))
