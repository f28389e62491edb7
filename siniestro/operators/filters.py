"""Predicates.

Filters are folded into one Column so Catalyst can push the simple parts
(date range, IN-lists, damage range) into the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import _col, strip_ws

# --- fixed values ------------------------------------------------------------
BASE_DATE = "2000-01-01"          # current-mode guard on declaration dates
BBOX_LAT = (-55.0, -21.0)         # coordinates kept on the map
BBOX_LON = (-74.0, -53.0)
CURRENT, HISTORIC = "actual", "historico"
# -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Filters:
    """Global report filters (the dashboard sidebar).

    ``None`` / empty means "not chosen".  Resolution id 0 counts as unset.
    The damage range is always applied (T8: null damage never passes).
    """
    f_desde: str | None = None
    f_hasta: str | None = None
    id_resolucion: int | str | None = None
    departamentos: Sequence[str] = field(default_factory=tuple)
    anios: Sequence[int] = field(default_factory=tuple)
    origen_dato: str | None = None
    pondf_min: float = 0
    pondf_max: float = 100


def all_of(preds: Iterable[Column]) -> Column:
    preds = list(preds)
    return reduce(lambda a, b: a & b, preds) if preds else F.lit(True)


def date_range(c: Column | str, lo: str | None, hi: str | None, unified: bool = False) -> Column:
    """Inclusive date range.  With no range chosen the reference
    defaults to [min, max] of the guarded table, which is the same as
    ``fecha > 2000-01-01`` (current) or ``fecha IS NOT NULL`` (unified)."""
    c = _col(c)
    if lo is None and hi is None:
        return c.isNotNull() if unified else (c > F.lit(BASE_DATE).cast("date"))
    preds = []
    if lo is not None:
        preds.append(c >= F.lit(lo).cast("date"))
    if hi is not None:
        preds.append(c <= F.lit(hi).cast("date"))
    return all_of(preds)


def in_list(c: Column | str, values: Sequence | None) -> Column | None:
    """D3: IN-list, only when values were chosen."""
    return _col(c).isin(list(values)) if values else None


def damage_between(c: Column | str, lo: float, hi: float) -> Column:
    """Inclusive damage range; null damage is excluded."""
    return _col(c).between(F.lit(lo), F.lit(hi))


def apply_filters(df: DataFrame, f: Filters, unified: bool = False, resolution_pred: Column | None = None,
                  date_col: str = "fecha", damage_col: str = "pondf") -> DataFrame:
    """AND of every chosen filter part.

    ``resolution_pred`` lets the unified mode supply its own resolution test
    (a semi join is applied by the caller, E4); otherwise ``id_resolucion``
    equality is used.
    """
    preds = [date_range(date_col, f.f_desde, f.f_hasta, unified)]
    if f.id_resolucion and resolution_pred is None and not unified:
        preds.append(F.col("id_resolucion") == F.lit(f.id_resolucion))
    for p in (in_list("departamento", f.departamentos), in_list(F.year(date_col), f.anios)):
        if p is not None:
            preds.append(p)
    if unified and f.origen_dato:
        preds.append(F.col("origen_dato") == F.lit(f.origen_dato))
    preds.append(damage_between(damage_col, f.pondf_min, f.pondf_max))
    return df.filter(all_of(preds))


def non_blank(c: Column | str, fold_padding: bool = True) -> Column:
    """``col <> ''`` -- null is excluded too; MySQL ignores trailing
    spaces in the comparison, hence the right-trim."""
    c = _col(c)
    return (F.rtrim(c) != "") if fold_padding else (c != "")


def search(cols: Sequence[str], q: str | None) -> Column:
    """Case-insensitive contains over several columns; ``%``/``_`` typed
    by the user keep their LIKE meaning (not escaped)."""
    if not q:
        return F.lit(True)
    pattern = f"%{q}%"
    return reduce(lambda a, b: a | b, [F.col(c).ilike(pattern) for c in cols])


def not_blank_or_zero(c: Column | str) -> Column:
    """``NOT IN ('', '0')`` guard (null is excluded)."""
    return ~_col(c).isin("", "0")


def in_bbox(lat: Column | str, lon: Column | str) -> Column:
    """Repaired coordinates inside the province bounding box."""
    lat, lon = _col(lat), _col(lon)
    return (lat.isNotNull() & lon.isNotNull() & lat.between(*BBOX_LAT) & lon.between(*BBOX_LON))


def at_least(c: Column | str, minimum: float | None, null_as_zero: bool = False) -> Column:
    """Numeric threshold."""
    if minimum is None:
        return F.lit(True)
    c = _col(c)
    return (F.coalesce(c, F.lit(0)) if null_as_zero else c) >= F.lit(minimum)


def any_positive(*cols: Column | str) -> Column:
    """``HAVING coalesce(a,0) > 0 OR coalesce(b,0) > 0``."""
    return reduce(lambda a, b: a | b, [F.coalesce(_col(c), F.lit(0)) > 0 for c in cols])


def role_is(c: Column | str, *values: str) -> Column:
    """Role / relation filter; a null role never matches."""
    return F.coalesce(_col(c).isin(*values), F.lit(False))


def is_critical(c: Column | str) -> Column:
    """``LOWER(COALESCE(sev, '')) = 'critico'``."""
    return F.lower(F.coalesce(_col(c), F.lit(""))) == "critico"


__all__ = ["Filters", "apply_filters", "date_range", "in_list", "damage_between", "non_blank", "search",
           "not_blank_or_zero", "in_bbox", "at_least", "any_positive", "role_is", "is_critical", "all_of",
           "strip_ws", "CURRENT", "HISTORIC", "BASE_DATE"]
