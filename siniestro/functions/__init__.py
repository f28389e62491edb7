"""Scalar functions: native Column expressions."""

from .dates import month_key, repair_zero_date, repair_zero_dates, resolve_year, year_start
from .misc import coalesce_event, ensure_columns, first_existing, stable_id
from .numeric import activity_rgb, add_percent, clean_numeric, damage_rgb, repair_coord, to_number
from .text import (build_period, clean_text, extract_decree, extract_year, fold_accents, is_unclassified,
                   norm_header, norm_staging_header, normalize_code, normalize_key, sanitize_value,
                   short_label, strip_ws)

__all__ = [n for n in dir() if not n.startswith("_")]
