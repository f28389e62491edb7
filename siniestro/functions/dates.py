"""Date functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .text import _col, extract_year, year_of, year_text

# --- fixed values ------------------------------------------------------------
ZERO_DATE_REPLACEMENTS = {
    "0000-00-00": "1970-01-01",
    "0000-00-00 00:00:00": "1970-01-01 00:00:00",
}
# -----------------------------------------------------------------------------


def repair_zero_date(c: Column | str) -> Column:
    """MySQL zero dates (which Spark cannot represent) -> 1970-01-01."""
    c = _col(c)
    out = c
    for bad, good in ZERO_DATE_REPLACEMENTS.items():
        out = F.when(c == bad, F.lit(good)).otherwise(out)
    return out


def repair_zero_dates(df: DataFrame) -> DataFrame:
    """C19 over every string column of a frame (applied before ``to_date``)."""
    return df.select(*[repair_zero_date(f.name).alias(f.name) if isinstance(f.dataType, StringType)
                       else F.col(f.name) for f in df.schema.fields])


def month_key(c: Column | str) -> Column:
    """C20: ``yyyy-MM`` month key (MySQL ``DATE_FORMAT(d, '%Y-%m')``)."""
    return F.date_format(_col(c), "yyyy-MM")


def year_start(c: Column | str) -> Column:
    """Historical rows carry only a year: date = 1 January of it."""
    return F.make_date(_col(c).cast("int"), F.lit(1), F.lit(1))


def resolved_year_text(start_year: Column | str, event_id: Column | str, source_file: Column | str,
                       parsed_year: Column | str) -> Column:
    """C12, first step: the year as text, empty if there is none."""
    return year_text(F.coalesce(_col(start_year).cast("string"), extract_year(event_id).cast("string"),
                                extract_year(source_file).cast("string"), _col(parsed_year).cast("string")))


def resolve_year(start_year: Column | str, event_id: Column | str, source_file: Column | str,
                 parsed_year: Column | str) -> Column:
    """Registry start year, else a year inside the event id, else one in
    the file name, else the parsed year; the result is re-read as a year."""
    return year_of(resolved_year_text(start_year, event_id, source_file, parsed_year))
