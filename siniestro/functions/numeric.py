"""Numeric functions (C2, C10, C13, C14, C23, C24) as native Column expressions.

ANSI mode is on by default in Spark 4, so every string->number conversion is
a ``try_cast``: a bad value becomes null instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import JOINT, WS, _col, let, strip_ws

# --- fixed values ------------------------------------------------------------
COORD_NULL_TOKENS = ("", "0", "0.0", "NULL")
COORD_LIMIT = 180.0
DAMAGE_GREEN = 80
ACTIVITY_PALETTE = {
    "AG - AGRICULTURA": (76, 175, 80),
    "GA - GANADERIA": (255, 152, 0),
    "BM - BOSQ./MONTES": (33, 150, 243),
}
ACTIVITY_DEFAULT_RGB = (158, 158, 158)
# -----------------------------------------------------------------------------


# Spellings that Java reads as numbers and the source system does not: a type
# suffix (27d, 1.5F) and hexadecimal digits (0x1p3).
JAVA_ONLY_NUMBER = r"[0-9.][dDfF]\s*$|[xX]"


def try_double(c: Column | str) -> Column:
    text = _col(c).cast("string")
    return F.when(~text.rlike(JAVA_ONLY_NUMBER), text.try_cast("double"))


def to_number(c: Column | str) -> Column:
    """Numeric coercion, anything unparsable -> null."""
    return try_double(c)


def numeric_chars(c: Column | str) -> Column:
    """C2, first step: keep only digits, ``,``, ``.`` and ``-``."""
    return F.regexp_replace(_col(c).cast("string"), "[^0-9,.\\-]", "")


def numeric_chars_joined(text: Column) -> Column:
    """C2, first step, on cells that ``join_cells`` made one text."""
    return F.regexp_replace(text, f"[^0-9,.\\-{JOINT}]+", "")


def parse_numeric_chars(s: Column) -> Column:
    """C2, second step, on the output of ``numeric_chars``."""
    has_comma = F.instr(s, ",") > 0
    has_dot = F.instr(s, ".") > 0
    normalised = (
        F.when(has_comma & has_dot,
               F.when(s.rlike(",[^.]*$"), F.replace(F.replace(s, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
                .otherwise(F.replace(s, F.lit(","), F.lit(""))))
        .when(has_comma, F.replace(s, F.lit(","), F.lit(".")))
        .otherwise(s))
    # no letter is left that only Java would read as part of a number
    return F.when(s.isNull() | s.isin("", "-", ".", ","), F.lit(None).cast("double")).otherwise(normalised.try_cast("double"))


def clean_numeric(c: Column | str) -> Column:
    """Locale-tolerant number.

    Keep only digits, ``,``, ``.``, ``-``.  With both separators the later one
    is the decimal mark; a lone comma is decimal; dots alone stay as they are.
    ``1.234`` -> 1.234, ``1.234,5`` -> 1234.5, ``1,2,3`` -> null, ``1e5`` -> 15.
    """
    return parse_numeric_chars(numeric_chars(c))


def add_percent(num: Column | str, den: Column | str) -> Column:
    """``num / den * 100`` with a guarded denominator (null or <= 0 -> 0.0)."""
    num, den = _col(num), _col(den)
    return (F.when(F.coalesce(den, F.lit(0)) > 0, F.coalesce(num, F.lit(0)) / den * 100.0)
            .otherwise(F.lit(0.0)))


def repair_coord(c: Column | str) -> Column:
    """C14: coordinates stored as text that lost their decimal point.

    Blank/0/NULL -> null; a parsable value in [-180, 180] other than 0 is kept;
    otherwise the first two digits become the integer part (sign kept) and the
    result must fall back in range.  ``-2769864082`` -> -27.69864082.
    """
    in_range = lambda x: (x >= -COORD_LIMIT) & (x <= COORD_LIMIT)

    def with_text(s: Column) -> Column:
        digits = F.regexp_replace(F.regexp_replace(s, "^-+", ""), "\\.", "")
        sign = F.when(s.startswith("-"), F.lit(-1.0)).otherwise(F.lit(1.0))
        fixed = sign * try_double(F.regexp_replace(digits, "^(..)", "$1."))
        repaired = let(F.struct(fixed.alias("f"), F.length(digits).alias("n")),
                       lambda r: F.when((r["n"] >= 3) & in_range(r["f"]), r["f"]))
        return let(try_double(s), lambda v: (
            F.when(s.isNull() | s.isin(*COORD_NULL_TOKENS) | v.isNull(), F.lit(None).cast("double"))
             .when(in_range(v) & (v != 0), v)
             .otherwise(repaired)))

    return let(strip_ws(_col(c).cast("string")), with_text)


def damage_rgb(c: Column | str) -> tuple[Column, Column, Column]:
    """Red grows with damage %, fixed green, blue = 255 - red."""
    p = F.coalesce(try_double(c), F.lit(0.0))
    r = F.floor(F.least(F.greatest(p, F.lit(0.0)), F.lit(100.0)) / 100.0 * 255.0).cast("int")
    g = F.lit(DAMAGE_GREEN)
    b = F.least(F.greatest(F.lit(255) - r, F.lit(0)), F.lit(255))
    return r, g, b


def activity_rgb(c: Column | str) -> tuple[Column, Column, Column]:
    """Three-entry activity palette with a grey default."""
    c = _col(c)
    out = []
    for i in range(3):
        expr = F.lit(ACTIVITY_DEFAULT_RGB[i])
        for name, rgb in ACTIVITY_PALETTE.items():
            expr = F.when(c == name, F.lit(rgb[i])).otherwise(expr)
        out.append(expr)
    return tuple(out)


def round_half_up(c: Column | str, digits: int) -> Column:
    """SQL ROUND (half away from zero)."""
    return F.round(_col(c), digits)


__all__ = ["WS", "to_number", "clean_numeric", "add_percent", "repair_coord", "damage_rgb",
           "activity_rgb", "round_half_up", "try_double"]
