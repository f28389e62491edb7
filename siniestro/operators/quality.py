"""Quality rules (K1-K13) as Column expressions over the harmonised table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.misc import ensure_columns
from ..functions.dates import resolved_year_text
from ..functions.text import build_period, year_of
from ..schema import OUTPUT_COLUMNS, OUTPUT_TYPES, SURFACE_COLUMNS

# --- fixed values ------------------------------------------------------------
YEAR_MIN, YEAR_MAX = 1998, 2019
SEVERITY_LEVELS = ["ok", "estructural", "medio", "alto", "critico"]   # ascending
REVIEW_LEVELS = ("critico", "alto", "medio")
ERROR_PAIRS = [  # (affected, base, label)
    ("superficie_agricola_afectada", "superficie_agricola_uso", "afectada_agricola_mayor_uso"),
    ("superficie_ganadera_afectada", "superficie_ganadera_uso", "afectada_ganadera_mayor_uso"),
    ("superficie_agricola_afectada", "superficie_total", "afectada_agricola_mayor_total"),
    ("superficie_ganadera_afectada", "superficie_total", "afectada_ganadera_mayor_total"),
]
REQUIRED_FIELDS = ["anio", "productor_nombre", "departamento"]
# -----------------------------------------------------------------------------


def _gt(a: str, b: str) -> Column:
    return F.coalesce(F.col(a) > F.col(b), F.lit(False))


def flag_year_range(lo: int = YEAR_MIN, hi: int = YEAR_MAX) -> Column:
    """K1: year missing or outside [lo, hi]."""
    return F.col("anio").isNull() | (F.col("anio") < lo) | (F.col("anio") > hi)


def flag_negative_area() -> Column:
    """K2: any of the five surfaces below zero."""
    return reduce(lambda a, b: a | b, [F.coalesce(F.col(c) < 0, F.lit(False)) for c in SURFACE_COLUMNS])


def flag_agri_over_use() -> Column:
    """K3: agricultural affected > use (both present)."""
    return _gt("superficie_agricola_afectada", "superficie_agricola_uso")


def flag_livestock_over_use() -> Column:
    """K4: livestock affected > use (both present)."""
    return _gt("superficie_ganadera_afectada", "superficie_ganadera_uso")


def flag_deaths_over_stock() -> Column:
    """K5: deaths > stock (both present)."""
    return _gt("mortandad", "existencias")


def flag_total_under_affected() -> Column:
    """K6: total surface below the sum of affected surfaces (nulls as 0, sum > 0)."""
    s = F.coalesce(F.col("superficie_agricola_afectada"), F.lit(0.0)) + F.coalesce(F.col("superficie_ganadera_afectada"), F.lit(0.0))
    return F.col("superficie_total").isNotNull() & (s > 0) & F.coalesce(F.col("superficie_total") < s, F.lit(False))


def severity(role: Column | None = None) -> Column:
    """K8: most severe level, written in descending order (same result as
    the reference's last-write-wins ascending assignments, T9)."""
    role = F.col("dataset_role") if role is None else role
    principal = F.coalesce(role == "principal", F.lit(False))
    detail = F.coalesce(role == "detalle_agricola", F.lit(False))
    critical = (F.col("flag_anio_fuera_rango") | F.col("flag_superficie_negativa")
                | F.col("flag_mortandad_mayor_existencias") | F.col("evento_id").isNull())
    high = F.col("flag_ganadera_afectada_mayor_uso") | (F.col("flag_superficie_total_menor_afectadas") & principal)
    medium = F.col("flag_agricola_afectada_mayor_uso") & principal
    structural = F.col("flag_agricola_afectada_mayor_uso") & detail
    return (F.when(critical, "critico").when(high, "alto").when(medium, "medio")
             .when(structural, "estructural").otherwise("ok"))


def add_quality_flags(df: DataFrame) -> DataFrame:
    """K1-K9 in one projection; output is the 47 harmonised columns
    (plus any extra columns such as ``row_id``, kept at the end)."""
    df = ensure_columns(df, OUTPUT_TYPES)
    if "flag_anio_corregido" in df.columns:
        corrected = F.coalesce(F.col("flag_anio_corregido").cast("boolean"), F.lit(False))
    else:
        corrected = F.lit(False)
    flags = {
        "flag_anio_corregido": corrected,
        "flag_anio_fuera_rango": flag_year_range(),
        "flag_superficie_negativa": flag_negative_area(),
        "flag_agricola_afectada_mayor_uso": flag_agri_over_use(),
        "flag_ganadera_afectada_mayor_uso": flag_livestock_over_use(),
        "flag_mortandad_mayor_existencias": flag_deaths_over_stock(),
        "flag_superficie_total_menor_afectadas": flag_total_under_affected(),
    }
    out = df.withColumns(flags)
    out = out.withColumn("severidad_maxima", severity())
    out = out.withColumn("flag_revision_manual", F.col("severidad_maxima").isin(*REVIEW_LEVELS))
    extra = [c for c in df.columns if c not in OUTPUT_COLUMNS]
    return out.select(*[F.col(c).cast(OUTPUT_TYPES[c]).alias(c) for c in OUTPUT_COLUMNS], *extra)


def apply_event_mapping(df: DataFrame, registry: DataFrame) -> DataFrame:
    """Registry join of the harmonisation step: event, role, relation from
    the registry when present; year = registry start year -> year in the
    event id -> year in the file name -> parsed year (C12); K7 flags a
    changed year; the period is rebuilt."""
    from .joins import attach_registry

    df = ensure_columns(df, OUTPUT_TYPES)
    reg = registry.select("source_file", F.col("evento_id").alias("__ev"), F.col("anio_inicio").cast("string").alias("__y0"),
                          F.col("dataset_role").alias("__role"), F.col("relation_type").alias("__rel"))
    out = attach_registry(df, reg, indicator=None)
    original = F.col("anio")
    event = F.coalesce(F.col("__ev"), F.col("evento_id"))
    # found once per row; the flag, the year and the period read it
    out = out.withColumn("__found", resolved_year_text("__y0", event, "source_file", "anio"))
    new_year = year_of(F.col("__found"))
    out = out.withColumns({
        "evento_id": event,
        "dataset_role": F.coalesce(F.col("__role"), F.col("dataset_role")),
        "relation_type": F.coalesce(F.col("__rel"), F.col("relation_type")),
        "flag_anio_corregido": original.isNotNull() & new_year.isNotNull() & (original.cast("int") != new_year),
        "anio": new_year,
    })
    out = out.withColumn("periodo", build_period(F.col("anio"), F.col("dto")))
    return out.drop("__ev", "__y0", "__role", "__rel", "__found")


def error_summary(df: DataFrame) -> DataFrame:
    """One aggregate of all error counts, unpivoted, zero rows dropped."""
    cols = set(df.columns)
    items: list[tuple[str, Column]] = []
    for c in SURFACE_COLUMNS:
        if c in cols:
            items.append((f"{c}_negativa", F.count_if(F.coalesce(F.col(c), F.lit(0.0)) < 0)))
    for a, b, label in ERROR_PAIRS:
        if a in cols and b in cols:
            items.append((label, F.count_if(F.coalesce(F.col(a) > F.col(b), F.lit(False)))))
    for c in REQUIRED_FIELDS:
        if c in cols:
            items.append((f"{c}_faltante", F.count_if(F.col(c).isNull())))
    wide = df.agg(*[e.alias(f"e{i}") for i, (_, e) in enumerate(items)])
    args = ", ".join(f"'{name}', e{i}" for i, (name, _) in enumerate(items))
    return (wide.selectExpr(f"stack({len(items)}, {args}) AS (tipo_error, cantidad_filas)")
                .filter("cantidad_filas > 0"))


def unmapped(df: DataFrame) -> DataFrame:
    """Rows without a registry entry, per (file, period)."""
    return (df.filter(F.col("sin_event_mapping")).groupBy("source_file", "periodo")
              .agg(F.count(F.lit(1)).alias("filas")))


# --- fixed values: quality report --------------------------------------------------
REPORT_PREVIEW_ROWS = 100     # what the source's report shows
REPORT_DUPLICATE_ROWS = 500
REPORT_DUPLICATE_KEYS = ["periodo", "productor_nombre", "documento_nro", "cuit_cuil", "departamento", "actividad", "cultivo"]
# -----------------------------------------------------------------------------------


def quality_report(df: DataFrame, order: str = "row_id", preview_rows: int = REPORT_PREVIEW_ROWS,
                   duplicate_rows: int | None = None) -> dict[str, DataFrame]:
    """K11 (and K12 on the consolidated table): the seven report tables --
    preview, nulls per column, rows per year and per department, duplicate
    rows on the identity columns (all, or the first ``duplicate_rows`` in
    ingest order), surface statistics and the error summary.  Each is its own
    lazy plan; cache the input first when all seven are written together."""
    from .aggregates import describe, null_counts, size_by
    from .windows import duplicate_members
    cols = set(df.columns)
    keys = [k for k in REPORT_DUPLICATE_KEYS if k in cols]
    repeated = duplicate_members(df, keys)
    return {
        "preview": df.orderBy(order).limit(preview_rows),
        "nulos": null_counts(df.select(*[c for c in OUTPUT_COLUMNS if c in cols])),
        "filas_por_anio": size_by(df, "anio"),
        "filas_por_departamento": size_by(df, "departamento"),
        "duplicados": repeated if duplicate_rows is None else repeated.orderBy(order).limit(duplicate_rows),
        "resumen_superficies": describe(df, [c for c in SURFACE_COLUMNS if c in cols]),
        "errores_potenciales": error_summary(df),
    }
