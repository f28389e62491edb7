"""Profiling and reconciliation.

Every multi-table report is a union of per-table aggregates (each with
map-side partial aggregation); only schemas (metadata) are read on the
driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregates import profile
from ..operators.filters import CURRENT, HISTORIC, is_critical
from ..operators.joins import align
from ..operators.setops import union_all
from ..operators.windows import top_n

# --- fixed values (in the source system's order) -------------------------------
CURRENT_TABLES = [
    "ddjj_personas",
    "productores",
    "resoluciones",
    "agricultura",
    "bovinos",
    "adremas",
    "establecimientos",
    "tipoactividad",
    "tipojuridico",
    "cultivos",
    "cultivostipo",
    "tipodocumento",
    "provincias",
    "departamentos",
    "localidades",
    "domicilios",
    "ponderaciones_ddjj",
    "rubro_tipos",
    "perdidas_mejoras",
    "tipotenencia",
    "ovinos",
    "porcinos",
    "avicultura",
    "apicultura",
    "forestacion",
    "perdidas_invernaculos",
    "perdidas_plurianuales",
    "documentacion",
    "fotos",
]
VIEW_KEYS = {
    "vw_hist_resoluciones": ["evento_id"],
    "vw_hist_ddjj_personas": ["ddjj_hist_id", "evento_id"],
    "vw_hist_productores": ["productor_hist_id"],
    "vw_hist_tipoactividad": ["actividad_hist_id"],
    "vw_hist_agricultura": ["agricultura_hist_id", "evento_id"],
    "vw_hist_cultivostipo": ["cultivo_tipo_hist_id"],
    "vw_hist_cultivos": ["cultivo_hist_id"],
    "vw_hist_ganaderia_resumen": ["ganaderia_hist_id", "evento_id"],
    "vw_all_resoluciones": ["resolucion_all_id"],
    "vw_all_ddjj_personas": ["ddjj_all_id"],
    "vw_all_productores": ["productor_all_id"],
    "vw_all_tipoactividad": ["actividad_all_id"],
    "vw_all_agricultura": ["agricultura_all_id"],
    "vw_all_cultivos": ["cultivo_all_id"],
    "vw_all_cultivostipo": ["cultivo_tipo_all_id"],
    "vw_all_ganaderia_resumen": ["ganaderia_all_id"],
}
DUPLICATE_CAP = 5000          # what the source's listings keep; an option here
PREVIEW_ROWS = 25
LARGEST_TABLES = 15
TRACE_COLUMNS = ["evento_id", "source_file", "source_sheet"]
PROTECTED_PREFIXES = ("stg_", "vw_hist_", "vw_all_")
# -----------------------------------------------------------------------------


def table_profile(df: DataFrame, table: str) -> DataFrame:
    """Rows, distinct events/files, year range, critical rows, null events."""
    return profile(df, table)


def compare_profiles(local: DataFrame, loaded: DataFrame) -> DataFrame:
    """Two profile frames aligned per table, with the row difference."""
    out = align(local, loaded, "tabla", "_local", "_destino")
    return out.withColumn("diferencia_filas", F.col("filas_destino") - F.col("filas_local"))


def breakdowns(tables: Mapping[str, DataFrame], col: str) -> DataFrame:
    """Rows per value of ``col`` in every table, tagged with the table."""
    return union_all([df.groupBy(col).agg(F.count(F.lit(1)).alias("filas")).select(F.lit(name).alias("tabla"), col, "filas")
                      for name, df in tables.items() if col in df.columns])


def duplicate_keys(df: DataFrame, keys: Sequence[str], cap: int | None = None) -> DataFrame:
    """Key combinations (no part null or blank) occurring more than
    once; with ``cap`` only the largest groups."""
    filled = df
    for k in keys:
        filled = filled.filter(F.col(k).isNotNull() & (F.col(k).cast("string") != ""))
    g = filled.groupBy(*keys).agg(F.count(F.lit(1)).alias("duplicados")).filter("duplicados > 1")
    return g if cap is None else top_n(g, "duplicados", cap, *keys)


def null_trace(df: DataFrame, table: str, cols: Sequence[str] = TRACE_COLUMNS) -> DataFrame:
    """Null counts of the trace columns."""
    present = [c for c in cols if c in df.columns]
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_nulos") for c in present]).select(
        F.lit(table).alias("tabla"), "*")


def view_profile(df: DataFrame | None, name: str, spark: SparkSession | None = None) -> DataFrame:
    """Profile of a view (only metrics for the columns it has), plus
    ``existe`` / ``vacia``; a missing view (``None``) is a row as well."""
    if df is None:
        row = (spark or SparkSession.active()).range(1)
        return row.select(F.lit(name).alias("tabla"), F.lit(0).cast("long").alias("filas"),
                          F.lit(False).alias("existe"), F.lit(True).alias("vacia"))
    p = profile(df, name)
    return p.withColumn("existe", F.lit(True)).withColumn("vacia", F.col("filas") == 0)


def _is_blank(key: str):
    return F.col(key).isNull() | (F.col(key).cast("string") == "")


def blank_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Null-or-blank counts per key column (values compared as text)."""
    return df.agg(*[F.count_if(_is_blank(k)).alias(f"{k}_vacios") for k in keys])


def summarise_views(views: Mapping[str, DataFrame | None]) -> DataFrame:
    """N6/N9 for every view: rows, events, years, critical rows, rows per
    origin and a remark.  One aggregate per view; a missing view is a row."""
    spark = SparkSession.active()
    parts = []
    for name, df in views.items():
        have = set(df.columns) if df is not None else set()
        unified = name.startswith("vw_all_")
        none = F.lit(None).cast("long")

        def only(column, value, have=have, none=none):
            return value if column in have else none
        source = df if df is not None else spark.range(0)
        remark = F.lit("")
        if df is None:
            remark = F.lit("vista no encontrada")
        elif unified:
            remark = F.when(F.col("actuales") == 0, F.lit("sin filas actuales")).otherwise(F.lit(""))
        parts.append(source.agg(
            F.count(F.lit(1)).alias("filas"),
            only("evento_id", F.countDistinct("evento_id")).alias("eventos") if not unified else none.alias("eventos"),
            only("anio", F.min("anio").cast("long") if "anio" in have else none).alias("anio_min"),
            only("anio", F.max("anio").cast("long") if "anio" in have else none).alias("anio_max"),
            only("severidad_maxima", F.count_if(is_critical("severidad_maxima"))).alias("criticos"),
            only("origen_dato", F.count_if(F.col("origen_dato") == HISTORIC)).alias("historicos"),
            only("origen_dato", F.count_if(F.col("origen_dato") == CURRENT)).alias("actuales"),
        ).select(F.lit(name).alias("vista"), F.lit(df is not None).alias("existe"), "filas",
                 (F.col("filas") == 0).alias("vacia"), "eventos", "anio_min", "anio_max", "criticos", "historicos",
                 "actuales", remark.alias("observacion")))
    return union_all(parts)


def blank_keys_by_view(views: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]] = VIEW_KEYS) -> DataFrame:
    """N7 for every view, long form: (view, origin, key, blank rows); the
    origin is null for views that have none."""
    parts = []
    for name, df in views.items():
        has_origin = "origen_dato" in df.columns
        origin = F.col("origen_dato") if has_origin else F.lit(None).cast("string")
        named = [k for k in keys[name] if k in df.columns]
        g = df.groupBy(origin.alias("origen_dato")).agg(*[F.count_if(_is_blank(k)).alias(k) for k in named])
        spell = ", ".join(f"'{k}', `{k}`" for k in named)
        parts.append(g.selectExpr("origen_dato", f"stack({len(named)}, {spell}) AS (clave, vacios)")
                     .select(F.lit(name).alias("vista"), "origen_dato", "clave", "vacios"))
    return union_all(parts)


def duplicates_by_view(views: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]] = VIEW_KEYS,
                       cap: int | None = None) -> DataFrame:
    """N11 for the first key of every view: (view, key column, origin, key,
    rows) of keys repeated within an origin."""
    parts = []
    for name, df in views.items():
        key = keys[name][0]
        origin = F.col("origen_dato") if "origen_dato" in df.columns else F.lit(None).cast("string")
        keyed = df.select(origin.alias("origen_dato"), F.col(key).cast("string").alias("clave"))
        g = (keyed.filter(F.col("clave").isNotNull() & (F.col("clave") != "")).groupBy("origen_dato", "clave")
             .agg(F.count(F.lit(1)).alias("duplicados")).filter("duplicados > 1"))
        g = g if cap is None else top_n(g, "duplicados", cap, "origen_dato", "clave")
        parts.append(g.select(F.lit(name).alias("vista"), F.lit(key).alias("clave_validada"), "origen_dato", "clave",
                              "duplicados"))
    return union_all(parts)


def rows_by_view(views: Mapping[str, DataFrame], col: str) -> DataFrame:
    """N10 for every view that has ``col``: rows per (origin, value); unified
    views count named events only (null events are left out there)."""
    parts = []
    for name, df in views.items():
        if col not in df.columns:
            continue
        unified = "origen_dato" in df.columns
        origin = F.col("origen_dato") if unified else F.lit(None).cast("string")
        kept = df.filter(F.col(col).isNotNull()) if unified and col == "evento_id" else df
        if unified and col == "severidad_maxima":
            kept = kept.filter(F.col("origen_dato") == HISTORIC)
        parts.append(kept.groupBy(origin.alias("origen_dato"), F.col(col).cast("string").alias("valor"))
                     .agg(F.count(F.lit(1)).alias("filas"))
                     .select(F.lit(name).alias("vista"), "origen_dato", "valor", "filas"))
    return union_all(parts)


def preview(df: DataFrame, order: Sequence[str], n: int = PREVIEW_ROWS) -> DataFrame:
    """First ``n`` rows in a deterministic order."""
    return df.orderBy(*order).limit(n)


def origin_summary(df: DataFrame) -> DataFrame:
    """Rows per origin, current/historic split, list of origins and a
    note when the unified view has no current rows."""
    return df.agg(
        F.count(F.lit(1)).alias("filas"),
        F.count_if(F.col("origen_dato") == CURRENT).alias("filas_actual"),
        F.count_if(F.col("origen_dato") == HISTORIC).alias("filas_historico"),
        F.array_join(F.sort_array(F.collect_set("origen_dato")), ", ").alias("origenes"),
    ).withColumn("nota", F.when(F.col("filas_actual") == 0, F.lit("sin filas actuales")))


def origin_breakdown(df: DataFrame, col: str, cap: int | None = None) -> DataFrame:
    """Rows per (origin, col), named events only; with ``cap`` the
    largest groups."""
    if col == "evento_id":
        df = df.filter(F.col(col).isNotNull())
    g = df.groupBy("origen_dato", col).agg(F.count(F.lit(1)).alias("filas"))
    return g if cap is None else top_n(g, "filas", cap, "origen_dato", col)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every table as one distributed union of 1-row aggregates."""
    return union_all([df.agg(F.count(F.lit(1)).alias("filas")).select(F.lit(name).alias("tabla"), "filas")
                      for name, df in tables.items()])


def copy_report(source: Mapping[str, DataFrame], copied: Mapping[str, DataFrame],
                dest: Mapping[str, DataFrame]) -> DataFrame:
    """Source / copied / destination rows per table; ok iff all equal, so
    a table that is missing anywhere is not."""
    s = row_counts(source).withColumnRenamed("filas", "filas_origen")
    c = row_counts(copied).withColumnRenamed("filas", "filas_copiadas")
    d = row_counts(dest).withColumnRenamed("filas", "filas_destino")
    out = s.join(c, "tabla", "full_outer").join(d, "tabla", "full_outer")
    same = (F.col("filas_origen") == F.col("filas_copiadas")) & (F.col("filas_copiadas") == F.col("filas_destino"))
    return out.withColumn("ok", F.coalesce(same, F.lit(False)).cast("int"))


def copy_summary(report: DataFrame) -> DataFrame:
    """Totals of a copy report."""
    return report.agg(F.count(F.lit(1)).alias("tablas"), F.count_if(F.col("ok") == 1).alias("tablas_ok"),
                      F.count_if(F.col("ok") == 0).alias("tablas_con_diferencias"),
                      F.coalesce(F.sum("filas_origen"), F.lit(0)).alias("filas_origen"),
                      F.coalesce(F.sum("filas_destino"), F.lit(0)).alias("filas_destino"))


def validate_copy(spark: SparkSession, source: Mapping[str, DataFrame], dest: Mapping[str, DataFrame],
                  tables: Sequence[str]) -> DataFrame:
    """Per table: exists on each side, rows, difference, missing and
    extra columns; ok = exists, same rows, no missing column (extra columns
    do not fail)."""
    counts_s = row_counts({t: source[t] for t in tables if t in source}).withColumnRenamed("filas", "filas_origen")
    counts_d = row_counts({t: dest[t] for t in tables if t in dest}).withColumnRenamed("filas", "filas_destino")
    meta = []
    for t in tables:
        sc = source[t].columns if t in source else []
        dc = dest[t].columns if t in dest else []
        meta.append((t, t in source, t in dest, ", ".join(sorted(set(sc) - set(dc))) if t in dest else "",
                     ", ".join(sorted(set(dc) - set(sc))) if t in source else ""))
    m = spark.createDataFrame(meta, "tabla string, existe_origen boolean, existe_destino boolean, "
                                    "columnas_faltantes string, columnas_extra string")
    out = m.join(counts_s, "tabla", "left").join(counts_d, "tabla", "left")
    out = out.withColumn("diferencia_filas", F.col("filas_destino") - F.col("filas_origen"))
    return out.withColumn("ok", F.col("existe_origen") & F.col("existe_destino")
                          & F.coalesce(F.col("diferencia_filas") == 0, F.lit(False)) & (F.col("columnas_faltantes") == ""))


def table_meta(tables: Mapping[str, DataFrame], name: str) -> dict:
    """Existence, column list (metadata only)."""
    if name not in tables:
        return {"tabla": name, "existe": False, "columnas": []}
    return {"tabla": name, "existe": True, "columnas": list(tables[name].columns)}


def largest_tables(tables: Mapping[str, DataFrame], n: int = LARGEST_TABLES) -> DataFrame:
    """The ``n`` largest tables by rows."""
    return top_n(row_counts(tables), "filas", n, "tabla")


def is_protected(name: str) -> bool:
    """A12 guard: staging and view names are never overwritten by a copy."""
    return name.lower().startswith(PROTECTED_PREFIXES)


def orphan_rates(fks: Sequence[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Per logical foreign key ``(name, child, fk, parent, pk)``: child
    rows, rows whose non-null key has no parent, and the orphan rate."""
    parts = []
    for name, child, fk, parent, pk in fks:
        keys = parent.select(F.col(pk).alias("__pk")).distinct()
        c = child.select(F.col(fk).alias("__fk"))
        flagged = c.join(keys, F.col("__fk") == F.col("__pk"), "left")
        parts.append(flagged.agg(F.count(F.lit(1)).alias("filas"),
                                 F.count_if(F.col("__fk").isNotNull() & F.col("__pk").isNull()).alias("huerfanos"))
                     .select(F.lit(name).alias("relacion"), "filas", "huerfanos"))
    return union_all(parts).withColumn("tasa_huerfanos", F.when(F.col("filas") > 0, F.col("huerfanos") / F.col("filas"))
                                       .otherwise(F.lit(0.0)))


def damage_rollup(weights: DataFrame, declarations: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Per declaration: estimated, obtained and weighted loss summed over
    rubros, compared with the declared damage (Σ weighted loss = pondf);
    declarations without any weight row are kept, and don't add up."""
    w = weights.groupBy("id_ddjj").agg(F.sum("estimados").alias("estimados"), F.sum("obtenidos").alias("obtenidos"),
                                       F.sum("perdidas_ponde").alias("perdida_ponderada"), F.count(F.lit(1)).alias("rubros"))
    d = declarations.select("id_ddjj", "pondf")
    out = w.join(d, "id_ddjj", "full_outer").withColumn("rubros", F.coalesce("rubros", F.lit(0)))
    diff = F.col("perdida_ponderada") - F.col("pondf")
    return out.withColumn("diferencia", diff).withColumn("cuadra", F.coalesce(F.abs(diff) <= tolerance, F.lit(False)))
