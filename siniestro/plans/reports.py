"""Report queries (O1-O23): the parameterised reports of the dashboard,
each a lazy DataFrame over the catalog.

Client-side post-processing of the source system (percentages, top-N,
labels, melt) is part of the same plan here, so it runs distributed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import month_key
from ..functions.numeric import activity_rgb, add_percent, damage_rgb, repair_coord
from ..functions.text import is_unclassified, short_label
from ..operators import aggregates as agg
from ..operators.filters import (Filters, any_positive, apply_filters, at_least, in_bbox, in_list, non_blank,
                                 not_blank_or_zero, search)
from ..operators.joins import Dim, by_id, filter_resolution, join_resolutions, lookup, with_count
from ..operators.setops import distinct_union, melt
from ..operators.windows import drop_dominant, top_n
from .catalog import Catalog
from .views import parcels_inner

# --- fixed values ------------------------------------------------------------
TOP_DEPARTMENTS = 15
HISTOGRAM_BINS = 20
DEFAULT_TOP_N = 20
DEFAULT_PRODUCER_LIMIT = 200
DEFAULT_PARCEL_LIMIT = 500
MIN_SOWN_FOR_PERCENT = 10.0
CROP_METRICS = {"superficie afectada": "afectada", "superficie sembrada": "sembrada",
                "porcentaje afectado": "pct_afectado"}
LEGAL_MODES = ("Top combinaciones", "Todas las categorias", "Excluir categoria dominante")
UNCLASSIFIED = "(s/d)"
HERD_FALLBACK = "GANADERIA"
# -----------------------------------------------------------------------------


def _declarations(cat: Catalog, f: Filters) -> DataFrame:
    """Declarations after the global filters (D1), unified resolution
    filter as a semi join (E4)."""
    d = cat.table("ddjj_personas")
    if cat.unified and f.id_resolucion:
        d = filter_resolution(d, cat.table("resoluciones"), str(f.id_resolucion))
    return apply_filters(d, f, unified=cat.unified)


# -- O1, O2 ---------------------------------------------------------------------
def kpis(cat: Catalog) -> DataFrame:
    """O1: five counts and the mean positive damage, one row.  Built as a
    union of 1-row aggregates folded by one global aggregate (no cross join)."""
    n = lambda df, k: df.agg(F.count(F.lit(1)).cast("double").alias("v")).select(F.lit(k).alias("k"), "v")
    d = cat.table("ddjj_personas")
    parts = [n(cat.table("productores"), "productores"), n(d, "ddjj"), n(cat.table("resoluciones"), "resoluciones"),
             n(cat.physical("establecimientos"), "establecimientos"), n(cat.physical("adremas"), "adremas"),
             d.filter(F.col("pondf") > 0).agg(F.round(F.avg("pondf"), 2).alias("v")).select(F.lit("pondf_promedio").alias("k"), "v")]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    names = ["productores", "ddjj", "resoluciones", "establecimientos", "adremas"]
    return u.agg(*[F.max(F.when(F.col("k") == k, F.col("v"))).cast("bigint").alias(k) for k in names],
                 F.max(F.when(F.col("k") == "pondf_promedio", F.col("v"))).alias("pondf_promedio"))


def resolution_list(cat: Catalog) -> DataFrame:
    """O2: resolutions, newest first."""
    r = cat.table("resoluciones")
    if cat.unified:
        r = r.select(F.col("resolucion_all_id").alias("id_resolucion"), "nombre_resolucion", "numero_resolucion",
                     "fec_res", "origen_dato")
    else:
        r = r.select("id_resolucion", "nombre_resolucion", "numero_resolucion", "fec_res")
    return r.orderBy(F.desc("fec_res"))


def declaration_departments(cat: Catalog) -> DataFrame:
    """O2/H5: distinct non-blank departments of declarations."""
    d = cat.table("ddjj_personas")
    return d.filter(non_blank("departamento")).select("departamento").distinct().orderBy("departamento")


def declaration_years(cat: Catalog) -> DataFrame:
    """O2: distinct declaration years (current mode: after the base-date guard, D9)."""
    d = cat.table("ddjj_personas")
    if not cat.unified:
        d = d.filter(F.col("fecha") > F.lit("2000-01-01").cast("date"))
    return d.select(F.year("fecha").alias("anio")).distinct().orderBy(F.desc("anio"))


def date_span(cat: Catalog) -> DataFrame:
    """O2/C20: first and last declaration date."""
    d = cat.table("ddjj_personas")
    if not cat.unified:
        d = d.filter(F.col("fecha") > F.lit("2000-01-01").cast("date"))
    return d.agg(F.min("fecha").alias("mn"), F.max("fecha").alias("mx"))


def activity_list(cat: Catalog) -> DataFrame:
    return cat.physical("tipoactividad").select(F.col("TipoActividadId").alias("id"),
                                                F.col("TipoActividadDesc").alias("descripcion")).orderBy("descripcion")


def department_list(cat: Catalog) -> DataFrame:
    return cat.physical("departamentos").select("DepartamentoId", "DepartamentoDesc", "ProvinciaId").orderBy("DepartamentoDesc")


def rubro_list(cat: Catalog, used_only: bool = False) -> DataFrame:
    """O2: the rubros, or those that some declaration's weights use."""
    r = cat.physical("rubro_tipos").select("id_rubro", "nombre")
    if used_only:
        used = cat.physical("ponderaciones_ddjj").select(F.col("rubro").alias("id_rubro")).distinct()
        r = r.join(used, "id_rubro", "left_semi")
    return r.orderBy("id_rubro")


# -- O3-O6: home page -------------------------------------------------------------
def declarations_per_resolution(cat: Catalog, f: Filters = Filters()) -> DataFrame:
    """O3: declarations per resolution (E2 current, rewritten E3 unified)."""
    d = _declarations(cat, f)
    j = join_resolutions(d, cat.table("resoluciones"), unified=cat.unified)
    num, name = ("r_numero_resolucion", "r_nombre_resolucion") if cat.unified else ("numero_resolucion", "nombre_resolucion")
    return (j.groupBy(F.col(num).alias("resolucion"), F.col(name).alias("nombre"))
             .agg(F.count(F.lit(1)).alias("ddjj")).orderBy(F.desc("ddjj"), "resolucion"))


def top_departments(cat: Catalog, f: Filters = Filters(), n: int = TOP_DEPARTMENTS) -> DataFrame:
    """Top departments by declarations, with mean damage."""
    d = _declarations(cat, f).filter(non_blank("departamento"))
    return top_n(agg.count_mean_by(d, "departamento", "pondf"), "ddjj", n, "departamento")


def damage_histogram(cat: Catalog, f: Filters = Filters(), bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Distribution of positive damage in equal-width bins over 0-100."""
    d = _declarations(cat, f).filter(F.col("pondf") > 0)
    return agg.histogram(d, "pondf", 0.0, 100.0, bins).orderBy("bin")


def monthly_evolution(cat: Catalog, f: Filters = Filters()) -> DataFrame:
    """Declarations and mean damage per month."""
    d = _declarations(cat, f)
    return (d.groupBy(month_key("fecha").alias("mes"))
             .agg(F.count(F.lit(1)).alias("ddjj"), F.round(F.avg("pondf"), 1).alias("pondf_prom")).orderBy("mes"))


# -- O7-O11: producers and declaration detail --------------------------------------
def _producer_dims(cat: Catalog) -> list[Dim]:
    dom = cat.physical("domicilios")
    return [
        Dim(cat.physical("tipodocumento"), "TipoDocumentoId", "TipoDocumentoId", {"TipoDocumentoDescripcion": "tipo_doc"}),
        Dim(cat.physical("tipoactividad"), "EsPrincipalActividadEconomica", "TipoActividadId", {"TipoActividadDesc": "actividad"}),
        Dim(cat.physical("tipojuridico"), "TipoJuridicoId", "TipoJuridicoId", {"TipoJuridicoDesc": "tipo_juridico"}),
        Dim(dom, "DomicilioId", "DomicilioId", {"ProvinciaId": "__prov", "DepartamentoId": "__dep", "LocalidadId": "__loc"}),
        Dim(cat.physical("provincias"), "__prov", "ProvinciaId", {"ProvinciaDesc": "provincia"}),
        Dim(cat.physical("departamentos"), "__dep", "DepartamentoId", {"DepartamentoDesc": "departamento"}),
        Dim(cat.physical("localidades"), "__loc", "LocalidadId", {"LocalidadDesc": "localidad"}),
    ]


def search_producers(cat: Catalog, q: str | None = None, activities: Sequence[str] = (),
                     limit: int | None = DEFAULT_PRODUCER_LIMIT) -> DataFrame:
    """Producer search (name/CUIT/document contains, case-insensitive),
    activity filter, seven lookups, declaration count (E7).  With a ``limit``
    the first by name; with none every producer, in no order.  The sort keys
    are the producers' own, so without an activity filter the cut comes first
    and only its rows meet the lookups and the count."""
    p = cat.physical("productores")
    p = p.filter(search(["ProductorDenominacion", "CUITCUIL", "DocumentoNro"], q))
    if limit is not None and not activities:
        p = p.orderBy("ProductorDenominacion", "ProductorId").limit(limit)
    j = lookup(p, _producer_dims(cat))
    if activities:
        j = j.filter(in_list("actividad", activities))
    j = with_count(j, cat.physical("ddjj_personas"), "ProductorId", "id_productor", "ddjj")
    out = j.select(F.col("ProductorId").alias("id"), F.col("ProductorDenominacion").alias("productor"),
                   F.col("CUITCUIL").alias("cuit"), "tipo_doc", F.col("DocumentoNro").alias("documento"),
                   F.col("Sexo").alias("sexo"), "actividad", "tipo_juridico", "provincia", "departamento",
                   "localidad", "renspa", "ddjj")
    return out if limit is None else out.orderBy("productor", "id").limit(limit)


def producer_declarations(cat: Catalog, producer_id) -> DataFrame:
    """Declarations of one producer with their resolution number."""
    d = by_id(cat.physical("ddjj_personas"), "id_productor", producer_id)
    r = cat.physical("resoluciones").select("id_resolucion", "numero_resolucion")
    return (d.join(r, "id_resolucion", "left")
             .select("id_ddjj", "fecha", "numero_resolucion", "pondf", "departamento", "localidad", "cargado", "estado")
             .orderBy(F.desc("fecha"), "id_ddjj"))


def declaration_header(cat: Catalog, ddjj_ids: DataFrame | int) -> DataFrame:
    """Declaration header with producer and resolution (one id, or many
    at once through a semi join on an id set)."""
    d = _restrict(cat.physical("ddjj_personas"), "id_ddjj", ddjj_ids)
    j = lookup(d, [
        Dim(cat.physical("productores"), "id_productor", "ProductorId",
            {"ProductorDenominacion": "productor", "CUITCUIL": "CUITCUIL", "DocumentoNro": "DocumentoNro"}),
        Dim(cat.physical("resoluciones"), "id_resolucion", "id_resolucion",
            {"nombre_resolucion": "nombre_resolucion", "numero_resolucion": "numero_resolucion", "fec_res": "fec_res"}),
    ])
    return j.select("id_ddjj", "fecha", "pondf", "cargado", "estado", "productor", "CUITCUIL", "DocumentoNro",
                    "nombre_resolucion", "numero_resolucion", "fec_res", "provincia", "departamento", "localidad", "paraje")


def _restrict(df: DataFrame, col: str, ids: DataFrame | int | str) -> DataFrame:
    if isinstance(ids, DataFrame):
        key = ids.columns[0]
        return df.join(ids.select(F.col(key).alias("__id")).distinct(), F.col(col) == F.col("__id"), "left_semi")
    return by_id(df, col, ids)


def loss_weights(cat: Catalog, ddjj_ids: DataFrame | int) -> DataFrame:
    """Loss weights per rubro of the given declaration(s)."""
    p = _restrict(cat.physical("ponderaciones_ddjj"), "id_ddjj", ddjj_ids)
    rt = cat.physical("rubro_tipos")
    return (p.join(rt, p.rubro == rt.id_rubro, "inner")
             .select("id_ddjj", F.col("nombre").alias("rubro"), "estimados", "obtenidos",
                     F.col("perdidas_ponde").alias("perdida_pct"), F.col("rubro").alias("rubro_id"))
             .orderBy("id_ddjj", "rubro_id"))


# --- fixed values: detail tables of a declaration (table, fk, columns) --------
DETAIL_TABLES = {
    "bovinos": ("idddjj", ["cantivaca", "cantivaqui", "cantiterne", "cantinovi", "cantinovilli", "cantitoro",
                           "cantibufa", "prodespe", "prodobte", "carnestimada", "carneobtenida", "carneperdida"]),
    "ovinos": ("idddjj", ["canticabe", "mortacabe", "prodcor", "corobte", "prodlana", "lanaobte", "perdilana"]),
    "porcinos": ("idddjj", ["canticabe", "mortacabe", "prodcor", "corobte"]),
    "avicultura": ("idddjj", ["existencia", "perdida", "prodnor", "prodobte"]),
    "apicultura": ("idddjj", ["cantcol", "canafec", "prodnormiel", "prodobtemiel", "mielperdida"]),
    "forestacion": ("idddjj", ["supuso", "supafe", "superdida", "prodmaes", "prodmaob", "madestimada", "madeperdida",
                               "prodposes", "posteperdida", "prodreses", "resiperdida"]),
    "perdidas_mejoras": ("idddjj", ["mejora", "vestimado", "incidencia", "pesesp", "pesper"]),
    "perdidas_invernaculos": ("ddjj", ["cobertura_plasticas", "estructuras", "supsemb", "supafect",
                                       "coberplastiperdi", "danoplastiperdi"]),
    "perdidas_plurianuales": ("ddjj", ["cobertura_plantas", "coberperdi", "dano_planta", "danoperdi"]),
    "documentacion": ("idddjj", ["codigo", "documentacion", "marcar"]),
    "fotos": ("iddjj", ["id", "file"]),
}
# -----------------------------------------------------------------------------


def declaration_crops(cat: Catalog, ddjj_ids: DataFrame | int) -> DataFrame:
    """O11 (crops tab): crop rows with type and crop names."""
    a = _restrict(cat.physical("agricultura"), "ddjj", ddjj_ids)
    j = lookup(a, [Dim(cat.physical("cultivostipo"), "tipo_cultivo", "id", {"CultivoTipoDesc": "tipo"}),
                   Dim(cat.physical("cultivos"), "id_cultivo", "id", {"CultivoDesc": "cultivo"})])
    return j.select(F.col("ddjj").alias("id_ddjj"), "id_agricultura", "tipo", "cultivo", "sup_sembrada",
                    "sup_afectada", "prod_estimada", "prod_obtenida", "estado", "porcentaje")


def declaration_parcels(cat: Catalog, ddjj_ids: DataFrame | int) -> DataFrame:
    """O11 (parcels tab): parcels with activity, tenure and establishment."""
    a = _restrict(cat.physical("adremas"), "ddjj", ddjj_ids)
    return lookup(a, _parcel_dims(cat)).select(
        F.col("ddjj").alias("id_ddjj"), "adrema", "superficie", F.col("__actividad").alias("actividad"),
        F.col("__tenencia").alias("tenencia"), "departamento", "nombre_estab", "paraje_estab")


def declaration_detail(cat: Catalog, ddjj_ids: DataFrame | int) -> dict[str, DataFrame]:
    """The whole detail bundle of the given declaration(s)."""
    out = {"agricultura": declaration_crops(cat, ddjj_ids), "adremas": declaration_parcels(cat, ddjj_ids)}
    for table, (fk, cols) in DETAIL_TABLES.items():
        t = _restrict(cat.physical(table), fk, ddjj_ids)
        out[table] = t.select(F.col(fk).alias("id_ddjj"), *cols)
    return out


# -- O12, O13: parcels and map ------------------------------------------------------
def _parcel_dims(cat: Catalog) -> list[Dim]:
    return [
        Dim(cat.physical("tipoactividad"), F.col("actividad").try_cast("int"), "TipoActividadId",
            {"TipoActividadDesc": "__actividad"}),
        Dim(cat.physical("tipotenencia"), "tenencia", "id", {"descripcion": "__tenencia"}),
        Dim(cat.physical("establecimientos"), "id_establecimiento", "id_establecimiento",
            {"nombre_estab": "nombre_estab", "paraje_estab": "paraje_estab"}),
    ]


def parcels(cat: Catalog, q: str | None = None, departments: Sequence[str] = (), min_area: float = 0,
            limit: int | None = DEFAULT_PARCEL_LIMIT) -> DataFrame:
    """Parcel listing with five lookups: the largest ``limit`` ones, or
    all of them.  Without a text search (which reads the producer) the cut
    comes before the lookups."""
    a = cat.physical("adremas").filter(non_blank("adrema"))
    if departments:
        a = a.filter(in_list("departamento", departments))
    a = a.filter(at_least("superficie", min_area))
    if limit is not None and not q:
        a = top_n(a, "superficie", limit, "adrema", "id_adrema" if "id_adrema" in a.columns else "ddjj")
    j = lookup(a, _parcel_dims(cat) + [
        Dim(cat.physical("ddjj_personas"), "ddjj", "id_ddjj", {"id_productor": "__prod"}),
        Dim(cat.physical("productores"), "__prod", "ProductorId",
            {"ProductorDenominacion": "productor", "CUITCUIL": "CUITCUIL"}),
    ])
    if q:
        j = j.filter(search(["adrema", "productor"], q))
    out = j.select("adrema", "superficie", F.col("__actividad").alias("actividad"), F.col("__tenencia").alias("tenencia"),
                   "departamento", "nombre_estab", "paraje_estab", "productor", "CUITCUIL", F.col("ddjj").alias("id_ddjj"))
    return out if limit is None else top_n(out, "superficie", limit, "adrema", "id_ddjj")


def parcel_total(listing: DataFrame) -> DataFrame:
    """Total surface of the listed (limited) parcels."""
    return listing.agg(F.floor(F.coalesce(F.sum("superficie"), F.lit(0.0))).cast("bigint").alias("superficie_total"),
                       F.count(F.lit(1)).alias("adremas"))


def geo_points(cat: Catalog, departments: Sequence[str] = (), colour: str = "pondf") -> DataFrame:
    """Establishments with repaired coordinates inside the bounding
    box, their producer, damage and activity, and a colour."""
    e = cat.physical("establecimientos").filter(not_blank_or_zero("latitud") & not_blank_or_zero("longitud"))
    if departments:
        e = e.filter(in_list("departamento_estab", departments))
    j = lookup(e, [
        Dim(cat.physical("ddjj_personas"), "ddjj", "id_ddjj", {"id_ddjj": "id_ddjj", "pondf": "pondf", "id_productor": "__prod"}),
        Dim(cat.physical("productores"), "__prod", "ProductorId",
            {"ProductorDenominacion": "productor", "CUITCUIL": "CUITCUIL", "EsPrincipalActividadEconomica": "__act"}),
        Dim(cat.physical("tipoactividad"), "__act", "TipoActividadId", {"TipoActividadDesc": "actividad"}),
    ])
    j = j.withColumn("lat", repair_coord("latitud")).withColumn("lng", repair_coord("longitud"))
    j = j.filter(in_bbox("lat", "lng"))
    r, g, b = damage_rgb("pondf") if colour == "pondf" else activity_rgb("actividad")
    return j.select("id_establecimiento", "nombre_estab", "departamento_estab", "latitud", "longitud", "productor",
                    "CUITCUIL", "id_ddjj", "pondf", "actividad", "lat", "lng",
                    r.alias("r"), g.alias("g"), b.alias("b"))


def map_centre(points: DataFrame) -> DataFrame:
    """Mean latitude and longitude."""
    return points.agg(F.avg("lat").alias("lat"), F.avg("lng").alias("lng"), F.count(F.lit(1)).alias("puntos"))


# -- O14-O22: analysis page -----------------------------------------------------------
@dataclass(frozen=True)
class AnalysisFilters:
    """Analysis filters.  ``resolution`` is the id in current mode and
    the resolution *number* (compared with ``dto``) in unified mode."""
    resolution: int | str | None = None
    year: int | None = None
    origin: str | None = None


def _analysis_pred(af: AnalysisFilters, unified: bool, year_col: Column | None = None) -> Column:
    preds = [F.lit(True)]
    if af.resolution is not None:
        preds.append((F.col("dto") if unified else F.col("id_resolucion")) == F.lit(af.resolution))
    if af.year is not None:
        preds.append((F.col("anio") if unified else F.year("fecha")) == F.lit(af.year))
    if unified and af.origin:
        preds.append(F.col("origen_dato") == F.lit(af.origin))
    out = preds[0]
    for p in preds[1:]:
        out = out & p
    return out


def _needed(af: AnalysisFilters) -> list[str]:
    """The declaration columns that the filters read (unified mode)."""
    return [c for c, value in (("dto", af.resolution), ("anio", af.year)) if value is not None]


def crops(cat: Catalog, af: AnalysisFilters = AnalysisFilters()) -> DataFrame:
    """O14 (current) / O15 (unified): sown and affected surface per crop."""
    if cat.unified:
        a = cat.table_for("agricultura", *_needed(af)).filter(_analysis_pred(af, True))
        label = F.coalesce("especie", "cultivo", F.lit(UNCLASSIFIED))
        decl = F.coalesce(F.col("id_ddjj_actual").cast("string"), "ddjj_hist_id", "iddj", "codigo", "solicitud_id")
        out = agg.crop_totals(a, label, "superficie_sembrada_uso", "superficie_afectada", decl)
    else:
        a = lookup(cat.physical("agricultura"), [
            Dim(cat.physical("cultivostipo"), "tipo_cultivo", "id", {"CultivoTipoDesc": "__ct"}),
            Dim(cat.physical("cultivos"), "id_cultivo", "id", {"CultivoDesc": "__cu"}),
        ])
        d = cat.physical("ddjj_personas").select("id_ddjj", "id_resolucion", "fecha")
        a = a.join(d, a.ddjj == d.id_ddjj, "inner").filter(_analysis_pred(af, False))
        out = agg.crop_totals(a, F.coalesce("__ct", "__cu", F.lit(UNCLASSIFIED)), "sup_sembrada", "sup_afectada", F.col("ddjj"))
    return out.filter(any_positive("sembrada", "afectada"))


def crop_ranking(crop_totals: DataFrame, metric: str = "superficie afectada", n: int = DEFAULT_TOP_N,
                 min_sown: float = MIN_SOWN_FOR_PERCENT, include_unclassified: bool = False) -> DataFrame:
    """Percentage, unclassified crops excluded by default, minimum sown
    surface only for the percentage ranking, top-N, short labels."""
    order_col = CROP_METRICS[metric]
    c = crop_totals.withColumn("pct_afectado", add_percent("afectada", "sembrada")) \
                   .withColumn("sin_clasificar", is_unclassified("tipo_cultivo"))
    if not include_unclassified:
        c = c.filter(~F.col("sin_clasificar"))
    if order_col == "pct_afectado" and min_sown > 0:
        c = c.filter(at_least("sembrada", min_sown, null_as_zero=True))
    return top_n(c, order_col, n, "tipo_cultivo").withColumn("cultivo_label", short_label("tipo_cultivo"))


def crop_ranking_long(ranking: DataFrame) -> DataFrame:
    """Sown and affected as two rows per crop (chart form)."""
    return melt(ranking, ["tipo_cultivo", "cultivo_label", "pct_afectado", "registros", "ddjj"],
                ["sembrada", "afectada"], "medida", "hectareas")


def unclassified_summary(crop_totals: DataFrame) -> DataFrame:
    """Unclassified rows, declarations, surfaces and their share of the
    affected surface (denominator: all crops, before any exclusion)."""
    u = F.col("__u")
    c = crop_totals.withColumn("__u", is_unclassified("tipo_cultivo"))
    sums = c.agg(
        F.coalesce(F.sum(F.when(u, F.col("registros"))), F.lit(0)).cast("bigint").alias("registros_sd"),
        F.coalesce(F.sum(F.when(u, F.col("ddjj"))), F.lit(0)).cast("bigint").alias("ddjj_sd"),
        F.coalesce(F.sum(F.when(u, F.coalesce("sembrada", F.lit(0.0)))), F.lit(0.0)).alias("sembrada_sd"),
        F.coalesce(F.sum(F.when(u, F.coalesce("afectada", F.lit(0.0)))), F.lit(0.0)).alias("afectada_sd"),
        F.coalesce(F.sum(F.coalesce("afectada", F.lit(0.0))), F.lit(0.0)).alias("afectada_total"),
        F.count_if(u).alias("grupos_sd"))
    return sums.withColumn("pct_afectada_sd", F.when(F.col("afectada_total") != 0,
                                                     F.col("afectada_sd") / F.col("afectada_total") * 100).otherwise(0.0))


def herd(cat: Catalog, af: AnalysisFilters = AnalysisFilters(), n: int = DEFAULT_TOP_N) -> DataFrame:
    """O18 (current: 7 categories from one scan, all kept -- T13) / O19
    (unified: per coalesced category, zero categories removed); then the
    mortality rate and the top-N by stock."""
    if cat.unified:
        g = cat.table_for("ganaderia_resumen", *_needed(af)).filter(_analysis_pred(af, True))
        label = F.coalesce("categoria", "especie", "actividad", F.lit(HERD_FALLBACK))
        h = agg.herd_totals(g, label).filter(any_positive("existencias", "mortandad"))
    else:
        b = cat.physical("bovinos")
        d = cat.physical("ddjj_personas").select("id_ddjj", "id_resolucion", "fecha")
        j = b.join(d, b.idddjj == d.id_ddjj, "inner").filter(_analysis_pred(af, False))
        h = agg.herd_totals_wide(j)
    h = h.withColumn("tasa_mortandad", add_percent("mortandad", "existencias"))
    return top_n(h, "existencias", n, "categoria").withColumn("categoria_label", short_label("categoria"))


def top_improvements(cat: Catalog, af: AnalysisFilters = AnalysisFilters(), n: int = DEFAULT_TOP_N) -> DataFrame:
    """Most declared improvement types (unified mode ignores filters)."""
    pm = cat.physical("perdidas_mejoras")
    d = cat.physical("ddjj_personas").select("id_ddjj", "id_resolucion", "fecha")
    j = pm.join(d, pm.idddjj == d.id_ddjj, "inner")
    if not cat.unified:
        j = j.filter(_analysis_pred(af, False))
    out = j.groupBy("mejora").agg(F.count(F.lit(1)).alias("declaraciones"),
                                  F.round(F.avg("vestimado"), 0).alias("valor_prom"),
                                  F.round(F.avg("pesper"), 1).alias("pct_perdida_prom"))
    return top_n(out, "declaraciones", n, "mejora").withColumn("mejora_label", short_label("mejora"))


def legal_activity(cat: Catalog) -> DataFrame:
    """Producers per (legal type, activity), labels defaulted."""
    p = lookup(cat.physical("productores"), [
        Dim(cat.physical("tipojuridico"), "TipoJuridicoId", "TipoJuridicoId", {"TipoJuridicoDesc": "__tj"}),
        Dim(cat.physical("tipoactividad"), "EsPrincipalActividadEconomica", "TipoActividadId", {"TipoActividadDesc": "__ta"}),
    ])
    return (p.groupBy(F.coalesce("__tj", F.lit(UNCLASSIFIED)).alias("tipo_juridico"),
                      F.coalesce("__ta", F.lit(UNCLASSIFIED)).alias("actividad"))
             .agg(F.count(F.lit(1)).alias("n")))


def producers_by_legal_activity(cat: Catalog, mode: str = LEGAL_MODES[0], n: int = DEFAULT_TOP_N) -> DataFrame:
    """Top combinations / all / all but the dominant legal type."""
    t = legal_activity(cat)
    if mode == LEGAL_MODES[0]:
        return top_n(t, "n", n, "tipo_juridico", "actividad")
    if mode == LEGAL_MODES[2]:
        return drop_dominant(t, "tipo_juridico", "n")
    return t


def analysis_years(cat: Catalog) -> DataFrame:
    """Years offered by the analysis page."""
    if cat.unified:
        return distinct_union("anio", cat.table("agricultura"), cat.table("ganaderia_resumen")).orderBy(F.desc("anio"))
    d = cat.physical("ddjj_personas").filter(F.col("fecha").isNotNull())
    return d.select(F.year("fecha").alias("anio")).distinct().orderBy(F.desc("anio"))


# -- O23: documented starter queries ---------------------------------------------------
def producer_resolutions(cat: Catalog) -> DataFrame:
    """O23 (1): producer -> declarations -> resolutions."""
    p = cat.physical("productores").select("ProductorId", "ProductorDenominacion")
    d = cat.physical("ddjj_personas").select("id_ddjj", "id_productor", "id_resolucion", "fecha", "pondf")
    r = cat.physical("resoluciones").select("id_resolucion", "numero_resolucion", "nombre_resolucion")
    return (p.join(d, p.ProductorId == d.id_productor, "inner").join(r, "id_resolucion", "inner")
             .select("ProductorId", "ProductorDenominacion", "id_ddjj", "fecha", "pondf", "numero_resolucion",
                     "nombre_resolucion"))


def damage_by_rubro(cat: Catalog) -> DataFrame:
    """O23 (2): declarations, mean and total weighted loss per rubro."""
    p = cat.physical("ponderaciones_ddjj")
    rt = cat.physical("rubro_tipos")
    return (p.join(rt, p.rubro == rt.id_rubro, "inner").groupBy(F.col("nombre").alias("rubro"))
             .agg(F.count(F.lit(1)).alias("declaraciones"), F.sum("perdidas_ponde").alias("perdida_total"),
                  F.round(F.avg("perdidas_ponde"), 2).alias("perdida_prom")))


def volume_per_resolution(cat: Catalog) -> DataFrame:
    """O23 (3): declarations and distinct producers per resolution."""
    d = cat.physical("ddjj_personas")
    r = cat.physical("resoluciones")
    return (d.join(r, "id_resolucion", "inner").groupBy("numero_resolucion", "nombre_resolucion")
             .agg(F.count(F.lit(1)).alias("ddjj"), F.countDistinct("id_productor").alias("productores")))


def parcels_of_producer(cat: Catalog, text: str | None) -> DataFrame:
    """O23 (4): parcels with producer and activity as text, of producers whose name holds ``text`` (blank: all).

    Parcels come from the inner view, so one with a missing link isn't listed.
    """
    return parcels_inner(cat).filter(search(["productor"], text))
