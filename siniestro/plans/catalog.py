"""Catalog: logical table names -> DataFrames, current or unified.

The view SQL of the source system is not published; the historical and
unified views below are rebuilt from the columns their consumers read and
from the design notes.  Every rule that is our own decision is marked
*decision* in its docstring.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import standins
from ..session import materialize_all, removals
from ..functions.dates import year_start
from ..functions.misc import stable_id
from ..functions.text import normalize_key
from ..operators.aggregates import HERD_CATEGORIES
from ..operators.consolidate import Curated, consolidate
from ..operators.filters import CURRENT, HISTORIC
from ..operators.quality import add_quality_flags, apply_event_mapping
from ..operators.setops import melt_pairs, union_all, unify
from ..operators.windows import keep_best

# --- fixed values: logical name -> physical name per mode (M18) --------------
TABLES_CURRENT = {
    "resoluciones": "resoluciones",
    "ddjj_personas": "ddjj_personas",
    "productores": "productores",
    "tipoactividad": "tipoactividad",
    "agricultura": "agricultura",
    "cultivos": "cultivos",
    "cultivostipo": "cultivostipo",
    "ganaderia_resumen": "bovinos",
}
TABLES_UNIFIED = {
    "resoluciones": "vw_all_resoluciones",
    "ddjj_personas": "vw_all_ddjj_personas",
    "productores": "vw_all_productores",
    "tipoactividad": "vw_all_tipoactividad",
    "agricultura": "vw_all_agricultura",
    "cultivos": "vw_all_cultivos",
    "cultivostipo": "vw_all_cultivostipo",
    "ganaderia_resumen": "vw_all_ganaderia_resumen",
}
HISTORIC_VIEWS = ["vw_hist_resoluciones", "vw_hist_ddjj_personas", "vw_hist_productores", "vw_hist_tipoactividad",
                  "vw_hist_agricultura", "vw_hist_cultivostipo", "vw_hist_cultivos", "vw_hist_ganaderia_resumen"]
UNIFIED_VIEWS = list(TABLES_UNIFIED.values())
MODE_CURRENT, MODE_UNIFIED = "actual", "unificado"
HISTORIC_STATE = "historico"
# -----------------------------------------------------------------------------


def resolve(name: str, mode: str = MODE_CURRENT) -> str:
    """Logical -> physical name; unknown names map to themselves and
    only ``unificado`` switches to the unified views."""
    mapping = TABLES_UNIFIED if (mode or "").lower() == MODE_UNIFIED else TABLES_CURRENT
    return mapping.get(name, name)


_STAGED: list[tuple[DataFrame, DataFrame, int, Curated]] = []
"""Consolidations written in this process, with the inputs they were made of."""


def staged_for(raw: DataFrame, registry: DataFrame) -> Curated | None:
    """The tables staged from the same inputs (same plan over the same files)."""
    application = raw.sparkSession.sparkContext.applicationId
    for known_raw, known_registry, removed, curated in _STAGED:
        if (known_raw.sparkSession.sparkContext.applicationId == application and removed == removals(raw.sparkSession)
                and known_raw.sameSemantics(raw) and known_registry.sameSemantics(registry)):
            return curated
    return None


DECLARATION_CONTEXT = ("vw_all_agricultura", "vw_all_ganaderia_resumen")
"""Views that join the declarations for ``dto`` and ``anio`` alone."""


class Catalog:
    """Lazy resolver over the operational star and the historical pipeline.

    ``frames`` may pre-supply any physical table (e.g. Parquet tables of a
    real deployment); everything else falls back to the stand-ins built from
    ``sf_dir``.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, mode: str = MODE_CURRENT,
                 frames: dict[str, DataFrame] | None = None, staged: bool = True):
        self.spark, self.sf_dir, self.mode = spark, sf_dir, mode
        self._frames = dict(frames or {})
        self._bare: dict[str, DataFrame] = {}
        self.staged = staged

    @property
    def unified(self) -> bool:
        return self.mode == MODE_UNIFIED

    def physical(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name.startswith(("vw_hist_", "vw_all_")):
                self._frames[name] = getattr(self, name)()
            else:
                self._frames[name] = standins.standin(self.spark, self.sf_dir, name)
        return self._frames[name]

    def table(self, logical: str) -> DataFrame:
        return self.physical(resolve(logical, self.mode))

    def table_for(self, logical: str, *columns: str) -> DataFrame:
        """:meth:`table` for a consumer of ``columns`` (beyond the table's own
        measures): joins that only bring other columns are left out, and those
        columns are null."""
        name = resolve(logical, self.mode)
        if name not in DECLARATION_CONTEXT or name in self._frames or {"dto", "anio"} & set(columns):
            return self.physical(name)
        if name not in self._bare:
            self._bare[name] = getattr(self, name)(context=False)
        return self._bare[name]

    def names(self) -> list[str]:
        return sorted(set(standins.STANDINS) | set(HISTORIC_VIEWS) | set(UNIFIED_VIEWS) | set(self._frames))

    # -- historical pipeline --------------------------------------------------
    @cached_property
    def raw_clean(self) -> DataFrame:
        """Harmonised historical rows: registry mapping + quality flags."""
        raw = self.physical("raw_rows")
        return add_quality_flags(apply_event_mapping(raw, self.physical("registro_eventos")))

    @cached_property
    def curated(self) -> Curated:
        """The consolidation.  With ``staged=True`` its tables are those that
        :meth:`stage` wrote to the shared checkpoint folder (as the source
        system stages its curated tables), and every report reads them."""
        if not self.staged:
            return consolidate(self.raw_clean, self.physical("registro_eventos"))
        return self.stage()

    def stage(self) -> Curated:
        """Write the consolidation of this catalog's own inputs, unless it was
        written from the same inputs before in this process."""
        raw, registry = self.physical("raw_rows"), self.physical("registro_eventos")
        curated = staged_for(raw, registry)
        if curated is None:
            curated = consolidate(self.raw_clean, registry,
                                  stage_many=lambda frames: materialize_all(frames, "curated"))
            _STAGED.append((raw, registry, removals(self.spark), curated))
        return curated

    @property
    def consolidated(self) -> DataFrame:
        return self.curated.same_level.consolidated

    # -- historical views (M1-M8) ----------------------------------------------
    def vw_hist_resoluciones(self) -> DataFrame:
        """M1: one resolution per event (*decision*: grouped per event so the
        key is unique; number = smallest decree, date = 1 Jan of the year)."""
        # the few distinct combinations first (hashed); text minima need a sort
        c = self.consolidated.select("evento_id", "dto", "anio", "evento_nombre").distinct()
        return (c.groupBy("evento_id").agg(F.min("dto").alias("numero_resolucion"), F.min("anio").alias("anio"),
                                           F.min("evento_nombre").alias("nombre_resolucion"))
                 .select(F.col("evento_id").alias("id_resolucion"), "numero_resolucion", "nombre_resolucion",
                         year_start("anio").alias("fec_res"), "evento_id", "anio"))

    @staticmethod
    def _ddjj_hist_id():
        """*decision*: event+code; a row without a code is known by the
        identity it is deduplicated on (a hash of producer and production),
        with the declaration id in front where there is one.  Unique per
        consolidated row."""
        code, iddj = normalize_key("codigo"), normalize_key("iddj")
        identity = stable_id("productor_nombre", "documento_nro", "departamento", "actividad", "cultivo")
        return (F.when(code != "", F.concat_ws("|", "evento_id", F.lit("C"), code))
                 .when(iddj != "", F.concat_ws("|", "evento_id", F.lit("I"), iddj, identity))
                 .otherwise(F.concat_ws("|", "evento_id", F.lit("H"), identity)))

    @staticmethod
    def _productor_hist_id():
        return stable_id("documento_nro", "cuit_cuil", "productor_nombre")

    def vw_hist_ddjj_personas(self) -> DataFrame:
        """M2: each consolidated row as a declaration (*decision*: damage =
        livestock %, else agricultural %; state ``historico``)."""
        c = self.consolidated
        return c.select(
            self._ddjj_hist_id().alias("ddjj_hist_id"), year_start("anio").alias("fecha"),
            F.coalesce("porcentaje_afectacion_ganadera", "porcentaje_afectacion").alias("pondf"),
            F.col("evento_id").alias("id_resolucion"), self._productor_hist_id().alias("id_productor"),
            F.lit(None).cast("string").alias("provincia"), "departamento", "localidad", "paraje",
            F.lit(None).cast("int").alias("cargado"), F.lit(HISTORIC_STATE).alias("estado"),
            "evento_id", "source_file", "source_sheet", "severidad_maxima", "dto", "anio")

    def vw_hist_productores(self) -> DataFrame:
        """M3: producers deduplicated on hash(doc, cuit, name), first ingest wins."""
        c = self.consolidated.select(self._productor_hist_id().alias("productor_hist_id"), "productor_nombre",
                                     "cuit_cuil", "documento_nro", "actividad", "renspa", "row_id",
                                     F.lit(0.0).alias("__p"))
        best = keep_best(c, "productor_hist_id", "__p", "row_id")
        return best.select("productor_hist_id", F.col("productor_nombre").alias("ProductorDenominacion"),
                           F.col("cuit_cuil").alias("CUITCUIL"), F.col("documento_nro").alias("DocumentoNro"),
                           F.col("actividad").alias("actividad"), "renspa")

    def vw_hist_tipoactividad(self) -> DataFrame:
        """M4: distinct activities."""
        return (self.consolidated.filter(F.col("actividad").isNotNull()).select("actividad").distinct()
                .select(F.col("actividad").alias("actividad_hist_id"), F.col("actividad").alias("TipoActividadDesc")))

    def vw_hist_agricultura(self) -> DataFrame:
        """M5: agricultural detail rows plus consolidated rows that carry a
        crop or an agricultural surface."""
        cols = lambda df, src: df.select(
            F.concat_ws("|", F.lit(src), F.col("row_id").cast("string")).alias("agricultura_hist_id"),
            self._ddjj_hist_id().alias("ddjj_hist_id"), "evento_id", "especie", "cultivo",
            F.coalesce("superficie_plantada_sembrada", "superficie_agricola_uso").alias("superficie_sembrada_uso"),
            F.coalesce("superficie_afectada", "superficie_agricola_afectada").alias("superficie_afectada"),
            "iddj", "codigo", "solicitud_id", "dto", "anio")
        c = self.consolidated.filter(F.col("cultivo").isNotNull() | F.col("superficie_agricola_uso").isNotNull()
                                     | F.col("superficie_agricola_afectada").isNotNull())
        return union_all([cols(self.curated.complementary.detail, "D"), cols(c, "C")])

    def vw_hist_cultivostipo(self) -> DataFrame:
        """M6: distinct species (crop type)."""
        a = self.vw_hist_agricultura().filter(F.col("especie").isNotNull()).select("especie").distinct()
        return a.select(F.col("especie").alias("cultivo_tipo_hist_id"), F.col("especie").alias("CultivoTipoDesc"))

    def vw_hist_cultivos(self) -> DataFrame:
        """M7: distinct crops."""
        a = self.vw_hist_agricultura().filter(F.col("cultivo").isNotNull()).select("cultivo").distinct()
        return a.select(F.col("cultivo").alias("cultivo_hist_id"), F.col("cultivo").alias("CultivoDesc"))

    def vw_hist_ganaderia_resumen(self) -> DataFrame:
        """M8: livestock totals only -- never spread over herd categories."""
        c = self.consolidated.filter(F.col("existencias").isNotNull() | F.col("mortandad").isNotNull())
        return c.select(F.concat_ws("|", F.lit("G"), F.col("row_id").cast("string")).alias("ganaderia_hist_id"),
                        self._ddjj_hist_id().alias("ddjj_hist_id"), "evento_id", "categoria", "especie", "actividad",
                        "existencias", "mortandad", "dto", "anio")

    # -- unified views (M9-M16) -------------------------------------------------
    def _decl_context(self) -> DataFrame:
        """Current declarations with their resolution number and year, for
        fact branches that need ``dto`` / ``anio``."""
        d = self.physical("ddjj_personas").select("id_ddjj", "id_resolucion", "fecha")
        r = self.physical("resoluciones").select("id_resolucion", "numero_resolucion")
        return d.join(r, "id_resolucion", "left").select(
            F.col("id_ddjj").alias("__id"), F.col("numero_resolucion").alias("dto"), F.year("fecha").alias("anio"))

    def vw_all_resoluciones(self) -> DataFrame:
        cur = self.physical("resoluciones").select(
            F.concat(F.lit("A-"), F.col("id_resolucion").cast("string")).alias("resolucion_all_id"),
            "nombre_resolucion", "numero_resolucion", "fec_res",
            F.col("id_resolucion").alias("id_resolucion_actual"), F.lit(None).cast("string").alias("evento_id"))
        hist = self.vw_hist_resoluciones().select(
            F.concat(F.lit("H-"), F.col("evento_id")).alias("resolucion_all_id"), "nombre_resolucion",
            "numero_resolucion", "fec_res", F.lit(None).cast("int").alias("id_resolucion_actual"), "evento_id")
        return unify(cur, hist)

    def vw_all_ddjj_personas(self) -> DataFrame:
        cur = self.physical("ddjj_personas").select(
            F.concat(F.lit("A-"), F.col("id_ddjj").cast("string")).alias("ddjj_all_id"), "fecha", "pondf",
            "departamento", F.col("id_resolucion").alias("id_resolucion_actual"),
            F.lit(None).cast("string").alias("evento_id"), F.col("id_ddjj").alias("id_ddjj_actual"),
            F.lit(None).cast("string").alias("ddjj_hist_id"), "estado")
        hist = self.vw_hist_ddjj_personas().select(
            F.concat(F.lit("H-"), F.col("ddjj_hist_id")).alias("ddjj_all_id"), "fecha", "pondf", "departamento",
            F.lit(None).cast("int").alias("id_resolucion_actual"), "evento_id",
            F.lit(None).cast("bigint").alias("id_ddjj_actual"), "ddjj_hist_id", "estado")
        return unify(cur, hist)

    def vw_all_productores(self) -> DataFrame:
        cur = self.physical("productores").select(
            F.concat(F.lit("A-"), F.col("ProductorId").cast("string")).alias("productor_all_id"),
            "ProductorDenominacion", "CUITCUIL", "DocumentoNro")
        hist = self.vw_hist_productores().select(
            F.concat(F.lit("H-"), F.col("productor_hist_id")).alias("productor_all_id"),
            "ProductorDenominacion", "CUITCUIL", "DocumentoNro")
        return unify(cur, hist)

    def vw_all_tipoactividad(self) -> DataFrame:
        cur = self.physical("tipoactividad").select(
            F.concat(F.lit("A-"), F.col("TipoActividadId").cast("string")).alias("actividad_all_id"), "TipoActividadDesc")
        hist = self.vw_hist_tipoactividad().select(
            F.concat(F.lit("H-"), F.col("actividad_hist_id")).alias("actividad_all_id"), "TipoActividadDesc")
        return unify(cur, hist)

    def _in_context(self, fact: DataFrame, key: str, context: bool) -> DataFrame:
        """``fact`` with ``dto`` and ``anio`` of its declaration, or nulls without the join."""
        known = self._decl_context()
        if context:
            return fact.join(known, fact[key] == F.col("__id"), "left")
        return fact.withColumns({c: F.lit(None).cast(known.schema[c].dataType) for c in ("dto", "anio")})

    def vw_all_agricultura(self, context: bool = True) -> DataFrame:
        a = self._in_context(self.physical("agricultura"), "ddjj", context)
        ct = self.physical("cultivostipo").select(F.col("id").alias("__ct"), F.col("CultivoTipoDesc").alias("especie"))
        cu = self.physical("cultivos").select(F.col("id").alias("__cu"), F.col("CultivoDesc").alias("cultivo"))
        cur = (a.join(ct, a.tipo_cultivo == F.col("__ct"), "left").join(cu, a.id_cultivo == F.col("__cu"), "left")
                .select(F.concat(F.lit("A-"), F.col("id_agricultura").cast("string")).alias("agricultura_all_id"),
                        "especie", "cultivo", F.col("sup_sembrada").alias("superficie_sembrada_uso"),
                        F.col("sup_afectada").alias("superficie_afectada"), F.col("ddjj").alias("id_ddjj_actual"),
                        F.lit(None).cast("string").alias("ddjj_hist_id"), F.lit(None).cast("string").alias("iddj"),
                        F.lit(None).cast("string").alias("codigo"), F.lit(None).cast("string").alias("solicitud_id"),
                        "dto", "anio"))
        hist = self.vw_hist_agricultura().select(
            F.concat(F.lit("H-"), F.col("agricultura_hist_id")).alias("agricultura_all_id"), "especie", "cultivo",
            "superficie_sembrada_uso", "superficie_afectada", F.lit(None).cast("bigint").alias("id_ddjj_actual"),
            "ddjj_hist_id", "iddj", "codigo", "solicitud_id", "dto", "anio")
        return unify(cur, hist)

    def vw_all_cultivos(self) -> DataFrame:
        cur = self.physical("cultivos").select(
            F.concat(F.lit("A-"), F.col("id").cast("string")).alias("cultivo_all_id"), "CultivoDesc")
        hist = self.vw_hist_cultivos().select(
            F.concat(F.lit("H-"), F.col("cultivo_hist_id")).alias("cultivo_all_id"), "CultivoDesc")
        return unify(cur, hist)

    def vw_all_cultivostipo(self) -> DataFrame:
        cur = self.physical("cultivostipo").select(
            F.concat(F.lit("A-"), F.col("id").cast("string")).alias("cultivo_tipo_all_id"), "CultivoTipoDesc")
        hist = self.vw_hist_cultivostipo().select(
            F.concat(F.lit("H-"), F.col("cultivo_tipo_hist_id")).alias("cultivo_tipo_all_id"), "CultivoTipoDesc")
        return unify(cur, hist)

    def vw_all_ganaderia_resumen(self, context: bool = True) -> DataFrame:
        """Current branch = cattle table melted to the 7 categories."""
        known = self._in_context(self.physical("bovinos"), "idddjj", context)
        b = melt_pairs(known, ["idddjj", "dto", "anio"], HERD_CATEGORIES, "categoria", "existencias", "mortandad",
                       cast="double")
        cur = (b.select(F.concat_ws("-", F.lit("A"), F.col("idddjj").cast("string"), F.col("categoria")).alias("ganaderia_all_id"),
                        "categoria", F.lit("BOVINOS").alias("especie"), F.lit("GANADERIA").alias("actividad"),
                        F.col("existencias").cast("double").alias("existencias"),
                        F.col("mortandad").cast("double").alias("mortandad"), "dto", "anio"))
        hist = self.vw_hist_ganaderia_resumen().select(
            F.concat(F.lit("H-"), F.col("ganaderia_hist_id")).alias("ganaderia_all_id"), "categoria", "especie",
            "actividad", "existencias", "mortandad", "dto", "anio")
        return unify(cur, hist)

    def register_views(self, names: list[str] | None = None) -> list[str]:
        """Register every expected view as a temp view; returns the
        names that could not be built (empty when all are present)."""
        failed = []
        for name in names or (HISTORIC_VIEWS + UNIFIED_VIEWS):
            try:
                self.physical(name).createOrReplaceTempView(name)
            except Exception:  # noqa: BLE001 -- reported, one view never stops the rest
                failed.append(name)
        return failed
