"""DuckDB spellings of the scalar functions, for the oracle SQL texts.

Each helper takes a SQL expression and returns a DuckDB expression with the
same meaning as the native Spark function of the same name.
"""

from __future__ import annotations

from .functions.text import (KEY_NULL_TOKENS, TEXT_NULL_TOKENS, UNCLASSIFIED_TOKENS, WS)


def _in(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def rstrip(x: str) -> str:
    return f"regexp_replace({x}, '{WS}+$', '', 'g')"


def upper(x: str) -> str:
    """Upper-case the way Python and the JVM do it (``ß`` -> ``SS``)."""
    return f"upper(replace({x}, 'ß', 'SS'))"


def clean_text(x: str) -> str:
    t = strip(f"CAST({x} AS VARCHAR)")
    collapsed = f"regexp_replace({t}, '{WS}+', ' ', 'g')"
    return (f"(CASE WHEN {x} IS NULL OR {t} = '' OR lower({t}) IN {_in(TEXT_NULL_TOKENS)} THEN NULL "
            f"ELSE {upper(collapsed)} END)")


def normalize_key(x: str) -> str:
    t = upper(strip(f"CAST({x} AS VARCHAR)"))
    folded = f"trim(regexp_replace(strip_accents({t}), '[^A-Z0-9]+', '_', 'g'), '_')"
    return f"(CASE WHEN {x} IS NULL OR {t} = '' OR {t} IN {_in(KEY_NULL_TOKENS)} THEN '' ELSE {folded} END)"


def short_label(x: str, n: int = 48) -> str:
    t = strip(f"(CASE WHEN {x} IS NULL OR {x} = '' THEN '(s/d)' ELSE {x} END)")
    return f"(CASE WHEN length({t}) <= {n} THEN {t} ELSE {rstrip(f'substr({t}, 1, {n - 1})')} || '...' END)"


def is_unclassified(x: str) -> str:
    return f"(lower({strip(f'COALESCE(CAST({x} AS VARCHAR), {chr(39)}{chr(39)})')}) IN {_in(UNCLASSIFIED_TOKENS)})"


def add_percent(num: str, den: str) -> str:
    return f"(CASE WHEN COALESCE({den}, 0) > 0 THEN COALESCE({num}, 0) / {den} * 100.0 ELSE 0.0 END)"


def repair_coord(x: str) -> str:
    s = strip(f"CAST({x} AS VARCHAR)")
    val = f"TRY_CAST({s} AS DOUBLE)"
    digits = f"replace(regexp_replace({s}, '^-+', ''), '.', '')"
    fixed = (f"((CASE WHEN starts_with({s}, '-') THEN -1.0 ELSE 1.0 END) * "
             f"TRY_CAST(substr({digits}, 1, 2) || '.' || substr({digits}, 3) AS DOUBLE))")
    return (f"(CASE WHEN {s} IS NULL OR {s} IN ('', '0', '0.0', 'NULL') OR {val} IS NULL THEN NULL "
            f"WHEN {val} >= -180 AND {val} <= 180 AND {val} <> 0 THEN {val} "
            f"WHEN length({digits}) < 3 THEN NULL "
            f"WHEN {fixed} >= -180 AND {fixed} <= 180 THEN {fixed} END)")


def stable_id(*cols: str) -> str:
    parts = ", ".join(f"COALESCE(CAST(length(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '~')"
                      for c in cols)
    return f"sha256(concat_ws('||', {parts}))"


def damage_red(x: str) -> str:
    return f"CAST(floor(LEAST(GREATEST(COALESCE(TRY_CAST({x} AS DOUBLE), 0.0), 0.0), 100.0) / 100.0 * 255.0) AS INT)"


def clean_numeric(x: str) -> str:
    s = f"regexp_replace(CAST({x} AS VARCHAR), '[^0-9,.\\-]', '', 'g')"
    both = f"(strpos({s}, ',') > 0 AND strpos({s}, '.') > 0)"
    norm = (f"(CASE WHEN {both} THEN (CASE WHEN regexp_matches({s}, ',[^.]*$') "
            f"THEN replace(replace({s}, '.', ''), ',', '.') ELSE replace({s}, ',', '') END) "
            f"WHEN strpos({s}, ',') > 0 THEN replace({s}, ',', '.') ELSE {s} END)")
    return f"(CASE WHEN {x} IS NULL OR {s} IN ('', '-', '.', ',') THEN NULL ELSE TRY_CAST({norm} AS DOUBLE) END)"


def extract_year(x: str) -> str:
    return f"CAST(NULLIF(regexp_extract(CAST({x} AS VARCHAR), '(19|20)\\d{{2}}', 0), '') AS INT)"


def extract_decree(x: str) -> str:
    blanked = f"regexp_replace(CAST({x} AS VARCHAR), '\\b(19|20)\\d{{2}}\\b', ' ', 'g')"
    return f"NULLIF(regexp_extract({blanked}, '\\d{{1,5}}(?:[-/]\\d{{1,5}})*', 0), '')"


def build_period(y: str, d: str) -> str:
    return f"NULLIF(COALESCE(CAST({y} AS VARCHAR), '') || COALESCE('-' || {d}, ''), '')"


def py_number_text(x: str) -> str:
    return (f"(CASE WHEN {x} = floor({x}) AND abs({x}) < 1e16 THEN CAST(CAST(floor({x}) AS BIGINT) AS VARCHAR) || '.0' "
            f"ELSE CAST({x} AS VARCHAR) END)")


# -- historical pipeline as DuckDB CTEs (raw rows -> flags -> consolidation) --------------
SURFACES = ["superficie_total", "superficie_agricola_uso", "superficie_agricola_afectada",
            "superficie_ganadera_uso", "superficie_ganadera_afectada"]


# harmonised columns the historical stand-in rows do not carry (typed nulls)
ABSENT_TEXT = ["fecha_origen", "source_sheet", "solicitud_id", "cuit_cuil", "localidad", "paraje", "seccion", "renspa",
               "observaciones"]
ABSENT_NUM = ["produccion_estimada", "produccion_obtenida", "superficie_plantada_sembrada", "superficie_afectada",
              "porcentaje_afectacion"]


def hist_ctes(harmonised: bool = False) -> str:
    """CTEs ``raw_clean``, ``inputs``, ``same``, ``consolidated``, ``principal_all``,
    ``principal``, ``detail_all``, ``detail`` (after the stand-in CTEs).
    ``harmonised``: ``raw_rows`` has every harmonised column (but the period),
    not only those of the stand-in."""
    nk = normalize_key
    event = "COALESCE(g.evento_id, r.evento_id)" if harmonised else "g.evento_id"
    y = extract_year
    new_year = y(f"COALESCE(CAST(g.anio_inicio AS VARCHAR), CAST({y(event)} AS VARCHAR), "
                 f"CAST({y('r.source_file')} AS VARCHAR), CAST(r.anio AS VARCHAR))")
    neg = " OR ".join(f"COALESCE({c} < 0, false)" for c in SURFACES)
    aff = "COALESCE(superficie_agricola_afectada, 0.0) + COALESCE(superficie_ganadera_afectada, 0.0)"
    known = "r.* EXCLUDE (evento_id)" if harmonised else "r.*"
    absent = "" if harmonised else ", CAST(NULL AS VARCHAR) AS dto, " + ", ".join([f"CAST(NULL AS VARCHAR) AS {c}" for c in ABSENT_TEXT] + [f"CAST(NULL AS DOUBLE) AS {c}" for c in ABSENT_NUM])
    return f""",
mapped AS (
  SELECT {known}, {event} AS evento_id, g.dataset_role AS dataset_role, g.relation_type AS relation_type,
         {new_year} AS anio_new{absent}
  FROM raw_rows r LEFT JOIN registro_eventos g ON g.source_file = r.source_file),
flagged AS (
  SELECT * EXCLUDE (anio, anio_new), anio_new AS anio,
         (anio IS NOT NULL AND anio_new IS NOT NULL AND anio <> anio_new) AS flag_anio_corregido,
         {build_period('anio_new', 'dto')} AS periodo,
         (anio_new IS NULL OR anio_new < 1998 OR anio_new > 2019) AS flag_anio_fuera_rango,
         ({neg}) AS flag_superficie_negativa,
         COALESCE(superficie_agricola_afectada > superficie_agricola_uso, false) AS flag_agricola_afectada_mayor_uso,
         COALESCE(superficie_ganadera_afectada > superficie_ganadera_uso, false) AS flag_ganadera_afectada_mayor_uso,
         COALESCE(mortandad > existencias, false) AS flag_mortandad_mayor_existencias,
         (superficie_total IS NOT NULL AND ({aff}) > 0 AND COALESCE(superficie_total < ({aff}), false))
           AS flag_superficie_total_menor_afectadas
  FROM mapped),
raw_clean AS (
  SELECT *, CASE
      WHEN flag_anio_fuera_rango OR flag_superficie_negativa OR flag_mortandad_mayor_existencias OR evento_id IS NULL THEN 'critico'
      WHEN flag_ganadera_afectada_mayor_uso OR (flag_superficie_total_menor_afectadas AND dataset_role = 'principal') THEN 'alto'
      WHEN flag_agricola_afectada_mayor_uso AND dataset_role = 'principal' THEN 'medio'
      WHEN flag_agricola_afectada_mayor_uso AND dataset_role = 'detalle_agricola' THEN 'estructural'
      ELSE 'ok' END AS severidad_maxima
  FROM flagged),
raw_clean_r AS (SELECT *, severidad_maxima IN ('critico', 'alto', 'medio') AS flag_revision_manual FROM raw_clean),
inputs AS (
  SELECT rc.* EXCLUDE (evento_id, dataset_role, relation_type),
         COALESCE(g.evento_id, rc.evento_id, rc.periodo) AS evento_id,
         COALESCE(rc.dataset_role, 'desconocido') AS dataset_role,
         COALESCE(rc.relation_type, 'standalone') AS relation_type,
         COALESCE(g.evento_nombre, COALESCE(g.evento_id, rc.evento_id, rc.periodo)) AS evento_nombre,
         COALESCE(CAST(g.prioridad AS DOUBLE), 0.0) AS prioridad,
         g.source_file IS NULL AS sin_event_mapping
  FROM raw_clean_r rc LEFT JOIN registro_eventos g ON g.source_file = rc.source_file),
same AS (
  SELECT *, CASE WHEN {nk('codigo')} <> '' THEN 'codigo' ELSE 'alternativa' END AS dedup_key_type,
         {nk('evento_id')} || '||' || CASE WHEN {nk('codigo')} <> '' THEN 'CODIGO||' || {nk('codigo')}
           ELSE 'ALTERNATIVA||' || concat_ws('|', {nk('documento_nro')}, {nk('productor_nombre')}, {nk('departamento')},
                                             {nk('actividad')}, {nk('cultivo')}) END AS dedup_key
  FROM inputs WHERE relation_type IN ('consolidate_same_level', 'standalone')),
consolidated AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY dedup_key ORDER BY prioridad DESC, row_id) AS rn
                              FROM same) WHERE rn = 1),
principal_all AS (
  SELECT *, {nk('evento_id')} AS evento_id_norm, {nk('iddj')} AS iddj_norm,
         {nk('evento_id')} || '||' || CASE WHEN {nk('iddj')} <> '' THEN 'IDDJ||' || {nk('iddj')}
           ELSE 'ALTERNATIVA||' || concat_ws('|', {nk('documento_nro')}, {nk('productor_nombre')}, {nk('departamento')}) END
           AS principal_key
  FROM inputs WHERE relation_type = 'complementary_detail' AND dataset_role = 'principal'),
principal AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY principal_key ORDER BY prioridad DESC, row_id) AS rn
                              FROM principal_all) WHERE rn = 1),
detail_all AS (
  SELECT *, {nk('evento_id')} AS evento_id_norm, {nk('iddj')} AS iddj_norm,
         concat_ws('||', {nk('evento_id')}, {nk('iddj')}, {nk('especie')}, {nk('categoria')}) AS detalle_key
  FROM inputs WHERE relation_type = 'complementary_detail' AND dataset_role = 'detalle_agricola'),
detail AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY detalle_key ORDER BY prioridad DESC, row_id) AS rn
                              FROM detail_all) WHERE rn = 1)
"""


def _ddjj_hist_id() -> str:
    nk = normalize_key
    who = stable_id('productor_nombre', 'documento_nro', 'departamento', 'actividad', 'cultivo')
    return (f"(CASE WHEN {nk('codigo')} <> '' THEN concat_ws('|', evento_id, 'C', {nk('codigo')}) "
            f"WHEN {nk('iddj')} <> '' THEN concat_ws('|', evento_id, 'I', {nk('iddj')}, {who}) "
            f"ELSE concat_ws('|', evento_id, 'H', {who}) END)")


HERD = [("Vacas", "cantivaca", "mortavaca"), ("Vaquillonas", "cantivaqui", "mortavaqui"),
        ("Terneros", "cantiterne", "mortaterne"), ("Novillos", "cantinovi", "mortanovi"),
        ("Novillitos", "cantinovilli", "mortanovilli"), ("Toros", "cantitoro", "mortatoro"),
        ("Bufalos", "cantibufa", "mortabufa")]


def view_ctes() -> str:
    """Historical and unified views (after ``hist_ctes``)."""
    agri_cols = ("evento_id, especie, cultivo, COALESCE(superficie_plantada_sembrada, superficie_agricola_uso) AS superficie_sembrada_uso, "
                 "COALESCE(superficie_afectada, superficie_agricola_afectada) AS superficie_afectada, iddj, codigo, solicitud_id, dto, anio")
    herd = " UNION ALL ".join(f"SELECT idddjj, '{lab}' AS categoria, {st} AS existencias, {de} AS mortandad FROM bovinos"
                              for lab, st, de in HERD)
    return f""",
vw_hist_resoluciones AS (
  SELECT evento_id AS id_resolucion, MIN(dto) AS numero_resolucion, MIN(evento_nombre) AS nombre_resolucion,
         make_date(MIN(anio), 1, 1) AS fec_res, evento_id, MIN(anio) AS anio
  FROM consolidated GROUP BY evento_id),
vw_hist_ddjj_personas AS (
  SELECT {_ddjj_hist_id()} AS ddjj_hist_id, make_date(anio, 1, 1) AS fecha,
         COALESCE(porcentaje_afectacion_ganadera, porcentaje_afectacion) AS pondf, evento_id AS id_resolucion,
         {stable_id('documento_nro', 'cuit_cuil', 'productor_nombre')} AS id_productor,
         departamento, 'historico' AS estado, evento_id, source_file, severidad_maxima, dto, anio
  FROM consolidated),
vw_hist_agricultura AS (
  SELECT 'D|' || CAST(row_id AS VARCHAR) AS agricultura_hist_id, {_ddjj_hist_id()} AS ddjj_hist_id, {agri_cols} FROM detail
  UNION ALL
  SELECT 'C|' || CAST(row_id AS VARCHAR), {_ddjj_hist_id()}, {agri_cols} FROM consolidated
  WHERE cultivo IS NOT NULL OR superficie_agricola_uso IS NOT NULL OR superficie_agricola_afectada IS NOT NULL),
vw_hist_ganaderia_resumen AS (
  SELECT 'G|' || CAST(row_id AS VARCHAR) AS ganaderia_hist_id, {_ddjj_hist_id()} AS ddjj_hist_id, evento_id, categoria,
         especie, actividad, existencias, mortandad, dto, anio
  FROM consolidated WHERE existencias IS NOT NULL OR mortandad IS NOT NULL),
decl_ctx AS (
  SELECT d.id_ddjj AS ctx_id, r.numero_resolucion AS dto, CAST(year(d.fecha) AS INT) AS anio
  FROM ddjj_personas d LEFT JOIN resoluciones r ON r.id_resolucion = d.id_resolucion),
vw_all_resoluciones AS (
  SELECT 'A-' || CAST(id_resolucion AS VARCHAR) AS resolucion_all_id, nombre_resolucion, numero_resolucion, fec_res,
         id_resolucion AS id_resolucion_actual, CAST(NULL AS VARCHAR) AS evento_id, 'actual' AS origen_dato FROM resoluciones
  UNION ALL
  SELECT 'H-' || evento_id, nombre_resolucion, numero_resolucion, fec_res, NULL, evento_id, 'historico' FROM vw_hist_resoluciones),
vw_all_ddjj_personas AS (
  SELECT 'A-' || CAST(id_ddjj AS VARCHAR) AS ddjj_all_id, fecha, pondf, departamento, id_resolucion AS id_resolucion_actual,
         CAST(NULL AS VARCHAR) AS evento_id, id_ddjj AS id_ddjj_actual, CAST(NULL AS VARCHAR) AS ddjj_hist_id, estado,
         'actual' AS origen_dato FROM ddjj_personas
  UNION ALL
  SELECT 'H-' || ddjj_hist_id, fecha, pondf, departamento, NULL, evento_id, NULL, ddjj_hist_id, estado, 'historico'
  FROM vw_hist_ddjj_personas),
vw_all_agricultura AS (
  SELECT 'A-' || CAST(a.id_agricultura AS VARCHAR) AS agricultura_all_id, ct.CultivoTipoDesc AS especie, c.CultivoDesc AS cultivo,
         a.sup_sembrada AS superficie_sembrada_uso, a.sup_afectada AS superficie_afectada, a.ddjj AS id_ddjj_actual,
         CAST(NULL AS VARCHAR) AS ddjj_hist_id, CAST(NULL AS VARCHAR) AS iddj, CAST(NULL AS VARCHAR) AS codigo,
         CAST(NULL AS VARCHAR) AS solicitud_id, x.dto, x.anio, 'actual' AS origen_dato
  FROM agricultura a LEFT JOIN cultivostipo ct ON ct.id = a.tipo_cultivo LEFT JOIN cultivos c ON c.id = a.id_cultivo
  LEFT JOIN decl_ctx x ON x.ctx_id = a.ddjj
  UNION ALL
  SELECT 'H-' || agricultura_hist_id, especie, cultivo, superficie_sembrada_uso, superficie_afectada, NULL, ddjj_hist_id,
         iddj, codigo, solicitud_id, dto, anio, 'historico' FROM vw_hist_agricultura),
vw_all_ganaderia_resumen AS (
  SELECT 'A-' || CAST(h.idddjj AS VARCHAR) || '-' || h.categoria AS ganaderia_all_id, h.categoria, 'BOVINOS' AS especie,
         'GANADERIA' AS actividad, CAST(h.existencias AS DOUBLE) AS existencias, CAST(h.mortandad AS DOUBLE) AS mortandad,
         x.dto, x.anio, 'actual' AS origen_dato
  FROM ({herd}) h LEFT JOIN decl_ctx x ON x.ctx_id = h.idddjj
  UNION ALL
  SELECT 'H-' || ganaderia_hist_id, categoria, especie, actividad, existencias, mortandad, dto, anio, 'historico'
  FROM vw_hist_ganaderia_resumen)
"""
