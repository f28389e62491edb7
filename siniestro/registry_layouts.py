"""Registered queries of the sheet layouts (A2, A7, B0-B12) and their DuckDB SQL.

The SQL is written from the layouts' rules (which header feeds which column),
over the same cells as ``sources.sheets`` makes; it shares no code with
``plans.layouts``.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from . import oracle as Q
from .plans.harmonise import harmonise, harmonise_landing, harmonise_workbook
from .schema import NUMERIC_COLUMNS, OUTPUT_COLUMNS, TEXT_COLUMNS
from .session import checkpoint_dir
from .sources.cells import cells_of, inventory
from .sources.landing import write_csv
from .sources.sheets import TESTDATA_FORMATS, testdata_workbooks

K = "CAST(o_orderkey AS VARCHAR)"
NAME = "CASE WHEN o_orderkey % 9 = 0 THEN ' s/d ' ELSE '  ' || c_name || ' ' END"
DOC = "lpad(CAST(c_custkey AS VARCHAR), 8, '0')"
ORDERS = "orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey"

LINES = """(SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice,
 l_quantity, l_shipdate) AS nth FROM lineitem) li"""


def _num(expr: str, mod: int, mark: str = ",") -> str:
    whole = f"CAST(floor({expr}) AS BIGINT)"
    return f"CAST({whole} % {mod} AS VARCHAR) || '{mark}' || CAST({whole} % 10 AS VARCHAR)"


def _mod(n: int) -> str:
    return f"CAST(o_orderkey % {n} AS VARCHAR)"


P = "o_totalprice"
# (file, sheet) -> file number, sheet number, rows, row number, cells by raw header
CELLS: dict[tuple[str, str], tuple[int, int, str, str, dict[str, str]]] = {
    ("DTO 1998.xlsx", "Hoja1"): (0, 0, ORDERS, "o_orderkey", {
        "AÑO DECRETO": f"'DTO ' || CAST(1998 + o_orderkey % 2 AS VARCHAR) || '-' || {_mod(900)}", "CODIGO": K, "DNI": DOC,
        "Apellido y Nombre": NAME, "Localización": "n_name", "DEPARTAMENTO": "n_name", "CULTIVO": "lower(c_mktsegment)",
        "SUPTOT": _num(P, 500), "SUP. AG": _num(f"{P} / 3", 300), "SUP AFECT": _num(f"{P} / 5", 310, ".")}),
    ("DTO 2000-1171.xlsx", "JURADAS"): (1, 1, ORDERS, "o_orderkey", {
        "IDDJ": K, "Doc Nro": DOC, "AyN": NAME, "Sección": _mod(7), "SUPTOT": _num(P, 400), "SUPAG": _num(f"{P} / 2", 200),
        "SUPAFECT": _num(f"{P} / 4", 250), "SUPGAN": _num(f"{P} / 7", 90), "SUPGANAFECT": _num(f"{P} / 9", 95),
        "OBS": "CASE WHEN o_orderkey % 3 = 0 THEN 'sin dato' ELSE 'revisar' END",
        "FECHA": "strftime(o_orderdate, '%d/%m/%Y')"}),
    ("DTO 2000-1171.xlsx", "Resumen"): (1, 0, ORDERS, "o_orderkey", {"TOTAL": K}),
    ("DTO 2001-133 AGRICOLAS.xlsx", "N1"): (2, 0, LINES, "l_orderkey * 64 + nth - 1", {
        "IDDJ": "CAST(l_orderkey AS VARCHAR)", "AYN": "'Productor'", "ESPECIE": "'especie ' || CAST(l_partkey % 7 AS VARCHAR)",
        "CATEGORIA": "CAST(l_linenumber % 3 AS VARCHAR)", "SUP PLANT. SEMB": "CAST(CAST(trunc(l_quantity) AS INT) AS VARCHAR)",
        "SUP AFEC": "CAST(CAST(trunc(l_quantity) AS INT) % 9 AS VARCHAR)", "PORC AFEC": "'12 %'"}),
    ("DTO 2001-133 AGRICOLAS.xlsx", "N2"): (2, 1, f"{ORDERS} WHERE false", "o_orderkey", {"IDDJ": K}),
    ("DTO 2016-01 EMERGENCIA.xlsx", "AGRICULTURA"): (3, 0, ORDERS, "o_orderkey", {
        "AÑO DTO": "CASE WHEN o_orderkey % 4 <> 3 THEN 'DTO 2016-1' END", "SOLICITUDID": K, "PRODUCTORDENOMINACION": NAME,
        "DOCUMENTONRO": DOC, "CUITCUIL": f"'20' || {DOC} || '1'", "DEPARTAMENTODESC": "n_name", "CULTIVODESC": "c_mktsegment",
        "SUPERFICIEPLANTADA": _num(P, 600), "SUPERFICIEAFECTADA": _num(f"{P} / 2", 700), "SUPUSO": _num(P, 50)}),
    ("DTO 2016-01 EMERGENCIA.xlsx", "GANADERIA"): (3, 1, ORDERS, "o_orderkey", {
        "Año Dto": "'2016-1'", "CODIGO": K, "ACTIVIDAD": "CAST(NULL AS VARCHAR)", "SUPUSO": _num(P, 80),
        "SUPAFECT": _num(f"{P} / 3", 90), "EXISTENC": _mod(60), "MORTANDAD": _mod(70)}),
    ("DTO 2009-277 GANADERO.xlsx", "Hoja1"): (4, 0, ORDERS, "o_orderkey", {
        "COD": K, "N° DOC": DOC, "AyN": NAME, "DPTO": "n_name", "SUP. TOT": _num(P, 500), "SUP GAN": _num(f"{P} / 2", 300),
        "SUP GAN AF": _num(f"{P} / 3", 350), "EXIS": _mod(40), "PORC AF": f"{_mod(100)} || '%'",
        "OBS": "CASE WHEN o_orderkey % 5 = 0 THEN '  ' ELSE 'ok' END"}),
    ("DTO 2015-55.xlsx", "AGRIC"): (5, 0, ORDERS, "o_orderkey", {
        "AÑO DTO": "'2015-55'", "CODIGO": K, "PRODUCTORDENOMINACION": NAME, "SUPERFICIEPLANTADA": _num(P, 100),
        "SUPUSO": _num(P, 70), "SUPAFECT": _num(f"{P} / 2", 90)}),
    ("DTO 2015-55.xlsx", "GANAD"): (5, 1, ORDERS, "o_orderkey", {
        "CODIGO": K, "SUPUSO": _num(P, 70), "SUPAFECT": _num(f"{P} / 2", 90), "EXISTENC": _mod(30)}),
    ("TABACO 2007-44.xlsx", "Hoja1"): (6, 0, ORDERS, "o_orderkey", {
        "COD": K, "CUIT": DOC, "AYN": NAME, "DPTO": "n_name", "PLANTADA": _num(P, 40), "COSECHADA": _num(f"{P} / 2", 50),
        "PROD EST": _mod(900), "PROD OB": _mod(800)}),
    ("ROTO 2012.xlsx", "Hoja1"): (7, 0, ORDERS, "o_orderkey", {"SUP TOT": K, "SUP. TOT": K}),
    ("GANADERO 2008-12 RESUMIDO.xlsx", "Hoja1"): (8, 0, ORDERS, "o_orderkey", {
        "COD": K, "DOC": DOC, "AyN": NAME, "DPTO": "n_name", "Localización": "n_name || ' norte'", "SECCION": _mod(11),
        "SUP TOT": _num(P, 500), "SUP GAN": _num(f"{P} / 2", 400, "."), "SUP GAN AF": _num(f"{P} / 3", 410),
        "EXIS": f"CASE WHEN o_orderkey % 13 = 0 THEN 's/d' ELSE {_mod(90)} END"}),
    ("MONTE CASEROS 2006-300.xlsx", "Datos"): (9, 0, ORDERS, "o_orderkey", {
        "COD": K, "DOC": DOC, "CUIL O CUIT": f"'27-' || {DOC} || '-3'", "AYN": NAME, "DPTO": "'Monte  Caseros'",
        "LOC PJE PART": "n_name || ' norte'", "SECCION": _mod(5), "SUP TOT": _num(P, 700), "SUP SEM": _num(f"{P} / 2", 300),
        "SUP AF": _num(f"{P} / 4", 320, "."), "AF": f"{_mod(100)} || ' %'",
        "OBS": "CASE WHEN o_orderkey % 4 = 0 THEN 'Sin Dato' ELSE o_orderpriority END"}),
    ("AGRICOLA 2007-61.xls", "Hoja1"): (10, 0, ORDERS, "o_orderkey", {
        "IDDJ": K, "DOC. NRO": DOC, "ING BRUTOS": f"'20' || {DOC}", "AYN": NAME, "DPTO ESTAB": "n_name",
        "LOC PJE PART": "n_name || ' norte'", "DOM ESTAB": "'tel ' || CAST(c_custkey AS VARCHAR)", "SECCION": _mod(3), "ESPECIE": "lower(c_mktsegment)",
        "CATEGORIA": "o_orderpriority", "SUPTOT": _num(P, 800), "SUP PLANT SEMB": _num(f"{P} / 2", 310),
        "PROD ESTIM": _mod(1000)}),
    ("DTO 2019-128.xlsx", "Hoja1"): (11, 0, ORDERS, "o_orderkey", {
        "CODIGO": K, "DNI": DOC, "Nombre / Razón Social": "'\"' || c_name || '\" y otro'", "CUIT": f"'30' || {DOC}",
        "DEPARTAMENTO": "n_name", "LOCALIDAD": "n_name || ' norte'", "PARAJE": "CASE WHEN o_orderkey % 6 = 0 THEN '-' ELSE 'tel ' || CAST(c_custkey AS VARCHAR) END",
        "RENSPA": f"'05.' || {_mod(77)}", "MIXTO": "CASE WHEN o_orderkey % 2 = 0 THEN 'ganadería' END",
        "ACTIVIDAD": "'no se lee'", "TIPO CULTIVO": "c_mktsegment", "SUPERFICIE TOTAL": _num(P, 900),
        "SUPERFICIE EN USO AGR": _num(f"{P} / 2", 500), "SUP. EN USO GAN": _num(f"{P} / 3", 510),
        "SUPERFICIE AFECTADA AGR": _num(f"{P} / 4", 520, "."), "SUP. AFECTADA TOTAL GAN": _num(f"{P} / 5", 530),
        "TOTAL CABEZAS": _mod(333)}),
}
_AGRI = {"superficie_agricola_uso", "superficie_agricola_afectada"}
# sheet -> (target: raw header), constants, (text with year and decree, or None: the file's name)
RULES: dict[tuple[str, str], tuple[dict[str, str], dict[str, str], str | None]] = {
    ("DTO 1998.xlsx", "Hoja1"): ({
        "codigo": "CODIGO", "iddj": "CODIGO", "documento_nro": "DNI", "productor_nombre": "Apellido y Nombre",
        "localidad": "Localización", "departamento": "DEPARTAMENTO", "cultivo": "CULTIVO", "especie": "CULTIVO",
        "superficie_total": "SUPTOT", "superficie_agricola_uso": "SUP. AG", "superficie_agricola_afectada": "SUP AFECT"},
        {"actividad": "AGRICULTURA_FORESTAL"}, "AÑO DECRETO"),
    ("DTO 2000-1171.xlsx", "JURADAS"): ({
        "fecha_origen": "FECHA", "codigo": "IDDJ", "iddj": "IDDJ", "documento_nro": "Doc Nro", "productor_nombre": "AyN",
        "seccion": "Sección", "superficie_total": "SUPTOT", "superficie_agricola_uso": "SUPAG",
        "superficie_agricola_afectada": "SUPAFECT", "superficie_ganadera_uso": "SUPGAN",
        "superficie_ganadera_afectada": "SUPGANAFECT", "observaciones": "OBS"}, {}, None),
    ("DTO 2001-133 AGRICOLAS.xlsx", "N1"): ({
        "iddj": "IDDJ", "codigo": "IDDJ", "productor_nombre": "AYN", "cultivo": "ESPECIE", "especie": "ESPECIE",
        "categoria": "CATEGORIA", "superficie_plantada_sembrada": "SUP PLANT. SEMB", "superficie_afectada": "SUP AFEC",
        "superficie_agricola_uso": "SUP PLANT. SEMB", "superficie_agricola_afectada": "SUP AFEC",
        "porcentaje_afectacion": "PORC AFEC"}, {"actividad": "AGRICULTURA", "evento_id": "DTO_2001_133"}, None),
    ("DTO 2016-01 EMERGENCIA.xlsx", "AGRICULTURA"): ({
        "solicitud_id": "SOLICITUDID", "productor_nombre": "PRODUCTORDENOMINACION", "documento_nro": "DOCUMENTONRO",
        "cuit_cuil": "CUITCUIL", "departamento": "DEPARTAMENTODESC", "cultivo": "CULTIVODESC", "especie": "CULTIVODESC",
        "superficie_agricola_uso": "SUPERFICIEPLANTADA", "superficie_agricola_afectada": "SUPERFICIEAFECTADA",
        "superficie_ganadera_uso": "SUPUSO", "superficie_plantada_sembrada": "SUPERFICIEPLANTADA",
        "superficie_afectada": "SUPERFICIEAFECTADA"}, {"actividad": "AGRICULTURA"}, "AÑO DTO"),
    ("DTO 2016-01 EMERGENCIA.xlsx", "GANADERIA"): ({
        "codigo": "CODIGO", "iddj": "CODIGO", "superficie_ganadera_uso": "SUPUSO", "superficie_ganadera_afectada": "SUPAFECT",
        "existencias": "EXISTENC", "mortandad": "MORTANDAD", "superficie_afectada": "SUPAFECT"},
        {"actividad": "GANADERIA"}, "Año Dto"),
    ("DTO 2009-277 GANADERO.xlsx", "Hoja1"): ({
        "codigo": "COD", "iddj": "COD", "documento_nro": "N° DOC", "productor_nombre": "AyN", "departamento": "DPTO",
        "superficie_total": "SUP. TOT", "superficie_ganadera_uso": "SUP GAN", "superficie_ganadera_afectada": "SUP GAN AF",
        "existencias": "EXIS", "porcentaje_afectacion_ganadera": "PORC AF", "observaciones": "OBS"},
        {"actividad": "GANADERIA"}, None),
    ("DTO 2015-55.xlsx", "AGRIC"): ({
        "codigo": "CODIGO", "iddj": "CODIGO", "productor_nombre": "PRODUCTORDENOMINACION",
        "superficie_agricola_uso": "SUPERFICIEPLANTADA", "superficie_agricola_afectada": "SUPAFECT"},
        {"actividad": "AGRIC"}, "AÑO DTO"),
    ("DTO 2015-55.xlsx", "GANAD"): ({
        "codigo": "CODIGO", "iddj": "CODIGO", "superficie_ganadera_uso": "SUPUSO", "superficie_ganadera_afectada": "SUPAFECT",
        "existencias": "EXISTENC"}, {"actividad": "GANAD"}, None),
    ("TABACO 2007-44.xlsx", "Hoja1"): ({
        "codigo": "COD", "iddj": "COD", "cuit_cuil": "CUIT", "productor_nombre": "AYN", "departamento": "DPTO",
        "superficie_agricola_uso": "PLANTADA", "superficie_agricola_afectada": "COSECHADA",
        "superficie_plantada_sembrada": "PLANTADA", "superficie_afectada": "COSECHADA", "produccion_estimada": "PROD EST",
        "produccion_obtenida": "PROD OB"}, {"actividad": "AGRICULTURA", "cultivo": "TABACO", "especie": "TABACO"}, None),
    ("GANADERO 2008-12 RESUMIDO.xlsx", "Hoja1"): ({
        "codigo": "COD", "iddj": "COD", "documento_nro": "DOC", "productor_nombre": "AyN", "departamento": "DPTO",
        "localidad": "Localización", "seccion": "SECCION", "superficie_total": "SUP TOT", "superficie_ganadera_uso": "SUP GAN",
        "superficie_ganadera_afectada": "SUP GAN AF", "existencias": "EXIS"}, {"actividad": "GANADERIA"}, None),
    ("MONTE CASEROS 2006-300.xlsx", "Datos"): ({
        "codigo": "COD", "iddj": "COD", "documento_nro": "DOC", "cuit_cuil": "CUIL O CUIT", "productor_nombre": "AYN",
        "departamento": "DPTO", "localidad": "LOC PJE PART", "seccion": "SECCION", "superficie_total": "SUP TOT",
        "superficie_agricola_uso": "SUP SEM", "superficie_agricola_afectada": "SUP AF",
        "superficie_plantada_sembrada": "SUP SEM", "superficie_afectada": "SUP AF", "porcentaje_afectacion": "AF",
        "observaciones": "OBS"}, {"actividad": "AGRICULTURA"}, None),
    ("AGRICOLA 2007-61.xls", "Hoja1"): ({
        "iddj": "IDDJ", "codigo": "IDDJ", "documento_nro": "DOC. NRO", "cuit_cuil": "ING BRUTOS", "productor_nombre": "AYN",
        "departamento": "DPTO ESTAB", "localidad": "LOC PJE PART", "paraje": "DOM ESTAB", "seccion": "SECCION",
        "cultivo": "ESPECIE", "especie": "ESPECIE", "categoria": "CATEGORIA", "superficie_total": "SUPTOT",
        "superficie_agricola_uso": "SUP PLANT SEMB", "superficie_plantada_sembrada": "SUP PLANT SEMB",
        "produccion_estimada": "PROD ESTIM"}, {"actividad": "AGRICULTURA"}, None),
    ("DTO 2019-128.xlsx", "Hoja1"): ({
        "codigo": "CODIGO", "iddj": "CODIGO", "documento_nro": "DNI", "productor_nombre": "Nombre / Razón Social",
        "cuit_cuil": "CUIT", "departamento": "DEPARTAMENTO", "localidad": "LOCALIDAD", "paraje": "PARAJE", "renspa": "RENSPA",
        "actividad": "MIXTO", "cultivo": "TIPO CULTIVO", "superficie_total": "SUPERFICIE TOTAL",
        "superficie_agricola_uso": "SUPERFICIE EN USO AGR", "superficie_ganadera_uso": "SUP. EN USO GAN",
        "superficie_agricola_afectada": "SUPERFICIE AFECTADA AGR", "superficie_ganadera_afectada": "SUP. AFECTADA TOTAL GAN",
        "existencias": "TOTAL CABEZAS"}, {}, None),
}
# per-sheet fall-back to the file's name where the decree column is blank
_FALLS_BACK = {"DTO 2016-01 EMERGENCIA.xlsx", "DTO 2015-55.xlsx"}


def sheet_sql(key: tuple[str, str]) -> str:
    """One sheet as harmonised rows."""
    file, sheet = key
    fidx, sidx, rows, row, cells = CELLS[key]
    targets, constants, decree = RULES[key]
    stem = file.rsplit(".", 1)[0]
    text = f"({cells[decree]})" if decree else f"'{stem}'"
    year, number = Q.extract_year(text), Q.extract_decree(text)
    if decree and file in _FALLS_BACK:
        year = f"COALESCE({year}, {Q.extract_year(chr(39) + stem + chr(39))})"
        number = f"COALESCE({number}, {Q.extract_decree(chr(39) + stem + chr(39))})"
    made = {"anio": year, "dto": number, "periodo": Q.build_period(year, number), "source_file": f"'{file}'",
            "source_sheet": f"'{sheet}'"}
    for name, value in constants.items():
        made[name] = f"'{value}'"
    for name, header in targets.items():
        clean = Q.clean_numeric if name in NUMERIC_COLUMNS else Q.clean_text
        made[name] = clean(f"({cells[header]})")
    nulls = {"anio": "INTEGER"} | dict.fromkeys(NUMERIC_COLUMNS, "DOUBLE")
    cols = [f"{made[c]} AS {c}" if c in made else f"CAST(NULL AS {nulls.get(c, 'VARCHAR')}) AS {c}" for c in SHOWN]
    return (f"SELECT (CAST({fidx} AS BIGINT) << 44) + (CAST({sidx} AS BIGINT) << 34) + {row} AS row_id, "
            f"{', '.join(cols)} FROM {rows}")


# the flags are K's, set after harmonisation
SHOWN = [c for c in OUTPUT_COLUMNS if c in TEXT_COLUMNS or c in NUMERIC_COLUMNS
         or c in ("anio", "dto", "periodo", "evento_id", "source_file", "source_sheet")]


def file_sql(file: str) -> str:
    return " UNION ALL ".join(sheet_sql(k) for k in RULES if k[0] == file)


EVERY_SHEET = " UNION ALL ".join(sheet_sql(k) for k in RULES)


def _inventory_sql() -> str:
    parts = []
    for (file, sheet), (_, _, rows, row, cells) in CELLS.items():
        line = "concat_ws(' | ', " + ", ".join(f"coalesce({c}, '')" for c in cells.values()) + ")"
        header = " | ".join(cells).replace("'", "''")
        problem = "'HeaderError: duplicate normalised headers: [''SUP_TOT'']'" if file.startswith("ROTO") else "CAST(NULL AS VARCHAR)"
        parts.append(f"SELECT '{file}' AS archivo, '{sheet}' AS hoja, count(*) AS filas, {len(cells)} AS columnas, "
                     f"'{header}' AS encabezado, coalesce(string_agg({line}, chr(10) ORDER BY {row}) "
                     f"FILTER (WHERE {row} < 15), '') AS vista_previa, {problem} AS error FROM {rows}")
    return " UNION ALL ".join(parts)


def _status_sql() -> str:
    counts = " UNION ALL ".join(f"SELECT '{f}' AS archivo, count(*) AS n FROM ({file_sql(f)}) s" for f in
                                dict.fromkeys(k[0] for k in RULES))
    rows = []
    for file, layout in TESTDATA_FORMATS:
        state, error = "ok", "CAST(NULL AS VARCHAR)"
        if file.startswith("ROTO"):
            state, error = "error", "'HeaderError: duplicate normalised headers: [''SUP_TOT''] (Hoja1)'"
        elif file.startswith("NUEVO"):
            state = "formato_no_implementado"
        elif file.startswith("FALTA"):
            state, error = "archivo_no_encontrado", f"'{file}'"
        rows.append(f"SELECT '{file}' AS archivo, '{layout}' AS formato, '{state}' AS estado, {error} AS error")
    return (f"WITH f AS ({' UNION ALL '.join(rows)}), c AS ({counts}) "
            "SELECT archivo, formato, estado, coalesce(n, 0) AS filas, error FROM f LEFT JOIN c USING (archivo)")


LAYOUT_QUERIES = {
    "b1_formato_1998": ("formato_1998", "DTO 1998.xlsx"),
    "b2_juradas": ("formato_juradas", "DTO 2000-1171.xlsx"),
    "b3_detalle_agricola_2001": ("formato_detalle_agricola_2001", "DTO 2001-133 AGRICOLAS.xlsx"),
    "b4_multisheet_2015": ("formato_multisheet_2015", "DTO 2015-55.xlsx"),
    "b5_moderno_multisheet": ("formato_moderno_multisheet", "DTO 2016-01 EMERGENCIA.xlsx"),
    "b6_ganadero_ancho_all_columns": ("formato_ganadero_ancho", "DTO 2009-277 GANADERO.xlsx"),
    "b7_ganadero_resumido": ("formato_ganadero_resumido", "GANADERO 2008-12 RESUMIDO.xlsx"),
    "b8_monte_caseros": ("formato_agricola_monte_caseros", "MONTE CASEROS 2006-300.xlsx"),
    "b9_tabaco_2007": ("formato_tabaco_2007", "TABACO 2007-44.xlsx"),
    "b10_detalle_agricola_2007": ("formato_detalle_agricola_2007_xls", "AGRICOLA 2007-61.xls"),
    "b11_formato_2019": ("formato_2019", "DTO 2019-128.xlsx"),
}


GOOD_FILES = ("DTO 1998.xlsx", "DTO 2019-128.xlsx")
CUT_FILE, SHORT_FILE, LATIN_FILE = "DTO 2016-01 EMERGENCIA.xlsx", "DTO 2015-55.xlsx", "GANADERO 2008-12 RESUMIDO.xlsx"


def _damaged_sql() -> str:
    layouts = dict(TESTDATA_FORMATS)
    good = [f"SELECT '{f}' AS archivo, '{layouts[f]}' AS formato, 'ok' AS estado, count(*) AS filas, "
            f"CAST(NULL AS VARCHAR) AS error FROM ({file_sql(f)}) s" for f in GOOD_FILES]
    bad = [f"SELECT '{f}', '{layouts[f]}', 'error', 0, '{text}'" for f, text in (
        (CUT_FILE, "TruncatedRecord: row 3: a quote is never closed (RESTO)"),
        (SHORT_FILE, "RaggedRecord: row 3: 1 cells, the header has 2 (RESTO)"),
        (LATIN_FILE, "EncodingError: row 1: not UTF-8 (Hoja1)"))]
    return " UNION ALL ".join(good + bad)


def register_all(register) -> None:
    for name, (layout, file) in LAYOUT_QUERIES.items():
        register(name, file_sql(file))(
            lambda s, d, layout=layout, file=file: harmonise_workbook(s, layout, testdata_workbooks(s, d)[file])
            .select("row_id", *SHOWN))

    def harmonised(s, d, written=True):
        return harmonise(s, testdata_workbooks(s, d, joined_once=True), TESTDATA_FORMATS, written=written)

    def landing_zone(s):
        return f"{checkpoint_dir(s).rstrip('/')}/landing-{uuid.uuid4().hex[:10]}"

    def land(sheet, path):
        write_csv(sheet.frame.orderBy("__row").drop("__row"),
                  f"{path}/{sheet.source_file}/{sheet.sheet_ordinal:03d}__{sheet.source_sheet}.csv")

    def land_all(sheets, path):
        """Each sheet is a job of its own; some run side by side."""
        with ThreadPoolExecutor(max_workers=4) as pool:
            list(pool.map(lambda sheet: land(sheet, path), sheets))

    def landed(s, d):
        """The workbooks written to a landing zone as CSV, then harmonised from there."""
        path = landing_zone(s)
        land_all([sheet for sheets in testdata_workbooks(s, d, joined_once=True).values() for sheet in sheets], path)
        return harmonise_landing(s, path, TESTDATA_FORMATS, written=False)

    def damaged(s, d, written=True):
        """Two whole workbooks; one in another encoding, one with a sheet that
        was cut off, one with a short record."""
        path, books = landing_zone(s), testdata_workbooks(s, d, joined_once=True)
        land_all([sheet for file in GOOD_FILES + (CUT_FILE, SHORT_FILE) for sheet in books[file]], path)
        write_csv(books[LATIN_FILE][0].frame.drop("__row"), f"{path}/{LATIN_FILE}/Hoja1.csv", encoding="ISO-8859-1")
        for file, lines in ((CUT_FILE, ["CODIGO,OBS", "1,uno", '2,"dos']), (SHORT_FILE, ["CODIGO,SUPUSO", "1,2", "3"])):
            raw = s.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, x string").orderBy("i").coalesce(1)
            raw.select("x").write.option("sep", "\x01").option("quote", "\x00").csv(f"{path}/{file}/009__RESTO.csv")
        return harmonise_landing(s, path, [x for x in TESTDATA_FORMATS if x[0] in {
            *GOOD_FILES, CUT_FILE, SHORT_FILE, LATIN_FILE}], written=written)

    shown = ", ".join(SHOWN)
    register("a1_b12_harmonise_landing", f"SELECT {shown} FROM ({EVERY_SHEET}) x")(
        lambda s, d: landed(s, d).clean.select(*SHOWN))
    register("b0_b12_harmonise_workbooks", EVERY_SHEET)(lambda s, d: harmonised(s, d, written=False).clean.select("row_id", *SHOWN))
    register("a7_harmonise_status", _status_sql())(lambda s, d: harmonised(s, d).status)
    register("a7_damaged_files_status", _damaged_sql())(lambda s, d: damaged(s, d).status)
    register("a7_damaged_files_rows", f"SELECT {shown} FROM ({' UNION ALL '.join(map(file_sql, GOOD_FILES))}) x")(
        lambda s, d: damaged(s, d, written=False).clean.select(*SHOWN))
    register("a2_sheet_inventory", _inventory_sql())(lambda s, d: inventory(s, cells_of(s, testdata_workbooks(s, d))))
