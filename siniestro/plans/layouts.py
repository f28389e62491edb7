"""Sheet layouts -> the 47-column harmonised table.

Each historical spreadsheet layout is a declarative spec: for every target
column, the header candidates (the first one *present in the sheet header*
wins -- decided per header, never per row, T1), constants, mirrored columns,
where year and decree come from, and sheet-level rules.

Specs are data to the job: ``rule_rows`` is a table of (layout, target, rank,
header).  Joined with the headers of all sheets it gives, per file, the place
of every target among its cells; the rows then pick their cells by index.  So
one projection serves all sheets of all layouts, and the plan depends neither
on the number of files nor on their headers.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import numeric_chars, numeric_chars_joined, parse_numeric_chars
from ..functions.text import (JOINT, build_period, clean_stripped_text, collapse_upper, extract_decree, extract_year, first_decree,
                              first_year, join_cells, norm_header, not_null_token, odd_cells, strip_trimmed, year_of, year_text)
from ..schema import NUMERIC_COLUMNS, OUTPUT_COLUMNS, OUTPUT_TYPES, TEXT_COLUMNS
from ..sources.cells import Cells, Landed, header_names


@dataclass(frozen=True)
class Layout:
    name: str
    fields: dict[str, tuple[str, ...]]
    constants: dict[str, object] = field(default_factory=dict)
    mirrors: dict[str, str] = field(default_factory=dict)     # target <- other target (raw value)
    period: str = "file"              # "file": year/decree from the file name; "decree": from a column;
                                      # "decree_or_file": column, per-row fallback to the file name; "fixed"
    decree: tuple[str, ...] = ()
    sheets: str = "first"             # "first", "all" or the one sheet name to read
    activity_from_sheet: str | None = None   # "always" or "if_empty"
    activity_if_crop: str | None = None      # constant activity when empty and a CULTIVO header exists
    side_rule: str | None = None             # "sheet_name" or "presence"


# --- fixed values: layouts of the historical spreadsheets -----------------------
# Header candidates are given normalised (C5).  Spellings with Ñ in the source
# system can never match a normalised header and are left out.
AGRI_SHEET_NAMES = ("AGRIC", "AGRICOLA", "AGRICULTURA")
AGRI_SIDE = ("superficie_agricola_uso", "superficie_agricola_afectada")
LIVESTOCK_SIDE = ("superficie_ganadera_uso", "superficie_ganadera_afectada")
PRESENCE_AGRI = ("SUPERFICIEPLANTADA", "SUPERFICIEAFECTADA", "CULTIVODESC")
PRESENCE_LIVESTOCK = ("SUPUSO", "SUPAFECT", "EXISTENC", "MORTANDAD", "EXIST_CABEZAS_OVINOS", "EXIST_CABEZAS_VACUNOS")

LAYOUTS: dict[str, Layout] = {
    "formato_1998": Layout(
        "formato_1998", period="decree", decree=("ANO_DECRETO", "ANO_DTO"), activity_if_crop="AGRICULTURA_FORESTAL",
        fields={
            "codigo": ("CODIGO", "IDDJ"), "iddj": ("IDDJ", "CODIGO"),
            "documento_nro": ("DNI", "DOC_NRO", "DOCUMENTO_NRO"), "cuit_cuil": ("CUIT", "CUITCUIL", "CUIT_CUIL"),
            "productor_nombre": ("APELLIDO_Y_NOMBRE", "AYN", "PRODUCTORDENOMINACION"),
            "localidad": ("LOCALIZACION", "LOCALIDAD", "LOCALIDADDESC"), "seccion": ("SECCION",),
            "departamento": ("DEPARTAMENTO", "DEPARTAMENTODESC"), "actividad": ("ACTIVIDAD",),
            "cultivo": ("CULTIVO", "CULTIVODESC", "TIPO_CULTIVO"),
            "especie": ("CULTIVO", "ESPECIE", "CULTIVODESC", "TIPO_CULTIVO"),
            "superficie_total": ("SUPTOT", "SUPERFICIE_TOTAL"),
            "superficie_ganadera_uso": ("SUPGAN", "SUP_EN_USO_GAN"),
            "superficie_ganadera_afectada": ("SUPGANAFECT", "SUP_AFECTADA_TOTAL_GAN"),
            "existencias": ("N_CABEZAS", "TOTAL_CABEZAS", "EXISTENC"),
            "superficie_agricola_uso": ("SUP_AG", "SUPAG", "SUPERFICIE_EN_USO_AGR", "SUP_PLANT_SEMB"),
            "superficie_agricola_afectada": ("SUPAFECT", "SUP_AFECT", "SUPERFICIE_AFECTADA_AGR", "SUP_AFEC"),
            "superficie_plantada_sembrada": ("SUP_PLANT_SEMB",), "superficie_afectada": ("SUP_AFEC",),
            "porcentaje_afectacion": ("PORC_CALC", "PORC_AFEC"),
        }),
    "formato_juradas": Layout(
        "formato_juradas", sheets="JURADAS",
        fields={
            "fecha_origen": ("FECHA", "FECHA_CARGA"), "codigo": ("IDDJ", "CODIGO"), "iddj": ("IDDJ", "CODIGO"),
            "documento_nro": ("DOC_NRO", "DNI", "DOCUMENTO_NRO"),
            "productor_nombre": ("AYN", "APELLIDO_Y_NOMBRE", "PRODUCTORDENOMINACION"),
            "paraje": ("OTRA_LOC_PARAJE", "PARAJE", "PARAJEDESC"), "seccion": ("SECCION",),
            "superficie_total": ("SUPTOT", "SUPERFICIE_TOTAL"),
            "superficie_agricola_uso": ("SUPAG", "SUP_AG", "SUPERFICIE_EN_USO_AGR"),
            "superficie_agricola_afectada": ("SUPAFECT", "SUP_AFECT", "SUPERFICIE_AFECTADA_AGR"),
            "superficie_ganadera_uso": ("SUPGAN", "SUP_EN_USO_GAN"),
            "superficie_ganadera_afectada": ("SUPGANAFECT", "SUP_AFECTADA_TOTAL_GAN"),
            "porcentaje_afectacion_ganadera": ("POR_AFECTACION_GAN",), "observaciones": ("OBS", "OBSERVACIONES"),
        }),
    "formato_detalle_agricola_2001": Layout(
        "formato_detalle_agricola_2001", period="fixed", sheets="all",
        constants={"evento_id": "DTO_2001_133", "anio": 2001, "dto": "133", "periodo": "2001-133",
                   "actividad": "AGRICULTURA"},
        mirrors={"superficie_agricola_uso": "superficie_plantada_sembrada",
                 "superficie_agricola_afectada": "superficie_afectada"},
        fields={
            "iddj": ("IDDJ",), "codigo": ("IDDJ",),
            "productor_nombre": ("AYN", "PRODUCTORDENOMINACION", "APELLIDO_Y_NOMBRE"),
            "documento_nro": ("DOC_NRO", "DNI", "DOCUMENTO_NRO"), "departamento": ("DEPARTAMENTO", "DEPARTAMENTODESC"),
            "seccion": ("SECCION",), "cultivo": ("ESPECIE", "CULTIVO"), "especie": ("ESPECIE", "CULTIVO"),
            "categoria": ("CATEGORIA",), "superficie_plantada_sembrada": ("SUP_PLANT_SEMB",),
            "superficie_afectada": ("SUP_AFEC",), "porcentaje_afectacion": ("PORC_AFEC", "PORC_CALC"),
        }),
    "formato_multisheet_2015": Layout(
        "formato_multisheet_2015", period="decree_or_file", decree=("ANO_DTO",), sheets="all",
        activity_from_sheet="always", side_rule="sheet_name",
        fields={
            "codigo": ("CODIGO", "IDDJ"), "iddj": ("IDDJ", "CODIGO"),
            "productor_nombre": ("PRODUCTORDENOMINACION", "NOMBRE_RAZON_SOCIAL"),
            "documento_nro": ("DOCUMENTONRO", "DNI", "DOC_NRO"), "cuit_cuil": ("CUITCUIL", "CUIT_CUIL", "CUIT"),
            "departamento": ("DEPARTAMENTODESC", "DEPARTAMENTO"), "localidad": ("LOCALIDADDESC", "LOCALIDAD"),
            "paraje": ("PARAJEDESC", "PARAJE"), "cultivo": ("CULTIVODESC", "TIPO_CULTIVO"),
            "superficie_agricola_uso": ("SUPERFICIEPLANTADA", "SUPUSO"),
            "superficie_agricola_afectada": ("SUPERFICIEAFECTADA", "SUPAFECT"),
            "superficie_ganadera_uso": ("SUPUSO",), "superficie_ganadera_afectada": ("SUPAFECT",),
            "existencias": ("EXISTENC", "TOTAL_CABEZAS"), "mortandad": ("MORTANDAD",),
            "produccion_estimada": ("PRODUCCIONESTIMADA",), "produccion_obtenida": ("PRODUCCIONOBTENIDA",),
        }),
    "formato_moderno_multisheet": Layout(
        "formato_moderno_multisheet", period="decree_or_file", decree=("ANO_DTO", "ANO_DEC", "ANO_DCTO", "ANO"),
        sheets="all", activity_from_sheet="if_empty", side_rule="presence",
        fields={
            "solicitud_id": ("SOLICITUDID", "SOLICITUD_ID"), "codigo": ("CODIGO", "IDDJ"), "iddj": ("IDDJ", "CODIGO"),
            "productor_nombre": ("PRODUCTORDENOMINACION", "NOMBRE_RAZON_SOCIAL"),
            "documento_nro": ("DOCUMENTONRO", "DNI", "DOC_NRO"), "cuit_cuil": ("CUITCUIL", "CUIT_CUIL", "CUIT"),
            "departamento": ("DEPARTAMENTODESC", "DEPARTAMENTO"), "localidad": ("LOCALIDADDESC", "LOCALIDAD"),
            "paraje": ("PARAJEDESC", "PARAJE"), "actividad": ("ACTIVIDAD",),
            "cultivo": ("CULTIVODESC", "TIPO_CULTIVO"), "especie": ("CULTIVODESC", "TIPO_CULTIVO"),
            "superficie_agricola_uso": ("SUPERFICIEPLANTADA", "SUPUSO"),
            "superficie_agricola_afectada": ("SUPERFICIEAFECTADA", "SUPAFECT"),
            "superficie_ganadera_uso": ("SUPUSO",), "superficie_ganadera_afectada": ("SUPAFECT",),
            "existencias": ("EXISTENC", "TOTAL_CABEZAS", "EXIST_CABEZAS_OVINOS", "EXIST_CABEZAS_VACUNOS"),
            "mortandad": ("MORTANDAD", "MORTANDAD_OVINOS", "MORTANDAD_VACUNOS"),
            "produccion_estimada": ("PRODUCCIONESTIMADA",), "produccion_obtenida": ("PRODUCCIONOBTENIDA",),
            "superficie_plantada_sembrada": ("SUPERFICIEPLANTADA",),
            "superficie_afectada": ("SUPERFICIEAFECTADA", "SUPAFECT"),
        }),
    "formato_ganadero_ancho": Layout(
        "formato_ganadero_ancho", constants={"actividad": "GANADERIA"},
        fields={
            "codigo": ("COD",), "iddj": ("COD",), "documento_nro": ("N_DOC", "DOC"), "cuit_cuil": ("CUIL_O_CUIT",),
            "productor_nombre": ("AYN",), "departamento": ("DPTO_EXPL", "DPTO"),
            "localidad": ("LOCALIZ_EXP", "LOCALIZACION"), "seccion": ("SECCION",),
            "superficie_total": ("SUP_TOT", "SUP_TOT_EX", "SUP_TOT"), "superficie_ganadera_uso": ("SUP_GAN",),
            "superficie_ganadera_afectada": ("SUP_GAN_AF",), "existencias": ("EXIS_GAN", "EXIS"),
            "porcentaje_afectacion_ganadera": ("PORC_AF", "AF"), "observaciones": ("OBSERVACIONES", "OBS"),
        }),
    "formato_ganadero_resumido": Layout(
        "formato_ganadero_resumido", constants={"actividad": "GANADERIA"},
        fields={
            "codigo": ("COD",), "iddj": ("COD",), "documento_nro": ("DOC", "N_DOC"), "productor_nombre": ("AYN",),
            "departamento": ("DPTO",), "localidad": ("LOCALIZACION",), "seccion": ("SECCION",),
            "superficie_total": ("SUP_TOT", "SUP_TOT"), "superficie_ganadera_uso": ("SUP_GAN",),
            "superficie_ganadera_afectada": ("SUP_GAN_AF",), "existencias": ("EXIS",),
        }),
    "formato_agricola_monte_caseros": Layout(
        "formato_agricola_monte_caseros", constants={"actividad": "AGRICULTURA"},
        mirrors={"superficie_plantada_sembrada": "superficie_agricola_uso",
                 "superficie_afectada": "superficie_agricola_afectada"},
        fields={
            "codigo": ("COD",), "iddj": ("COD",), "documento_nro": ("DOC", "N_DOC"), "cuit_cuil": ("CUIL_O_CUIT",),
            "productor_nombre": ("AYN",), "departamento": ("DPTO",), "localidad": ("LOCALIZACION", "LOC_PJE_PART"),
            "seccion": ("SECCION",), "superficie_total": ("SUP_TOT",), "superficie_agricola_uso": ("SUP_SEM",),
            "superficie_agricola_afectada": ("SUP_AF",), "porcentaje_afectacion": ("AF",), "observaciones": ("OBS",),
        }),
    "formato_tabaco_2007": Layout(
        "formato_tabaco_2007", constants={"actividad": "AGRICULTURA", "cultivo": "TABACO", "especie": "TABACO"},
        mirrors={"superficie_plantada_sembrada": "superficie_agricola_uso",
                 "superficie_afectada": "superficie_agricola_afectada"},
        fields={
            "codigo": ("COD",), "iddj": ("COD",), "cuit_cuil": ("CUIT",), "productor_nombre": ("AYN",),
            "departamento": ("DPTO",), "seccion": ("SECCION",), "paraje": ("PARAJE",),
            "superficie_total": ("SUP_TOT_EX", "SUP_TOT"), "superficie_agricola_uso": ("PLANTADA",),
            "superficie_agricola_afectada": ("COSECHADA",), "produccion_estimada": ("PROD_EST",),
            "produccion_obtenida": ("PROD_OB",), "porcentaje_afectacion": ("PORC_AF", "EMERG"),
        }),
    "formato_detalle_agricola_2007_xls": Layout(
        "formato_detalle_agricola_2007_xls", constants={"actividad": "AGRICULTURA"},
        mirrors={"superficie_plantada_sembrada": "superficie_agricola_uso"},
        fields={
            "iddj": ("IDDJ",), "codigo": ("IDDJ",), "documento_nro": ("DOC_NRO",), "cuit_cuil": ("ING_BRUTOS",),
            "productor_nombre": ("AYN",), "departamento": ("DPTO_ESTAB", "DPTO_PARTICULAR"),
            "localidad": ("LOC_PJE_PART", "DOM_ESTAB"), "paraje": ("DOM_ESTAB",), "seccion": ("SECCION",),
            "cultivo": ("ESPECIE",), "especie": ("ESPECIE",), "categoria": ("CATEGORIA",),
            "superficie_total": ("SUPTOT",), "superficie_agricola_uso": ("SUP_PLANT_SEMB",),
            "produccion_estimada": ("PROD_ESTIM",),
        }),
    "formato_2019": Layout(
        "formato_2019",
        fields={
            "codigo": ("CODIGO", "IDDJ"), "iddj": ("IDDJ", "CODIGO"), "documento_nro": ("DNI", "DOCUMENTO_NRO", "DOC_NRO"),
            "productor_nombre": ("NOMBRE_RAZON_SOCIAL", "APELLIDO_Y_NOMBRE", "AYN"),
            "cuit_cuil": ("CUIT", "CUITCUIL", "CUIT_CUIL"), "departamento": ("DEPARTAMENTO", "DEPARTAMENTODESC"),
            "localidad": ("LOCALIDAD", "LOCALIDADDESC"), "paraje": ("PARAJE", "PARAJEDESC"), "renspa": ("RENSPA",),
            "actividad": ("MIXTO", "ACTIVIDAD"), "cultivo": ("TIPO_CULTIVO", "CULTIVODESC"),
            "superficie_total": ("SUPERFICIE_TOTAL", "SUPTOT"), "superficie_agricola_uso": ("SUPERFICIE_EN_USO_AGR", "SUPAG"),
            "superficie_ganadera_uso": ("SUP_EN_USO_GAN", "SUPGAN"),
            "superficie_agricola_afectada": ("SUPERFICIE_AFECTADA_AGR", "SUPAFECT"),
            "superficie_ganadera_afectada": ("SUP_AFECTADA_TOTAL_GAN", "SUPGANAFECT"),
            "existencias": ("TOTAL_CABEZAS", "N_CABEZAS", "EXISTENC"),
        }),
}
# ---------------------------------------------------------------------------------


MAX_FILES, MAX_SHEETS = 1 << 19, 1 << 10

# What a sheet's cells are picked for: the columns of the table, and four uses of its header alone.
DECREE, HAS_AGRI, HAS_LIVESTOCK, CROP_HEADER = "__decree", "__agri", "__livestock", "__crop"
TARGETS = [*OUTPUT_COLUMNS, DECREE, HAS_AGRI, HAS_LIVESTOCK, CROP_HEADER]


def layout_fields(layout: Layout) -> dict[str, tuple[str, ...]]:
    """Target -> header candidates, mirrored columns and header uses included; constants are no fields."""
    fields = dict(layout.fields)
    fields.update({t: layout.fields[src] for t, src in layout.mirrors.items() if src in layout.fields})
    if layout.decree:
        fields[DECREE] = layout.decree
    if layout.side_rule == "presence":
        fields[HAS_AGRI], fields[HAS_LIVESTOCK] = PRESENCE_AGRI, PRESENCE_LIVESTOCK
    if layout.activity_if_crop:
        fields[CROP_HEADER] = ("CULTIVO",)
    return {t: c for t, c in fields.items() if t not in layout.constants}


def rule_rows(spark: SparkSession) -> DataFrame:
    """(layout, target, rank, name): which normalised headers feed which target, best first."""
    rows = [(name, TARGETS.index(t), rank, header) for name, layout in LAYOUTS.items()
            for t, candidates in layout_fields(layout).items() for rank, header in enumerate(candidates)]
    return spark.createDataFrame(rows, "layout string, target int, rank int, name string")


def layout_rows(spark: SparkSession) -> DataFrame:
    """One row per layout: constants by target, and its rules."""
    rows = [(name, [None if x.constants.get(t) is None else str(x.constants[t]) for t in TARGETS], x.period,
             x.activity_from_sheet, x.activity_if_crop, x.side_rule) for name, x in LAYOUTS.items()]
    return spark.createDataFrame(rows, "layout string, constants array<string>, period string, activity_from_sheet string, "
                                       "activity_if_crop string, side_rule string")


def is_agricultural(source_sheet: str) -> bool:
    return norm_header(source_sheet) in AGRI_SHEET_NAMES


def check_ordinals(file_ordinal: int, sheet_ordinal: int) -> None:
    """Ordinals must fit the row id (file 19 bits, sheet 10, row 34)."""
    if not (0 <= file_ordinal < MAX_FILES and 0 <= sheet_ordinal < MAX_SHEETS):
        raise ValueError(f"file {file_ordinal}, sheet {sheet_ordinal}: more than a row id can tell apart")


def file_stem(source_file: Column) -> Column:
    """The file's name without its extension."""
    return F.regexp_replace(source_file, r"\.[^.]*$", "")


def select_sheets(layout: Layout, sheets: Sequence[Landed]) -> list[Landed]:
    """Which sheets of a workbook the layout reads (first / all / named)."""
    if not sheets:
        return []
    ordered = sorted(sheets, key=lambda s: s.sheet_ordinal)
    if layout.sheets == "first":
        return ordered[:1]
    if layout.sheets == "all":
        return ordered
    return [s for s in ordered if s.source_sheet == layout.sheets]


def sheet_rows(spark: SparkSession, chosen: Sequence[tuple[int, Landed, str]]) -> DataFrame:
    """One row per sheet to read: (number, sheet, layout) as data."""
    rows = []
    for number, s, layout in chosen:
        check_ordinals(s.file_ordinal, s.sheet_ordinal)
        rows.append((number, s.source_file, s.source_sheet, s.file_ordinal, s.sheet_ordinal, layout,
                     is_agricultural(s.source_sheet)))
    return spark.createDataFrame(rows, "sheet int, source_file string, source_sheet string, fidx int, sidx int, "
                                       "layout string, agricultural boolean")


def picks(heads: DataFrame, sheets: DataFrame) -> DataFrame:
    """One row per file part: its sheet's facts and ``picks``, the place of each target among its cells.

    Small tables only: header cells, sheets, rules.
    """
    spark = heads.sparkSession
    found = (header_names(heads).join(sheets.select("sheet", "layout"), "sheet").join(rule_rows(spark), ["layout", "name"])
             .groupBy("part", "target").agg(F.min_by("pos", "rank").alias("pos"))
             .groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("target", "pos"))).alias("of")))
    place = F.transform(F.sequence(F.lit(0), F.lit(len(TARGETS) - 1)), lambda t: F.coalesce(
        F.try_element_at("of", t), F.lit(-1)))
    stem = file_stem(F.col("source_file"))
    return (heads.select("part", "sheet").join(sheets, "sheet").join(layout_rows(spark), "layout")
            .join(found, "part", "left").withColumn("picks", F.coalesce(
                F.when(F.col("of").isNotNull(), place), F.array_repeat(F.lit(-1), len(TARGETS)))).drop("of")
            .withColumns({"file_year": extract_year(stem), "file_decree": extract_decree(stem)}))


def cell(target: str) -> Column:
    """The row's cell for ``target``: null where its header has no candidate."""
    return F.get("cells", F.get("picks", F.lit(TARGETS.index(target))))


def sheet_facts(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """Rules decided from a whole sheet's content: one aggregate over the sheets that need it.

    ``has_activity``, ``has_agri``, ``has_livestock``: any row has such a cell.
    """
    needs = F.col("activity_if_crop").isNotNull() | (F.col("activity_from_sheet") == "if_empty") | (
        F.col("side_rule") == "presence")
    needed = parts.filter(F.coalesce(needs, F.lit(False))).select("part", "picks")
    some = of_parts(rows, needed).join(F.broadcast(needed), "part")
    return some.groupBy("sheet").agg(
        F.max(cell("actividad").isNotNull()).alias("has_activity"), F.max(cell(HAS_AGRI).isNotNull()).alias("has_agri"),
        F.max(cell(HAS_LIVESTOCK).isNotNull()).alias("has_livestock"))


def project_rows(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """All rows of all layouts -> the harmonised columns (raw, before cleaning).

    ``parts`` has one row per file of the listing, so it is broadcast.
    """
    df = rows.drop("sheet").join(F.broadcast(parts), "part")
    made: dict[str, Column] = {}
    for i, target in enumerate(OUTPUT_COLUMNS):
        made[target] = F.coalesce(F.get("constants", F.lit(i)), cell(target))
    decree = F.when(~F.col("period").isin("fixed", "file"), cell(DECREE))

    def by_period(own: Column, file: str, fixed: Column) -> Column:
        return (F.when(F.col("period") == "fixed", fixed).when(F.col("period") == "file", F.col(file))
                .when(F.col("period") == "decree", own).otherwise(F.coalesce(own, F.col(file))))

    # no columns between: all that is made here goes into one projection, and the cells no further
    year, number = by_period(first_year(decree), "file_year", made["anio"].cast("int")), by_period(
        first_decree(decree), "file_decree", made["dto"])
    made["periodo"] = F.when(F.col("period") == "fixed", made["periodo"]).otherwise(build_period(year, number))
    made["anio"], made["dto"] = year, number
    empty = ~F.coalesce(F.col("has_activity"), F.lit(False))
    crop = F.col("activity_if_crop").isNotNull() & (F.get("picks", F.lit(TARGETS.index(CROP_HEADER))) >= 0)
    from_sheet = F.col("activity_from_sheet")
    made["actividad"] = (F.when((from_sheet == "always") | ((from_sheet == "if_empty") & empty), F.col("source_sheet"))
                         .when(crop & empty, F.col("activity_if_crop")).otherwise(made["actividad"]))
    by_name, by_presence = F.col("side_rule") == "sheet_name", F.col("side_rule") == "presence"
    agri, livestock = F.col("has_agri"), F.col("has_livestock")
    no_livestock = (by_name & F.col("agricultural")) | (by_presence & agri & ~livestock)
    no_agri = (by_name & ~F.col("agricultural")) | (by_presence & livestock & ~agri)
    for side, gone in ((LIVESTOCK_SIDE, no_livestock), (AGRI_SIDE, no_agri)):
        for target in side:
            made[target] = F.when(~F.coalesce(gone, F.lit(False)), made[target])
    made["source_file"], made["source_sheet"] = F.col("source_file"), F.col("source_sheet")
    # ingest order: (file, sheet, row) packed into one long, see check_ordinals
    row_id = F.col("fidx").cast("long") * (1 << 44) + F.col("sidx").cast("long") * (1 << 34) + F.col("row")
    return df.select(row_id.alias("row_id"), *[c.cast("string").alias(t) for t, c in made.items()])


def finalize(df: DataFrame) -> DataFrame:
    """The 47 columns in order, C1 on text, C2 on numbers, C3 on the
    year; rows empty in every column but file/sheet are dropped (T7: a
    layout with constants never drops a row).

    What only needs comparisons is done per cell, in compiled code.  The
    regular expressions run once over all texts and once over all numbers of
    a row, joined: with a copy per column the plan is too long to be compiled,
    and as a function over an array it is interpreted.  Each step is a
    projection of its own, so that no value is made twice; between them a row
    has a few columns only, its cells in arrays."""
    others = [c for c in OUTPUT_COLUMNS if c not in TEXT_COLUMNS and c not in NUMERIC_COLUMNS]
    texts, numbers = ([F.col(c).cast("string") for c in group] for group in (TEXT_COLUMNS, NUMERIC_COLUMNS))
    each = lambda name, n=len(TEXT_COLUMNS): [F.get(name, F.lit(i)) for i in range(n)]
    # a plain array would be taken apart again, and each cell made wherever it is read
    kept = lambda cells: F.slice(F.array(*cells), 1, len(cells))
    plain = kept([year_text(c) if c == "anio" else F.col(c).cast("string") for c in others]).alias("__others")
    stage = df.select("row_id", plain, kept(texts).alias("__raw"), numeric_chars_joined(join_cells(numbers)).alias("__digits"),
                      odd_cells(numbers).alias("__odd_numbers"))
    stage = stage.select("row_id", "__others", kept([strip_trimmed(F.trim(t)) for t in each("__raw")]).alias("__stripped"), F.coalesce(
        F.transform("__odd_numbers", numeric_chars), F.split("__digits", JOINT, -1)).alias("__numbers"))
    stage = stage.select("row_id", "__others", "__numbers", join_cells([not_null_token(t) for t in each("__stripped")]).alias("__joined"),
                         odd_cells(each("__stripped")).alias("__odd_texts"))
    stage = stage.select("row_id", "__others", "__numbers", F.coalesce(
        F.transform("__odd_texts", clean_stripped_text), F.split(collapse_upper(F.col("__joined")), JOINT, -1)).alias("__texts"),
        F.monotonically_increasing_id().alias("__at"))
    other = dict(zip(others, each("__others", len(others)), strict=True))
    filled = [F.coalesce(x != "", F.lit(False)) if c == "anio" else x.isNotNull() for c, x in other.items()
              if c not in ("source_file", "source_sheet")]
    # a condition on the row's place stays where it is: pushed down to the join, the filter would clean each row again
    stage = stage.filter((F.col("__at") >= 0) & reduce(or_, [
        *filled, F.array_join("__texts", "") != "", F.exists("__numbers", lambda x: parse_numeric_chars(x).isNotNull())]))
    made = {c: year_of(x) if c == "anio" else x for c, x in other.items()}
    made.update({c: F.nullif(x, F.lit("")) for c, x in zip(TEXT_COLUMNS, each("__texts"), strict=True)})
    made.update({c: parse_numeric_chars(x) for c, x in zip(NUMERIC_COLUMNS, each("__numbers", len(NUMERIC_COLUMNS)), strict=True)})
    return stage.select(*[made[c].cast(OUTPUT_TYPES[c]).alias(c) for c in OUTPUT_COLUMNS], "row_id")


def of_parts(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """The rows of some files of the listing, by number: sheets of other files are not read at all."""
    return rows.filter(F.col("part").isin([r["part"] for r in parts.select("part").collect()]))


def harmonise_rows(cells: Cells, parts: DataFrame) -> DataFrame:
    """B0-B12 over every sheet of ``parts``."""
    rows = of_parts(cells.rows, parts)
    parts = parts.join(sheet_facts(rows, parts), "sheet", "left")
    return finalize(project_rows(rows, parts))
