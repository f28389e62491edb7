"""Historical workbooks as landed sheets, derived from the driver tables.

Each sheet carries the raw header spellings of one layout (accents, dots,
spaces), numbers written as text in several locales, blank cells and null
tokens -- the same irregularities the harmonisation must absorb.  They feed
the layout queries; ``landing.read_landing`` reads real CSV sheets the same
shape.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize
from ..standins import base_table
from .landing import Sheet


def _num_text(c: Column, mod: int, comma: bool) -> Column:
    """An integer-valued measure written as text: ``123,4`` or ``1.234``."""
    whole = (F.floor(c).cast("bigint") % mod).cast("string")
    return F.concat(whole, F.lit("," if comma else "."), (F.floor(c).cast("bigint") % 10).cast("string"))


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = base_table(spark, sf_dir, "orders")
    c = base_table(spark, sf_dir, "customer")
    n = base_table(spark, sf_dir, "nation")
    return o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)


def _sheet(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
    return df.select(*[v.cast("string").alias(k) for k, v in cols.items()], F.col("o_orderkey").alias("__row"))


def testdata_workbooks(spark: SparkSession, sf_dir: str, joined_once: bool = False) -> dict[str, list[Sheet]]:
    """Workbooks over whole tables: every order is a row of every sheet of
    declarations, every line item a row of the agricultural detail.

    ``joined_once``: the orders with their customers are written and read by
    all sheets, for jobs over more than one."""
    o = _orders(spark, sf_dir)
    if joined_once:
        o = materialize(o.select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority", "c_custkey", "c_name",
                                 "c_mktsegment", "n_name"), "sheet-orders")
    k = F.col("o_orderkey")
    name = F.when(k % 9 == 0, F.lit(" s/d ")).otherwise(F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")))
    doc = F.lpad(F.col("c_custkey").cast("string"), 8, "0")
    price = F.col("o_totalprice")
    wb: dict[str, list[Sheet]] = {}

    def add(file: str, fidx: int, sheet: str, sidx: int, frame: DataFrame) -> None:
        wb.setdefault(file, []).append(Sheet(file, sheet, frame, fidx, sidx))

    add("DTO 1998.xlsx", 0, "Hoja1", 0, _sheet(o, {
        "AÑO DECRETO": F.concat(F.lit("DTO "), (F.lit(1998) + k % 2).cast("string"), F.lit("-"), (k % 900).cast("string")),
        "CODIGO": k, "DNI": doc, "Apellido y Nombre": name, "Localización": F.col("n_name"),
        "DEPARTAMENTO": F.col("n_name"), "CULTIVO": F.lower(F.col("c_mktsegment")),
        "SUPTOT": _num_text(price, 500, True), "SUP. AG": _num_text(price / 3, 300, True),
        "SUP AFECT": _num_text(price / 5, 310, False)}))
    add("DTO 2000-1171.xlsx", 1, "JURADAS", 1, _sheet(o, {
        "IDDJ": k, "Doc Nro": doc, "AyN": name, "Sección": (k % 7).cast("string"), "SUPTOT": _num_text(price, 400, True),
        "SUPAG": _num_text(price / 2, 200, True), "SUPAFECT": _num_text(price / 4, 250, True),
        "SUPGAN": _num_text(price / 7, 90, True), "SUPGANAFECT": _num_text(price / 9, 95, True),
        "OBS": F.when(k % 3 == 0, F.lit("sin dato")).otherwise(F.lit("revisar")),
        "FECHA": F.date_format("o_orderdate", "dd/MM/yyyy")}))
    add("DTO 2000-1171.xlsx", 1, "Resumen", 0, _sheet(o, {"TOTAL": k}))
    li = base_table(spark, sf_dir, "lineitem")
    # line numbers repeat within an order: rows are numbered by all that tells them apart
    nth = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate"))
    det = li.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_quantity", "l_partkey", nth.alias("nth"))
    add("DTO 2001-133 AGRICOLAS.xlsx", 2, "N1", 0, det.select(
        F.col("o_orderkey").cast("string").alias("IDDJ"), F.lit("Productor").alias("AYN"),
        F.concat(F.lit("especie "), (F.col("l_partkey") % 7).cast("string")).alias("ESPECIE"),
        (F.col("l_linenumber") % 3).cast("string").alias("CATEGORIA"),
        F.col("l_quantity").cast("int").cast("string").alias("SUP PLANT. SEMB"),
        (F.col("l_quantity").cast("int") % 9).cast("string").alias("SUP AFEC"),
        F.lit("12 %").alias("PORC AFEC"), (F.col("o_orderkey") * 64 + F.col("nth") - 1).alias("__row")))
    add("DTO 2001-133 AGRICOLAS.xlsx", 2, "N2", 1, _sheet(o.limit(0), {"IDDJ": k}))   # an empty sheet
    add("DTO 2016-01 EMERGENCIA.xlsx", 3, "AGRICULTURA", 0, _sheet(o, {
        "AÑO DTO": F.when(k % 4 == 3, F.lit(None)).otherwise(F.lit("DTO 2016-1")), "SOLICITUDID": k,
        "PRODUCTORDENOMINACION": name, "DOCUMENTONRO": doc, "CUITCUIL": F.concat(F.lit("20"), doc, F.lit("1")),
        "DEPARTAMENTODESC": F.col("n_name"), "CULTIVODESC": F.col("c_mktsegment"),
        "SUPERFICIEPLANTADA": _num_text(price, 600, True), "SUPERFICIEAFECTADA": _num_text(price / 2, 700, True),
        "SUPUSO": _num_text(price, 50, True)}))
    add("DTO 2016-01 EMERGENCIA.xlsx", 3, "GANADERIA", 1, _sheet(o, {
        "Año Dto": F.lit("2016-1"), "CODIGO": k, "ACTIVIDAD": F.lit(None), "SUPUSO": _num_text(price, 80, True),
        "SUPAFECT": _num_text(price / 3, 90, True), "EXISTENC": (k % 60).cast("string"),
        "MORTANDAD": (k % 70).cast("string")}))
    add("DTO 2009-277 GANADERO.xlsx", 4, "Hoja1", 0, _sheet(o, {
        "COD": k, "N° DOC": doc, "AyN": name, "DPTO": F.col("n_name"), "SUP. TOT": _num_text(price, 500, True),
        "SUP GAN": _num_text(price / 2, 300, True), "SUP GAN AF": _num_text(price / 3, 350, True),
        "EXIS": (k % 40).cast("string"), "PORC AF": F.concat((k % 100).cast("string"), F.lit("%")),
        "OBS": F.when(k % 5 == 0, F.lit("  ")).otherwise(F.lit("ok"))}))
    add("DTO 2015-55.xlsx", 5, "AGRIC", 0, _sheet(o, {
        "AÑO DTO": F.lit("2015-55"), "CODIGO": k, "PRODUCTORDENOMINACION": name,
        "SUPERFICIEPLANTADA": _num_text(price, 100, True), "SUPUSO": _num_text(price, 70, True),
        "SUPAFECT": _num_text(price / 2, 90, True)}))
    add("DTO 2015-55.xlsx", 5, "GANAD", 1, _sheet(o, {
        "CODIGO": k, "SUPUSO": _num_text(price, 70, True), "SUPAFECT": _num_text(price / 2, 90, True),
        "EXISTENC": (k % 30).cast("string")}))
    add("TABACO 2007-44.xlsx", 6, "Hoja1", 0, _sheet(o, {
        "COD": k, "CUIT": doc, "AYN": name, "DPTO": F.col("n_name"), "PLANTADA": _num_text(price, 40, True),
        "COSECHADA": _num_text(price / 2, 50, True), "PROD EST": (k % 900).cast("string"),
        "PROD OB": (k % 800).cast("string")}))
    add("GANADERO 2008-12 RESUMIDO.xlsx", 8, "Hoja1", 0, _sheet(o, {
        "COD": k, "DOC": doc, "AyN": name, "DPTO": F.col("n_name"), "Localización": F.concat(F.col("n_name"), F.lit(" norte")),
        "SECCION": (k % 11).cast("string"), "SUP TOT": _num_text(price, 500, True),
        "SUP GAN": _num_text(price / 2, 400, False), "SUP GAN AF": _num_text(price / 3, 410, True),
        "EXIS": F.when(k % 13 == 0, F.lit("s/d")).otherwise((k % 90).cast("string"))}))
    add("MONTE CASEROS 2006-300.xlsx", 9, "Datos", 0, _sheet(o, {
        "COD": k, "DOC": doc, "CUIL O CUIT": F.concat(F.lit("27-"), doc, F.lit("-3")), "AYN": name,
        "DPTO": F.lit("Monte  Caseros"), "LOC PJE PART": F.concat(F.col("n_name"), F.lit(" norte")), "SECCION": (k % 5).cast("string"),
        "SUP TOT": _num_text(price, 700, True), "SUP SEM": _num_text(price / 2, 300, True),
        "SUP AF": _num_text(price / 4, 320, False), "AF": F.concat((k % 100).cast("string"), F.lit(" %")),
        "OBS": F.when(k % 4 == 0, F.lit("Sin Dato")).otherwise(F.col("o_orderpriority"))}))
    add("AGRICOLA 2007-61.xls", 10, "Hoja1", 0, _sheet(o, {
        "IDDJ": k, "DOC. NRO": doc, "ING BRUTOS": F.concat(F.lit("20"), doc), "AYN": name, "DPTO ESTAB": F.col("n_name"),
        "LOC PJE PART": F.concat(F.col("n_name"), F.lit(" norte")), "DOM ESTAB": F.concat(F.lit("tel "), F.col("c_custkey").cast("string")), "SECCION": (k % 3).cast("string"),
        "ESPECIE": F.lower(F.col("c_mktsegment")), "CATEGORIA": F.col("o_orderpriority"),
        "SUPTOT": _num_text(price, 800, True), "SUP PLANT SEMB": _num_text(price / 2, 310, True),
        "PROD ESTIM": (k % 1000).cast("string")}))
    add("DTO 2019-128.xlsx", 11, "Hoja1", 0, _sheet(o, {
        "CODIGO": k, "DNI": doc, "Nombre / Razón Social": F.concat(F.lit('"'), F.col("c_name"), F.lit('" y otro')),
        "CUIT": F.concat(F.lit("30"), doc), "DEPARTAMENTO": F.col("n_name"), "LOCALIDAD": F.concat(F.col("n_name"), F.lit(" norte")),
        "PARAJE": F.when(k % 6 == 0, F.lit("-")).otherwise(F.concat(F.lit("tel "), F.col("c_custkey").cast("string"))),
        "RENSPA": F.concat(F.lit("05."), (k % 77).cast("string")),
        "MIXTO": F.when(k % 2 == 0, F.lit("ganadería")).otherwise(F.lit(None)), "ACTIVIDAD": F.lit("no se lee"),
        "TIPO CULTIVO": F.col("c_mktsegment"), "SUPERFICIE TOTAL": _num_text(price, 900, True),
        "SUPERFICIE EN USO AGR": _num_text(price / 2, 500, True), "SUP. EN USO GAN": _num_text(price / 3, 510, True),
        "SUPERFICIE AFECTADA AGR": _num_text(price / 4, 520, False),
        "SUP. AFECTADA TOTAL GAN": _num_text(price / 5, 530, True), "TOTAL CABEZAS": (k % 333).cast("string")}))
    add("ROTO 2012.xlsx", 7, "Hoja1", 0, _sheet(o, {"SUP TOT": k, "SUP. TOT": k}))
    return wb


# --- fixed values: registry of the derived workbooks (file, layout) --------------------
TESTDATA_FORMATS = [
    ("DTO 1998.xlsx", "formato_1998"),
    ("DTO 2000-1171.xlsx", "formato_juradas"),
    ("DTO 2001-133 AGRICOLAS.xlsx", "formato_detalle_agricola_2001"),
    ("DTO 2016-01 EMERGENCIA.xlsx", "formato_moderno_multisheet"),
    ("DTO 2009-277 GANADERO.xlsx", "formato_ganadero_ancho"),
    ("DTO 2015-55.xlsx", "formato_multisheet_2015"),
    ("TABACO 2007-44.xlsx", "formato_tabaco_2007"),
    ("ROTO 2012.xlsx", "formato_ganadero_resumido"),
    ("GANADERO 2008-12 RESUMIDO.xlsx", "formato_ganadero_resumido"),
    ("MONTE CASEROS 2006-300.xlsx", "formato_agricola_monte_caseros"),
    ("AGRICOLA 2007-61.xls", "formato_detalle_agricola_2007_xls"),
    ("DTO 2019-128.xlsx", "formato_2019"),
    ("NUEVO 2020.xlsx", "formato_desconocido"),
    ("FALTA 2010.xlsx", "formato_2019"),
]
