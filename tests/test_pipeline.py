"""Landing zone, layouts, harmonisation status and the streaming refresh."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from siniestro.plans.harmonise import harmonise, harmonise_workbook
from siniestro.plans.layouts import LAYOUTS
from siniestro.sources.landing import list_landing, list_workbooks, read_landing, read_registry, select_tables
from siniestro.sources import sheets as SH
from siniestro.sources.sheets import TESTDATA_FORMATS
from siniestro.standins import base_table


def _write_sheet(path, header, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(",".join(header) + "\n")
        for r in rows:
            f.write(",".join(r) + "\n")


def test_landing_roundtrip_and_layout(spark):
    root = tempfile.mkdtemp(prefix="landing-")
    o = base_table(spark, SF_SMALL, "orders").orderBy("o_orderkey").limit(30).collect()
    rows = [[str(r["o_orderkey"]), f"\"{r['o_totalprice']:.0f},5\"", str(r["o_orderkey"] % 40), "Jose  Perez "] for r in o]
    _write_sheet(f"{root}/DTO 2009-277 GANADERO.xlsx/Hoja1.csv", ["COD", "SUP. TOT", "EXIS", "AyN"], rows)
    _write_sheet(f"{root}/DTO 2009-277 GANADERO.xlsx/Hoja2.csv", ["X"], [["1"]])
    for name in ("~$lock.xlsx", "Libro.XLSX"):      # the file scan skips zero-length files
        with open(f"{root}/{name}", "w") as f:
            f.write("PK")
    assert [r["nombre"] for r in list_workbooks(spark, root).collect()] == ["Libro.XLSX"]
    assert list_landing(spark, root).count() == 2
    sheets = read_landing(spark, root)
    out = harmonise_workbook(spark, "formato_ganadero_ancho", sheets["DTO 2009-277 GANADERO.xlsx"])
    got = out.orderBy("row_id").collect()
    assert len(got) == 30 and got[0]["anio"] == 2009 and got[0]["dto"] == "277"
    assert got[0]["productor_nombre"] == "JOSE PEREZ" and got[0]["actividad"] == "GANADERIA"
    assert got[1]["superficie_total"] == float(f"{o[1]['o_totalprice']:.0f}") + 0.5
    assert [r["row_id"] for r in got] == sorted(r["row_id"] for r in got)


def test_registry_bom_and_required(spark):
    root = tempfile.mkdtemp(prefix="reg-")
    with open(f"{root}/formats.csv", "w", encoding="utf-8") as f:
        f.write("﻿archivo,formato\nA.xlsx,formato_2019\n")
    reg = read_registry(spark, f"{root}/formats.csv", ["archivo", "formato"])
    assert reg.columns == ["archivo", "formato"]
    assert select_tables(["Fotos", "ddjj"], drop=["fotos"]) == ["ddjj"]
    assert select_tables(["Fotos", "ddjj"], drop=["fotos"], keep=["FOTOS"]) == ["Fotos", "ddjj"]


def test_harmonise_status_and_sheet_rules(spark):
    h = harmonise(spark, SH.testdata_workbooks(spark, SF_SMALL), TESTDATA_FORMATS)
    status = {r["archivo"]: (r["estado"], r["filas"]) for r in h.status.collect()}
    assert status["NUEVO 2020.xlsx"][0] == "formato_no_implementado"
    assert status["FALTA 2010.xlsx"][0] == "archivo_no_encontrado"
    assert status["ROTO 2012.xlsx"][0] == "error"
    assert status["DTO 1998.xlsx"][0] == "ok" and status["DTO 1998.xlsx"][1] > 0
    rows = h.clean
    # B1: no ACTIVIDAD column but a CULTIVO header -> constant activity
    assert {r["actividad"] for r in rows.filter(F.col("source_file") == "DTO 1998.xlsx").collect()} == {"AGRICULTURA_FORESTAL"}
    # Agricultural sheet keeps no livestock surfaces and vice versa
    agric = rows.filter((F.col("source_file") == "DTO 2015-55.xlsx") & (F.col("source_sheet") == "AGRIC"))
    assert agric.filter(F.col("superficie_ganadera_uso").isNotNull()).count() == 0
    # Empty ACTIVIDAD column -> sheet name; livestock-only sheet nulls the agricultural side
    gan = rows.filter((F.col("source_file") == "DTO 2016-01 EMERGENCIA.xlsx") & (F.col("source_sheet") == "GANADERIA"))
    assert {r["actividad"] for r in gan.collect()} == {"GANADERIA"}
    assert gan.filter(F.col("superficie_agricola_uso").isNotNull()).count() == 0
    # B2 reads only the JURADAS sheet; B3 skips the empty sheet and keeps its constants
    assert {r["source_sheet"] for r in rows.filter(F.col("source_file") == "DTO 2000-1171.xlsx").collect()} == {"JURADAS"}
    det = rows.filter(F.col("source_file") == "DTO 2001-133 AGRICOLAS.xlsx").select("evento_id", "periodo").distinct().collect()
    assert [(r["evento_id"], r["periodo"]) for r in det] == [("DTO_2001_133", "2001-133")]
    assert set(LAYOUTS) >= {f for _, f in TESTDATA_FORMATS if f != "formato_desconocido"}


def test_streaming_refresh_matches_batch(spark):
    from siniestro.streaming.refresh import monthly_events, month_of, refresh_monthly_events
    events = base_table(spark, SF_SMALL, "events")
    work = tempfile.mkdtemp(prefix="p1-")
    got = sorted(tuple(r) for r in refresh_monthly_events(spark, events, work, max_files_per_trigger=1).collect())
    want = sorted(tuple(r) for r in monthly_events(month_of(events))
                  .select("mes", "event_type", "eventos", "usuarios", "valor_max").collect())
    assert got == want


def test_registry_duplicate_in_the_last_row(spark):
    import pytest
    from siniestro.operators.joins import attach_registry
    reg = spark.range(2000).selectExpr("concat('f', least(id, 1998)) as source_file", "id as n")
    joined = attach_registry(reg.select("source_file").distinct(), reg)   # nothing runs yet
    with pytest.raises(Exception, match="registry has 2 rows for source_file f1998"):
        joined.collect()
    assert attach_registry(reg.select("source_file"), reg.filter("n < 1999")).count() == 2000


def test_staging_honours_its_own_inputs(spark):
    from siniestro.plans.catalog import Catalog
    whole = Catalog(spark, SF_SMALL)
    n = whole.curated.inputs.count()
    few = Catalog(spark, SF_SMALL, frames={"raw_rows": whole.physical("raw_rows").orderBy("row_id").limit(3)})
    assert few.curated.inputs.count() == 3 and n > 3
    assert Catalog(spark, SF_SMALL).stage() is whole.stage()


def test_materialized_tables_can_be_removed(spark):
    from siniestro import session
    known = session._WRITTEN.pop(spark.sparkContext.applicationId, [])   # other tests still read theirs
    out = session.materialize(spark.range(3), "cleanup")
    path = session._WRITTEN[spark.sparkContext.applicationId][0]
    assert out.count() == 3 and os.path.isdir(path)
    assert session.remove_materialized(spark) == 1 and not os.path.exists(path)
    session._WRITTEN[spark.sparkContext.applicationId] = known


def test_csv_quotes(spark):
    from siniestro.sources.landing import read_sheet, write_csv
    root = tempfile.mkdtemp(prefix="csv-")
    _write_sheet(f"{root}/a.csv", ["X", "Y"], [['"a ""b"" c"', "1"]])
    got = read_sheet(spark, f"{root}/a.csv").select("X").first()["X"]
    assert got == 'a "b" c'
    write_csv(spark.createDataFrame([('p "q", r',)], "X string"), f"{root}/out")
    assert read_sheet(spark, f"{root}/out").first()["X"] == 'p "q", r'


def test_copy_allow_list_and_exclusions(spark):
    from siniestro.sources.landing import select_tables, snapshot_tables
    frames = {n: spark.range(3) for n in ("fotos", "usuarios_notix", "vw_all_x")}
    out = {r["tabla"]: r["error"] for r in snapshot_tables(frames, tempfile.mkdtemp(prefix="snap-"), list(frames))}
    assert out["fotos"] is None and "allow-list" in out["usuarios_notix"] and "protected" in out["vw_all_x"]
    assert select_tables(["fotos", "Menu_Admin"]) == ["fotos"]


def test_workbook_order_and_grouped_scan(spark):
    from siniestro.plans.harmonise import harmonise_landing
    from siniestro.sources.landing import list_sheets
    root = tempfile.mkdtemp(prefix="grouped-")
    header = ["COD", "AyN", "SUP. TOT"]
    for i in range(200):
        _write_sheet(f"{root}/DTO 2009-{i} GANADERO.xlsx/001__Zeta.csv", header,
                     [[str(i), "Ana", "1"], [f"x{i}", '"Luz ""B"""', "2"]])
        _write_sheet(f"{root}/DTO 2009-{i} GANADERO.xlsx/002__Alfa.csv", header, [["no", "no", "9"]])
    first = [s.source_sheet for s in list_sheets(spark, root) if s.sheet_ordinal == 0]
    assert first == ["Zeta"] * 200
    out = harmonise_landing(spark, root, [(f"DTO 2009-{i} GANADERO.xlsx", "formato_ganadero_ancho") for i in range(200)])
    rows = out.clean.collect()
    assert len(rows) == 400 and {r["source_sheet"] for r in rows} == {"Zeta"}
    assert len({r["row_id"] for r in rows}) == 400
    assert {(r["dto"], r["source_file"]) for r in rows} == {(str(i), f"DTO 2009-{i} GANADERO.xlsx") for i in range(200)}
    assert {r["productor_nombre"] for r in rows} == {"ANA", 'LUZ "B"'}
    assert [r["estado"] for r in out.status.collect()] == ["ok"] * 200


def test_headers_are_data(spark):
    """Sixty sheets with sixty headers: one scan, and the plan of three."""
    from siniestro.plans.harmonise import harmonise_landing
    from siniestro.sources.cells import _records
    from siniestro.sources.landing import list_sheets

    def run(n):
        root = tempfile.mkdtemp(prefix="headers-")
        for i in range(n):
            _write_sheet(f"{root}/DTO 2009-{i} GANADERO.xlsx/Hoja.csv", [f"X{i}", "COD", *["Y"] * (i % 4), "AyN"],
                         [["-", str(i), *["z"] * (i % 4), f"Ana {i}"]])
        paths = [p for s in list_sheets(spark, root) for p in s.paths]
        plan = _records(spark, paths)._jdf.queryExecution().optimizedPlan().toString()
        assert len(paths) == n and plan.count("Relation [") == 1
        formats = [(f"DTO 2009-{i} GANADERO.xlsx", "formato_ganadero_ancho") for i in range(n)]
        out = harmonise_landing(spark, root, formats)
        rows = {(r["codigo"], r["productor_nombre"], r["dto"]) for r in out.clean.collect()}
        assert rows == {(str(i), f"ANA {i}", str(i)) for i in range(n)}

    run(3)
    run(60)


def test_damaged_files_are_status_rows(spark):
    from siniestro.plans.harmonise import harmonise_landing
    root = tempfile.mkdtemp(prefix="damaged-")
    books = {"good": b'COD,AyN\n1,"Ana ""B"", x\ny"\n2,\n', "cut": b'COD,AyN\n1,Ana\n2,"Lu', "short": b"COD,AyN\n1\n",
             "long": b"COD,AyN\n1,2,3\n", "latin": "COD,AyN\n1,Peña\n".encode("latin-1"), "wide": b",".join([b"A"] * 300),
             "twice": b"AyN,A.y.N,SUP TOT,SUP. TOT\n1,2,3,4\n", "same": "﻿COD,COD,,\n7,8,9,10\n".encode(),
             "late": "COD,AyN\n".encode() + b"1,a\n" * 5000 + "2,ñ\n".encode("latin-1"), "header": b"COD\n"}
    for name, data in books.items():
        os.makedirs(f"{root}/{name}.xlsx")
        with open(f"{root}/{name}.xlsx/H.csv", "wb") as f:
            f.write(data)
    out = harmonise_landing(spark, root, [(f"{n}.xlsx", "formato_ganadero_ancho") for n in books])
    status = {r["archivo"][:-5]: (r["estado"], r["filas"], r["error"]) for r in out.status.collect()}
    assert {n for n, (state, _, _) in status.items() if state == "ok"} == {"good", "same", "header"}
    assert status["good"][1] == 2 and status["same"][1] == 1 and status["header"][1] == 0
    assert status["cut"][2] == "TruncatedRecord: row 3: a quote is never closed (H)"
    assert status["short"][2] == "RaggedRecord: row 2: 1 cells, the header has 2 (H)"
    assert status["long"][2].startswith("RaggedRecord: row 2: 3 cells")
    assert status["latin"][2].startswith("EncodingError: row 2") and status["late"][2].startswith("EncodingError: row 5002")
    assert status["wide"][2].startswith("TooWide")
    assert status["twice"][2] == "HeaderError: duplicate normalised headers: ['SUP_TOT'] (H)"
    rows = sorted((r["source_file"], r["codigo"], r["productor_nombre"]) for r in out.clean.collect())
    assert rows == [("good.xlsx", "1", 'ANA "B", X Y'), ("good.xlsx", "2", None), ("same.xlsx", "7", None)]


def test_keep_best_null_priority_last(spark):
    from siniestro.operators.windows import keep_best
    df = spark.createDataFrame([("a", None, 1), ("a", 0.0, 2), ("b", None, 3)], "k string, p double, o int")
    assert sorted((r.k, r.o) for r in keep_best(df, "k", "p", "o").collect()) == [("a", 2), ("b", 3)]


def test_keep_best_one_row_per_key_on_repeated_ids(spark):
    from siniestro.operators.windows import keep_best
    rows = [("a", 1.0, 7, "x"), ("a", 1.0, 7, "y"), ("a", 1.0, 7, "y"), ("b", 1.0, 7, "z"), ("b", 2.0, 9, "w"),
            ("c", None, 7, "v"), (None, 1.0, 7, "n"), (None, 1.0, 8, "m"), ("d", 1.0, 3, "p"), ("d", 2.0, 3, "q")]
    df = spark.createDataFrame(rows, "k string, p double, o int, t string").repartition(3)
    got = sorted((str(r.k), r.o, r.t) for r in keep_best(df, "k", "p", "o").collect())
    assert [(k, o) for k, o, _ in got] == [("None", 7), ("a", 7), ("b", 9), ("c", 7), ("d", 3)]
    assert dict((k, t) for k, _, t in got)["d"] == "q" and dict((k, t) for k, _, t in got)["None"] == "n"
    assert got == sorted((str(r.k), r.o, r.t) for r in keep_best(df.repartition(5), "k", "p", "o").collect())


def test_inventory_reports_header_problems(spark):
    from siniestro.sources.cells import cells_of, inventory
    books = cells_of(spark, SH.testdata_workbooks(spark, SF_SMALL))
    inv = {(r["archivo"], r["hoja"]): r for r in inventory(spark, books).collect()}
    assert inv[("ROTO 2012.xlsx", "Hoja1")]["error"].startswith("HeaderError")
    assert inv[("DTO 2009-277 GANADERO.xlsx", "Hoja1")]["error"] is None
    assert inv[("DTO 2001-133 AGRICOLAS.xlsx", "N2")]["filas"] == 0


def test_rows_are_numbered_over_the_parts_of_a_sheet(spark):
    from siniestro.sources.cells import read_cells
    from siniestro.sources.landing import list_sheets
    root = tempfile.mkdtemp(prefix="landing-parts-")
    want = set()
    for book in ("A.xlsx", "B.xlsx"):
        os.makedirs(f"{root}/{book}/hoja.csv")
        n = 0
        for part, size in enumerate((3, 0, 700, 1, 40)):
            lines = ["a,b"]
            for i in range(size):
                lines.append(f'{book}{part}-{i},"x\ny"' if i % 3 else f"{book}{part}-{i},")
                want.add((book, n, f"{book}{part}-{i}"))
                n += 1
            with open(f"{root}/{book}/hoja.csv/part-{part:05d}.csv", "w") as f:
                f.write("\n".join(lines) + "\n")
    cells = read_cells(spark, list_sheets(spark, root))
    names = [s.source_file for s in cells.sheets]
    assert {(names[r["sheet"]], r["row"], r["cells"][0]) for r in cells.rows.collect()} == want
    assert cells.rows.count() == len(want) and cells.flaws.count() == 0
