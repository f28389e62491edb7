"""Records of landed files: their cells, read at a cost that does not depend on the widest sheet allowed."""

import os
import tempfile

from pyspark.sql import functions as F

from siniestro.sources.cells import MAX_CELLS, _records, split_record


def _written(data: str) -> str:
    path = f"{tempfile.mkdtemp(prefix='records-')}/H.csv"
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write(data)
    return path


def test_cells_of_a_record(spark):
    want = {
        "a,b,c": ["a", "b", "c"], '"a ""q"" x",b,': ["a \"q\" x", "b", None], '"a,b",c': ["a,b", "c"], '"x\ny",b': ["x\ny", "b"],
        '"",b,""': [None, "b", None], 'a"b,c"d': ['a"b', 'c"d'], '"ab"cd,e': ['"ab"cd', "e"], '"a" ,b': ["a", "b"],
        ' "a",b': [' "a"', "b"], '"a""",,"""c"': ['a"', None, '"c'], ",,": [None] * 3, '""""': ['"'], 'a,5" pipe': ["a", '5" pipe'],
        '"é, ñ", x': ["é, ñ", " x"], "": [None], "x" * 9: ["x" * 9],
        ',"' + 'a""' * 20_000 + '",z': [None, 'a"' * 20_000, "z"]}
    rows = spark.createDataFrame([(k,) for k in want], "r string").select("r", split_record(F.col("r")).alias("cells")).collect()
    assert {r["r"]: r["cells"] for r in rows} == want


def test_reader_is_asked_for_one_column_of_its_schema(spark):
    """It takes an error's time for each column it is asked for that a record lacks."""
    path = _written('a,b\n"x\ny",2\n,\n3,"4"\n')
    records = _records(spark, [path])
    scan = records._jdf.queryExecution().executedPlan().toString()
    asked = scan[scan.index("ReadSchema: struct<"):].split(">")[0]
    assert asked.count(":string") == 2
    rows = sorted((r["id"], r["cells"], r["width"]) for r in records.collect())
    assert [r[1:] for r in rows] == [(["a", "b"], 2), (["x\ny", "2"], 2), ([None, None], 2), (["3", "4"], 2)]


def test_widths_up_to_the_limit(spark):
    for n in (1, MAX_CELLS, MAX_CELLS + 1, MAX_CELLS + 40):
        row = _records(spark, [_written(",".join(["v"] * n) + "\n")]).first()
        assert row["width"] == (n if n <= MAX_CELLS else None)
        assert n > MAX_CELLS or row["cells"] == ["v"] * n


def test_sheets_of_one_job_share_the_joined_orders(spark):
    from siniestro.sources import sheets
    folder = "/root/testdata/sf0.001"
    plan = lambda book: book["DTO 1998.xlsx"][0].frame._jdf.queryExecution().optimizedPlan().toString()
    apart, once = sheets.testdata_workbooks(spark, folder), sheets.testdata_workbooks(spark, folder, joined_once=True)
    assert "Join" in plan(apart) and "Join" not in plan(once)
    for file in ("DTO 1998.xlsx", "DTO 2000-1171.xlsx", "DTO 2019-128.xlsx"):
        a, b = (sorted(map(repr, x[file][0].frame.collect())) for x in (apart, once))
        assert a == b


def test_rows_are_left_to_the_caller_to_write(spark):
    from siniestro.plans.harmonise import harmonise_landing
    path = tempfile.mkdtemp(prefix="written-")
    os.makedirs(f"{path}/DTO 2009-1 GANADERO.xlsx")
    with open(f"{path}/DTO 2009-1 GANADERO.xlsx/H.csv", "w") as f:
        f.write('COD,AyN,SUP. TOT\n1,"  ana  \tpaz ","1.234,5"\n2, S/D ,-\n')
    both = [harmonise_landing(spark, path, [("DTO 2009-1 GANADERO.xlsx", "formato_ganadero_ancho")], written=w) for w in (True, False)]
    kept, lazy = ([(r["row_id"], r["codigo"], r["productor_nombre"], r["superficie_total"]) for r in h.clean.orderBy("row_id").collect()]
                  for h in both)
    assert kept == lazy == [(0, "1", "ANA PAZ", 1234.5), (1, "2", None, None)]
    assert [h.status.first()["filas"] for h in both] == [2, 2]
    names = [h.clean._jdf.queryExecution().optimizedPlan().toString().count("Relation [evento_id") for h in both]
    assert names == [1, 0]
