"""Resolver, set operations, ranking and reconciliation helpers."""

from pyspark.sql import functions as F

from siniestro.functions.dates import resolve_year
from siniestro.operators.setops import missing_names, schema_diff
from siniestro.operators.windows import drop_dominant, top_n
from siniestro.plans.catalog import resolve
from siniestro.plans.validate import duplicate_keys, orphan_rates, is_protected


def test_mode_resolver():
    assert resolve("ddjj_personas", "actual") == "ddjj_personas"
    assert resolve("ddjj_personas", "UNIFICADO") == "vw_all_ddjj_personas"
    assert resolve("ganaderia_resumen", "actual") == "bovinos"
    assert resolve("otra_tabla", "unificado") == "otra_tabla"
    assert resolve("ddjj_personas", "otro_modo") == "ddjj_personas"


def test_resolve_year(spark):
    df = spark.createDataFrame([(None, "DTO_2001_133", "x.xlsx", 1999), (None, "EV", "DTO 2005.xlsx", 1999),
                                (2010, "EV", "x", None), (None, None, "x", 1999)],
                               "y0 int, ev string, f string, y int")
    got = [r[0] for r in df.select(resolve_year("y0", "ev", "f", "y")).collect()]
    assert got == [2001, 2005, 2010, 1999]


def test_schema_and_missing(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(1, 2)], "y int, z int")
    assert sorted((r["columna"], r["lado"]) for r in schema_diff(spark, a, b).collect()) == [
        ("x", "solo_origen"), ("z", "solo_destino")]
    assert [r[0] for r in missing_names(spark, ["a", "b", "c"], ["b"]).orderBy("nombre").collect()] == ["a", "c"]
    assert is_protected("vw_all_x") and is_protected("STG_tabla") and not is_protected("ddjj")


def test_ranking_helpers(spark):
    df = spark.createDataFrame([("A", "x", 5), ("A", "y", 5), ("B", "x", 7), ("C", "z", 1)], "g string, k string, n int")
    assert sorted(r["g"] for r in drop_dominant(df, "g", "n").collect()) == ["B", "C"]   # A has 10
    assert [r["k"] for r in top_n(df, "n", 3, "g", "k").collect()] == ["x", "x", "y"]
    assert [(r["g"], r["k"]) for r in top_n(df, "n", 2, "g", "k").collect()] == [("B", "x"), ("A", "x")]


def test_duplicate_keys_and_orphans(spark):
    df = spark.createDataFrame([("e", "1"), ("e", "1"), ("e", None), ("e", None), ("f", "2")], "ev string, k string")
    assert [tuple(r) for r in duplicate_keys(df, ["ev", "k"]).collect()] == [("e", "1", 2)]   # null keys excluded
    child = spark.createDataFrame([(1,), (2,), (None,), (9,)], "fk int")
    parent = spark.createDataFrame([(1,), (2,), (2,)], "pk int")
    r = orphan_rates([("c.fk", child, "fk", parent, "pk")]).first()
    assert (r["filas"], r["huerfanos"], r["tasa_huerfanos"]) == (4, 1, 0.25)
