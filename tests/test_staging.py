"""Typed load with quarantine, and the access paths of the clustered table."""

import glob
import tempfile

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from conftest import SF_SMALL
from siniestro.sources.staging import FILE_ROWS, INDEX_COLUMNS, checked, curve, load_staging, rank_bounds
from siniestro.standins import standin


def test_accepted_and_rejected_rows_add_up(spark):
    rows = standin(spark, SF_SMALL, "staging_texts")
    out = load_staging(rows, tempfile.mkdtemp(prefix="stg-") + "/t")
    bad = out.rejects.select("row_id").distinct().count()
    assert bad > 0 and out.table.count() + bad == rows.count()
    assert {r["regla"] for r in out.rejects.collect()} == {"entero", "longitud 100", "numero", "booleano", "fecha"}
    types = dict(out.table.dtypes)
    assert types["anio"] == "int" and types["superficie_total"] == "double" and types["flag_revision_manual"] == "boolean"
    assert types["fecha_carga"] == "timestamp_ntz"


def test_rules(spark):
    rows = [(1, " 2001 ", "x" * 100, "1.5", "true"), (2, "2001.00", "x" * 101, "", None), (3, "2001.5", None, "1,5", "no se"),
            (4, "99999999999", "é" * 100, "NaN", "0"), (5, None, "", None, "")]
    df = spark.createDataFrame(rows, "`Row ID` int, `Anio` string, departamento string, superficie_total string, flag_revision_manual string")
    out = {r["row_id"]: ([x["columna"] for x in r["rechazos"]], r["anio"]) for r in checked(df).collect()}
    assert out == {1: ([], 2001), 2: (["departamento"], 2001), 3: (["anio", "superficie_total", "flag_revision_manual"], None),
                   4: (["anio"], None), 5: ([], None)}
    assert "fecha_carga" in checked(df).columns
    assert checked(spark.createDataFrame([], "a int")).count() == 0


def test_every_indexed_column_reads_a_part_of_the_files(spark):
    """From the files' own statistics: how many can hold a value of each of the seven columns."""
    base = standin(spark, "/root/testdata/sf0.01", "staging_texts").filter("anio = '1996' or row_id % 50 = 0")
    path = tempfile.mkdtemp(prefix="stg-") + "/t"
    table = load_staging(base, path, file_rows=5).table
    files = glob.glob(f"{path}/**/*.parquet", recursive=True)
    assert len(files) > 250
    for column in INDEX_COLUMNS:
        value = table.groupBy(column).count().orderBy(F.desc("count"), column).first()[0]
        if column == "anio":
            hit = [f for f in files if f"/anio={value}/" in f]
        else:
            hit = []
            for f in files:
                meta = pq.ParquetFile(f).metadata
                at = meta.schema.names.index(column)
                stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
                if any(s is None or s.min <= value <= s.max for s in stats):
                    hit.append(f)
        # the most frequent value: its rows fill their share of the files, whatever the layout
        found = table.filter(F.col(column) == value).count()
        most = min(len(files) - 1, max(0.75, found / table.count() + 0.25) * len(files))
        assert 0 < len(hit) <= most, (column, len(hit), len(files))
        assert found == [r["count"] for r in table.groupBy(column).count().collect() if r[0] == value][0]


def test_rank_bounds_are_few(spark):
    df = spark.range(5000).selectExpr("lpad(cast(id as string), 5, '0') as a", "'one' as b", "cast(null as string) as c")
    bounds = rank_bounds(df, ["a", "b", "c"])
    assert len(bounds["a"]) == 16 and bounds["b"] == [("one", 8)] and bounds["c"] == []
    assert bounds["a"][0] == ("00000", 0) and bounds["a"][-1][1] == 15


def test_equal_rows_span_files(spark):
    rows = spark.range(3000).selectExpr("id as row_id", "2001 as anio", "'D' as departamento")
    path = tempfile.mkdtemp(prefix="stg-") + "/t"
    assert load_staging(rows, path, file_rows=500).table.count() == 3000
    assert len(glob.glob(f"{path}/**/*.parquet", recursive=True)) >= 6


def test_rows_are_checked_once(spark):
    """The checked rows are written and read: their check is in no plan after that."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        seen.add(1)
        return x

    rows = spark.range(50).select(F.col("id").alias("row_id"), counted(F.lit("2001")).alias("anio"), F.lit("D").alias("departamento"))
    out = load_staging(rows.withColumn("departamento", counted("departamento")), tempfile.mkdtemp(prefix="stg-") + "/t")
    assert out.table.count() == 50 and out.rejects.count() == 0
    assert seen.value == 100  # two columns, 50 rows


def test_curve_is_compiled_and_ranks_by_least_value(spark):
    bounds = {"a": [("b", 2), ("d", 7), ("f", 15)], "b": [("x", 8)], "c": []}
    place = curve(bounds)
    assert "lambda" not in str(place)
    df = spark.createDataFrame([("a", "x"), ("b", "w"), ("c", None), ("d", "y"), ("e", "x"), ("f", "x"), ("z", "x"), (None, "x")], "a string, b string")
    bits = lambda ra, rb: sum(((ra >> i & 1) << (2 * i + 1)) + ((rb >> i & 1) << (2 * i)) for i in range(4))
    want = [bits(*x) for x in [(0, 8), (2, 0), (2, 0), (7, 8), (7, 8), (15, 8), (15, 8), (0, 8)]]
    assert [r[0] for r in df.select(place).collect()] == want


def test_a_task_writes_a_bounded_number_of_rows():
    assert FILE_ROWS <= 500_000
