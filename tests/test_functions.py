"""Table-driven cases for the scalar functions (C1-C25), literal examples."""

import math

import pytest
from pyspark.sql import functions as F

from siniestro import functions as C
from siniestro.functions.text import norm_header, norm_staging_header


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("y")).first()["y"]


@pytest.mark.parametrize("value,expected", [
    (None, None), ("  juan   perez ", "JUAN PEREZ"), ("s/d", None), ("SD", None), ("Sin Dato", None),
    ("sin  dato", "SIN DATO"), (" abc ", "ABC"), ("", None), ("  ", None), ("ñandú", "ÑANDÚ"),
])
def test_clean_text(spark, value, expected):
    assert one(spark, C.clean_text("x"), value) == expected


@pytest.mark.parametrize("value,expected", [
    ("1.234", 1.234), ("1.234,5", 1234.5), ("1,234.5", 1234.5), ("12 %", 12.0), ("-", None), ("10-20", None),
    ("1,2,3", None), ("$ 1.500,00", 1500.0), ("1e5", 15.0), (None, None), ("abc", None), ("-3,5", -3.5),
])
def test_clean_numeric(spark, value, expected):
    assert one(spark, C.clean_numeric("x"), value) == expected


@pytest.mark.parametrize("value,year,decree", [
    ("DTO 2014-1965", 2014, None), ("DTO 2002-708-804-868", 2002, "708-804-868"), ("98-99", None, "98-99"),
    ("DTO 2016-01", 2016, "01"), ("DTO 2002-_808", 2002, "808"), (None, None, None),
])
def test_year_and_decree(spark, value, year, decree):
    assert one(spark, C.extract_year("x"), value) == year
    assert one(spark, C.extract_decree("x"), value) == decree


@pytest.mark.parametrize("y,d,expected", [(2001, "133", "2001-133"), (None, "133", "-133"), (2001, None, "2001"),
                                          (None, None, None)])
def test_build_period(spark, y, d, expected):
    df = spark.createDataFrame([(y, d)], "y int, d string")
    assert df.select(C.build_period("y", "d").alias("p")).first()["p"] == expected


@pytest.mark.parametrize("value,key,code_fixed", [
    ("123.0", "123_0", "123"), ("Ñandú, S.A.", "NANDU_S_A", "NANDU_S_A"), ("s/d", "", ""), (None, "", ""),
    ("  Ĳssel ", "IJSSEL", "IJSSEL"), ("straße", "STRASSE", "STRASSE"),
])
def test_normalize_key_and_code(spark, value, key, code_fixed):
    assert one(spark, C.normalize_key("x"), value) == key
    assert one(spark, C.normalize_code("x"), value) == key                      # T2: '.0' never stripped
    assert one(spark, C.normalize_code("x", strip_float_suffix=True), value) == code_fixed
    assert one(spark, C.normalize_key("x", exact=True), value) == key


@pytest.mark.parametrize("num,den,expected", [(5.0, 10.0, 50.0), (5.0, 0.0, 0.0), (5.0, None, 0.0), (None, 10.0, 0.0)])
def test_add_percent(spark, num, den, expected):
    df = spark.createDataFrame([(num, den)], "n double, d double")
    assert df.select(C.add_percent("n", "d").alias("p")).first()["p"] == expected


@pytest.mark.parametrize("value,expected", [
    ("-2769864082", -27.69864082), ("-290000000000", -29.0), ("0", None), ("-27,5", None), ("12", 12.0),
    ("999", 99.9), ("abc", None), ("", None), ("NULL", None), (None, None), ("0.00", 0.0),
])
def test_repair_coord(spark, value, expected):
    got = one(spark, C.repair_coord("x"), value)
    assert (got is None and expected is None) or math.isclose(got, expected)


@pytest.mark.parametrize("value,expected", [
    (None, "(s/d)"), ("", "(s/d)"), ("corto", "corto"), ("x" * 48, "x" * 48), ("x" * 46 + "  yz", "x" * 46 + "..."),
])
def test_short_label(spark, value, expected):
    assert one(spark, C.short_label("x"), value) == expected


@pytest.mark.parametrize("value,expected", [(None, True), (" (S/D) ", True), ("Sin datos", True), ("maiz", False)])
def test_is_unclassified(spark, value, expected):
    assert one(spark, C.is_unclassified("x"), value) is expected


def test_sanitize_and_zero_dates(spark):
    assert one(spark, C.sanitize_value("x"), "a\x01b\tc\nd\re") == "a b\tc\nd e"
    assert len(one(spark, C.sanitize_value("x"), "y" * 5000)) == 1000
    assert one(spark, C.sanitize_value("x", "binary"), bytearray(b"abc"), "x binary") == "<binary 3 bytes>"
    assert one(spark, F.to_date(C.repair_zero_date("x")), "0000-00-00").isoformat() == "1970-01-01"


def test_headers():
    assert norm_header("AÑO DECRETO") == "ANO_DECRETO"
    assert norm_header(" Sup. Afect (ha) ") == "SUP_AFECT_HA"
    assert norm_staging_header("Año  Dto") == "a_o_dto"
    assert norm_staging_header("???") == "columna"


def test_rgb_and_stable_id(spark):
    df = spark.createDataFrame([(150.0,), (None,), (50.0,)], "p double")
    r, g, b = C.damage_rgb("p")
    assert [tuple(x) for x in df.select(r, g, b).collect()] == [(255, 80, 0), (0, 80, 255), (127, 80, 128)]
    same = spark.createDataFrame([("1", None, "A"), (None, "1", "A"), ("1", "", "A"), ("1", None, "A")],
                                 "x string, y string, z string")
    ids = [r[0] for r in same.select(C.stable_id("x", "y", "z")).collect()]
    assert len(set(ids)) == 3 and ids[0] == ids[3]


def test_keys_over_all_of_unicode(spark):
    chars = [chr(cp) for cp in range(1, 0x110000) if not 0xD800 <= cp < 0xE000]
    texts = ["a" + "x".join(chars[i:i + 40]) + "9" for i in range(0, len(chars), 40)]
    texts += ["ＡＢＣ１２", "½", "№5", "ﬁn", "①②", "Å", "㎏ x"]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    both = df.select("x", C.normalize_key("x").alias("a"), C.normalize_key("x", exact=True).alias("b"))
    assert [r.x for r in both.filter("a <> b").collect()] == []
    got = {r.x: r.a for r in both.collect()}
    assert (got["ＡＢＣ１２"], got["½"], got["№5"]) == ("ABC12", "1_2", "N_5")


@pytest.mark.parametrize("value", ["27d", "27f", "1.5F", "0x1p3", "27D "])
def test_numbers_that_only_java_reads(spark, value):
    assert one(spark, C.to_number("x"), value) is None
    assert one(spark, C.repair_coord("x"), value) is None


def test_cleaning_looks_at_a_cell_few_times(spark):
    from siniestro.functions.numeric import parse_numeric_chars
    assert str(parse_numeric_chars(F.col("x"))).upper().count("RLIKE") == 1
    assert one(spark, C.clean_text("x"), " a \t b  c~!d ") == "A B C~!D"
    assert [one(spark, C.clean_text("x"), t) for t in ("Sin Dato", "S/D", "sin datos")] == [None, None, "SIN DATOS"]
