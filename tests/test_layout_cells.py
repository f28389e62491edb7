"""The cleaning of whole rows against the cleaning of single cells."""

import random

from pyspark.sql import functions as F

from siniestro.functions.numeric import clean_numeric
from siniestro.functions.text import JOINT, WS_CHARS, clean_text
from siniestro.plans.layouts import finalize
from siniestro.schema import NUMERIC_COLUMNS, OUTPUT_COLUMNS, TEXT_COLUMNS


def _raw(spark, rows):
    full = [(i, *[r.get(c) for c in OUTPUT_COLUMNS]) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, "row_id long, " + ", ".join(f"{c} string" for c in OUTPUT_COLUMNS))


def test_rows_are_cleaned_like_cells(spark):
    rng = random.Random(3)
    pieces = ["a", "B", "ñ", "ß", "İ", " ", "  ", "\t", "\n", "\x0b", "\x1c", "\xa0", " ", JOINT, "sin dato", "S/D", "nan", "None",
              "SD", "x" * 12, "\x7f", "\x00", "1", "-", ",", ".", "1.234,5", "1,234.5", "%", "７", "", "ǆ", "ŉ"]
    pieces += [f"{w}k{w}m{w}{w}n" for w in WS_CHARS]
    cell = lambda: None if rng.random() < 0.3 else "".join(rng.choice(pieces) for _ in range(rng.choice([0, 1, 1, 1, 2, 4])))
    rows = [{"evento_id": "E", **{c: cell() for c in TEXT_COLUMNS + NUMERIC_COLUMNS}} for _ in range(300)]
    raw = _raw(spark, rows)
    want = raw.select("row_id", *[clean_text(c).alias(c) for c in TEXT_COLUMNS], *[clean_numeric(c).alias(c) for c in NUMERIC_COLUMNS])
    got = finalize(raw).select(*want.columns)
    assert [tuple(r) for r in got.orderBy("row_id").collect()] == [tuple(r) for r in want.orderBy("row_id").collect()]


def test_cleaning_is_compiled_and_runs_once(spark):
    """Only rows with a cell that holds the joint are cleaned by a function over an array."""
    rows = _raw(spark, [{"codigo": "x"}]).join(F.broadcast(spark.range(1).withColumnRenamed("id", "row_id")), "row_id")
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        plan = finalize(rows)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert plan.count("transform(") == 2 and plan.count("coalesce(transform(__odd_") == 2
    assert plan.count("regexp_replace") == 4
    join = next(line for line in plan.splitlines() if "Join " in line)
    assert "regexp" not in join and "codigo" not in join
