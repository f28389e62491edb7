"""The cleaning step of the layouts: same rules, in a plan that can be compiled."""

from siniestro.plans.layouts import finalize
from siniestro.schema import OUTPUT_COLUMNS
from siniestro.session import HUGE_METHOD, JIT_LIMIT, within_jit


def _raw(spark, rows):
    full = [(i, *[r.get(c) for c in OUTPUT_COLUMNS]) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, "row_id long, " + ", ".join(f"{c} string" for c in OUTPUT_COLUMNS))


def test_cleans_and_drops_empty_rows(spark):
    out = finalize(_raw(spark, [
        {"productor_nombre": "  ana \t paz ", "superficie_total": "1.234,5", "anio": "2001", "flag_revision_manual": "true"},
        {"productor_nombre": " s/d ", "source_file": "a.xlsx", "source_sheet": "h"},  # nothing but the file
        {"existencias": "7"}, {"codigo": "x"}, {"evento_id": "E"},
        {"superficie_total": "-", "cultivo": "  "}]))
    assert out.columns == [*OUTPUT_COLUMNS, "row_id"]
    rows = {r["row_id"]: r for r in out.collect()}
    assert sorted(rows) == [0, 2, 3, 4]
    assert (rows[0]["productor_nombre"], rows[0]["superficie_total"], rows[0]["anio"]) == ("ANA PAZ", 1234.5, 2001)
    assert rows[0]["flag_revision_manual"] is True
    assert (rows[2]["existencias"], rows[3]["codigo"], rows[4]["evento_id"]) == (7.0, "X", "E")


def test_each_rule_stands_in_the_plan_a_few_times(spark):
    plan = finalize(_raw(spark, [{"codigo": "x"}]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") < 20


def test_limit_of_methods_is_lowered_only(spark):
    before = spark.conf.get(HUGE_METHOD, None)
    try:
        spark.conf.unset(HUGE_METHOD)
        within_jit(spark)
        assert int(spark.conf.get(HUGE_METHOD)) == JIT_LIMIT
        spark.conf.set(HUGE_METHOD, "100")
        within_jit(spark)
        assert spark.conf.get(HUGE_METHOD) == "100"
    finally:
        spark.conf.unset(HUGE_METHOD) if before is None else spark.conf.set(HUGE_METHOD, before)
