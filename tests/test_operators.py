"""Operator semantics and the traps of the source system."""

from pyspark.sql import functions as F

from siniestro.functions.misc import first_existing
from siniestro.operators import aggregates as A
from siniestro.operators.consolidate import consolidate, conflicts, same_level_key
from siniestro.operators.filters import Filters, apply_filters
from siniestro.operators.joins import join_resolutions
from siniestro.operators.quality import add_quality_flags
from siniestro.operators.windows import duplicated, keep_best
from siniestro.schema import OUTPUT_COLUMNS

REG_COLS = "source_file string, evento_id string, dataset_role string, relation_type string, evento_nombre string, " \
           "anio_inicio int, anio_fin int, prioridad int, comentario string"


def registry(spark, rows):
    return spark.createDataFrame(rows, REG_COLS)


def raw(spark, rows):
    return spark.createDataFrame(rows, "row_id long, source_file string, codigo string, iddj string, "
                                       "productor_nombre string, documento_nro string, superficie_total double, "
                                       "dataset_role string, relation_type string, especie string, categoria string")


def test_t1_first_existing_is_plan_time(spark):
    df = spark.createDataFrame([(None, "b")], "A string, B string")
    assert df.select(first_existing(df, ["A", "B"]).alias("x")).first()["x"] is None
    assert df.select(first_existing(df, ["Z", "B"]).alias("x")).first()["x"] == "b"
    assert df.select(first_existing(df, ["Z"]).alias("x")).first()["x"] is None


def test_keep_best_priority_then_order_and_hot_key(spark):
    rows = [(i, "HOT" if i % 3 == 0 else f"K{i}", float(i % 2), i) for i in range(300)]
    df = spark.createDataFrame(rows, "row_id long, k string, p double, v long")
    best = {r["k"]: r["row_id"] for r in keep_best(df, "k", "p", "row_id").collect()}
    assert best["HOT"] == 3          # highest priority (1.0) first, then lowest row id
    assert len(best) == 201
    plan = keep_best(df, "k", "p", "row_id")._jdf.queryExecution().executedPlan().toString()
    # winners by aggregates with map-side combine; what is sorted is the winners, above the join
    assert plan.count("Window [") <= 1 and plan.index("Window") < plan.index("LeftSemi")


def test_duplicated_nulls_equal(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a")], "id int, k string")
    flags = {r["id"]: r["duplicado"] for r in duplicated(df, ["k"]).collect()}
    assert flags == {1: True, 2: True, 3: False}


def test_t8_null_damage_dropped_even_without_filters(spark):
    df = spark.createDataFrame([("2001-02-01", 10.0), ("2001-02-01", None), ("2001-02-01", 150.0)],
                               "fecha string, pondf double").withColumn("fecha", F.to_date("fecha"))
    assert apply_filters(df, Filters()).count() == 1


def test_t9_severity_descending(spark):
    base = {c: None for c in OUTPUT_COLUMNS}
    rows = [
        dict(base, evento_id="E", anio=2001, dataset_role="principal", superficie_agricola_uso=1.0,
             superficie_agricola_afectada=2.0, superficie_ganadera_uso=1.0, superficie_ganadera_afectada=5.0),  # alto
        dict(base, evento_id="E", anio=2001, dataset_role="principal", superficie_agricola_uso=1.0,
             superficie_agricola_afectada=2.0),                                                               # medio
        dict(base, evento_id="E", anio=2001, dataset_role="detalle_agricola", superficie_agricola_uso=1.0,
             superficie_agricola_afectada=2.0),                                                               # estructural
        dict(base, evento_id=None, anio=2001, superficie_ganadera_uso=1.0, superficie_ganadera_afectada=5.0),  # critico
        dict(base, evento_id="E", anio=2030),                                                                # critico
        dict(base, evento_id="E", anio=2001, dataset_role=None, superficie_agricola_uso=1.0,
             superficie_agricola_afectada=2.0),                                                               # ok
    ]
    from siniestro.schema import RAW_CLEAN_SCHEMA
    df = spark.createDataFrame([tuple(r[c] for c in OUTPUT_COLUMNS) for r in rows], RAW_CLEAN_SCHEMA)
    out = [(r["severidad_maxima"], r["flag_revision_manual"]) for r in add_quality_flags(df).collect()]
    assert out == [("alto", True), ("medio", True), ("estructural", False), ("critico", True), ("critico", True),
                   ("ok", False)]


def _fixture(spark):
    reg = registry(spark, [
        ("A.csv", "EV", "parcial_mismo_nivel", "consolidate_same_level", "Ev", 2001, 2001, 1, ""),
        ("B.csv", "EV", "parcial_mismo_nivel", "consolidate_same_level", "Ev", 2001, 2001, 2, ""),
        ("P.csv", "EC", "principal", "complementary_detail", "Ec", 2000, 2000, 1, ""),
        ("D.csv", "EC", "detalle_agricola", "complementary_detail", "Ec", 2000, 2000, 1, ""),
        ("O.csv", "EC", "otro", "complementary_detail", "Ec", 2000, 2000, 1, ""),
    ])
    r = raw(spark, [
        (1, "A.csv", "10", None, "Juan", "1", 5.0, "parcial_mismo_nivel", "consolidate_same_level", None, None),
        (2, "B.csv", "10", None, "Juan", "1", 7.0, "parcial_mismo_nivel", "consolidate_same_level", None, None),
        (3, "A.csv", "11", None, "Ana", "2", 1.0, "parcial_mismo_nivel", "consolidate_same_level", None, None),
        (4, "A.csv", "11", None, "Ana", "2", 1.0, "parcial_mismo_nivel", "consolidate_same_level", None, None),
        (5, "A.csv", None, None, None, None, 1.0, "parcial_mismo_nivel", "consolidate_same_level", None, None),
        (6, "A.csv", None, None, None, None, 2.0, "parcial_mismo_nivel", "consolidate_same_level", None, None),
        (7, "P.csv", None, "77", "Pia", "3", 1.0, "principal", "complementary_detail", None, None),
        (8, "P.csv", None, None, "Leo", "4", 1.0, "principal", "complementary_detail", None, None),
        (9, "D.csv", None, "77", None, None, 1.0, "detalle_agricola", "complementary_detail", "MAIZ", "A"),
        (10, "D.csv", None, "99", None, None, 1.0, "detalle_agricola", "complementary_detail", "SOJA", "B"),
        (11, "O.csv", None, "77", None, None, 1.0, "otro", "complementary_detail", None, None),
        (12, "Z.csv", "5", None, "Zoe", "9", 1.0, None, None, None, None),
    ])
    return r, reg


def test_consolidation_traps(spark):
    r, reg = _fixture(spark)
    cur = consolidate(r, reg)
    same = {row["row_id"]: row["dedup_key"] for row in cur.same_level.consolidated.collect()}
    assert 2 in same and 1 not in same             # higher priority file wins
    assert 3 in same and 4 not in same             # equal priority: ingest order wins
    assert 5 in same and 6 not in same             # T4: rows without identity collapse
    assert 12 in same                              # unmapped file -> standalone
    kept = consolidate(r, reg, keep_unidentified=True).same_level.consolidated
    assert {5, 6} <= {x["row_id"] for x in kept.collect()}
    principal = {x["row_id"] for x in cur.complementary.principal.collect()}
    detail = {x["row_id"] for x in cur.complementary.detail.collect()}
    assert principal == {7, 8} and detail == {9, 10}
    all_ids = {x["row_id"] for x in cur.inputs.collect()}
    assert 11 in all_ids and 11 not in principal | detail | set(same)   # T12
    orphan_p = {x["row_id"] for x in cur.relations.principals_without_detail.collect()}
    orphan_d = {x["row_id"] for x in cur.relations.details_without_principal.collect()}
    assert orphan_p == {8} and orphan_d == {10}    # alternative-key principal is always an orphan
    unmapped = {x["row_id"]: x["sin_event_mapping"] for x in cur.inputs.collect()}
    assert unmapped[12] and not unmapped[1]


def test_conflicts_against_brute_force(spark):
    r, reg = _fixture(spark)
    from siniestro.operators.consolidate import load_inputs
    same = same_level_key(load_inputs(r, reg).filter(F.col("relation_type") != "complementary_detail"))
    got = {(x["clave"], x["variable"]): x["valores_distintos"] for x in conflicts(same, "dedup_key").collect()}
    pdf = same.select("dedup_key", "superficie_total").toPandas()
    expect = {}
    for k, g in pdf.groupby("dedup_key"):
        vals = sorted(g["superficie_total"].dropna().unique())
        if len(g) > 1 and len(vals) > 1:
            expect[(k, "superficie_total")] = " | ".join(str(v) for v in vals)
    assert got == expect and len(expect) == 2


def test_e3_rewrite_is_an_equi_join(spark):
    decl = spark.createDataFrame([("actual", 1, None), ("historico", None, "EV")],
                                 "origen_dato string, id_resolucion_actual int, evento_id string")
    res = spark.createDataFrame([("actual", 1, None, "N1"), ("historico", None, "EV", "N2"), ("actual", 2, None, "N3")],
                                "origen_dato string, id_resolucion_actual int, evento_id string, numero string")
    j = join_resolutions(decl, res, unified=True)
    assert sorted(x["r_numero"] for x in j.collect()) == ["N1", "N2"]
    plan = j._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "__rk" in plan


def test_f8_one_scan_seven_rows(spark):
    from siniestro.operators.aggregates import HERD_CATEGORIES
    cols = [c for _, s, d in HERD_CATEGORIES for c in (s, d)]
    df = spark.createDataFrame([tuple(range(14)), tuple([None] * 14)], ", ".join(f"{c} long" for c in cols))
    out = A.herd_totals_wide(df)
    assert out.count() == 7
    assert out._jdf.queryExecution().executedPlan().toString().count("Scan") == 1
    empty = A.herd_totals_wide(df.filter("false"))
    assert empty.count() == 7                      # T13: all categories kept, even all-null


def test_report_filters_reach_the_scan(spark, capsys):
    from conftest import SF_SMALL
    from siniestro.plans import reports as R
    from siniestro.plans.catalog import Catalog
    from siniestro.registry import FILTERED
    df = R.declarations_per_resolution(Catalog(spark, SF_SMALL), FILTERED)
    df.explain("formatted")
    plan = capsys.readouterr().out
    # the date range on the derived DATE column is unwrapped into a timestamp range on the raw scan
    assert "GreaterThanOrEqual(o_orderdate,1996-03-01" in plan and "LessThan(o_orderdate,2000-11-01" in plan
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan


def _executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_hashes_and_profile_groups_once(spark):
    from siniestro.operators.aggregates import profile
    from siniestro.operators.windows import keep_best
    df = spark.createDataFrame([("a", 1.0, 1, "e", "f", 2000, "critico"), ("a", 2.0, 2, "e", None, 2001, None)],
                               "k string, p double, o long, evento_id string, source_file string, anio int, "
                               "severidad_maxima string")
    plan = _executed(keep_best(df, "k", "p", "o"))
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    out = profile(df, "t").first().asDict()
    assert out == {"tabla": "t", "filas": 2, "eventos": 1, "evento_id_nulos": 0, "source_files": 1, "anio_min": 2000,
                   "anio_max": 2001, "criticos": 1}


def test_quantiles_of_near_equal_and_equal_values(spark):
    import numpy as np
    from siniestro.operators.aggregates import exact_quantiles
    rng = np.random.default_rng(4)
    near = (1.0 + rng.random(20_000) * 1e-9).tolist()       # one bucket of any fixed grid
    few = [float(x) for x in rng.integers(0, 3, 20_000)]
    heavy = np.exp(rng.normal(0, 6, 20_000)).tolist()
    df = spark.createDataFrame(list(zip(near, few, heavy)), "a double, b double, c double").repartition(5)
    shares = (0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0)
    got = {r["variable"]: tuple(r)[1:] for r in exact_quantiles(df, ["a", "b", "c"], shares).collect()}
    for name, values in (("a", near), ("b", few), ("c", heavy)):
        assert np.allclose(got[name], np.quantile(values, shares), rtol=1e-15, atol=0)
    for n in (1, 2, 3, 7, 130):
        small = spark.createDataFrame([(float(i * i),) for i in range(n)], "a double")
        one = exact_quantiles(small, ["a"], shares).first()
        assert np.allclose(tuple(one)[1:], np.quantile([float(i * i) for i in range(n)], shares))


def test_exact_quantiles(spark):
    import numpy as np
    from siniestro.operators.aggregates import exact_quantiles
    rng = np.random.default_rng(3)
    x = np.concatenate((rng.normal(0, 1000, 501), np.repeat(7.5, 200), [-0.25, 0.0, 1e12]))
    y = [None, 1.0, 1.0, 4.0]
    rows = [(float(v), y[i % 4]) for i, v in enumerate(x)]
    got = {r.variable: (r.q0, r.q1, r.q2) for r in
           exact_quantiles(spark.createDataFrame(rows, "x double, y double"), ["x", "y"], (0.25, 0.5, 0.99)).collect()}
    ys = [v for _, v in rows if v is not None]
    for name, values in (("x", x), ("y", ys)):
        assert np.allclose(got[name], np.quantile(values, (0.25, 0.5, 0.99)))


def test_listings_without_a_cut(spark):
    from conftest import SF_SMALL
    from siniestro.plans import reports as R
    from siniestro.plans.catalog import Catalog
    cat = Catalog(spark, SF_SMALL)
    n = cat.physical("productores").count()
    assert R.search_producers(cat, limit=None).count() == n
    first = [r["id"] for r in R.search_producers(cat, limit=20).collect()]
    every = sorted((r["productor"] or "", r["id"]) for r in R.search_producers(cat, limit=None).collect())
    assert first == [i for _, i in every[:20]]


def test_unified_crops_and_herd_join_declarations_on_demand(spark):
    from conftest import SF_SMALL
    from siniestro.plans import reports as R
    from siniestro.plans.catalog import Catalog
    cat = Catalog(spark, SF_SMALL, "unificado")

    def reads_declarations(df):
        return " AS __id#" in df._jdf.queryExecution().optimizedPlan().toString()

    assert not reads_declarations(R.crops(cat)) and not reads_declarations(R.herd(cat))
    assert reads_declarations(R.crops(cat, R.AnalysisFilters(year=1996)))
    assert R.crops(cat).count() > 0 and R.herd(cat).count() > 0
