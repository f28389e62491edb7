"""Invariants of the pipeline on the smallest scale."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from siniestro.plans.catalog import Catalog


def test_consolidation_invariants(spark):
    cat = Catalog(spark, SF_SMALL)
    cur = cat.curated
    same_keys = cur.inputs.filter(F.col("relation_type").isin("consolidate_same_level", "standalone"))
    from siniestro.operators.consolidate import same_level_key
    keyed = same_level_key(same_keys)
    # one consolidated row per distinct dedup key
    assert cur.same_level.consolidated.count() == keyed.select("dedup_key").distinct().count()
    assert cur.same_level.consolidated.select("dedup_key").distinct().count() == cur.same_level.consolidated.count()
    # principal orphans + principals with detail = all principals
    principal = cur.complementary.principal
    parents = cur.complementary.detail.select(F.concat("evento_id_norm", F.lit("||IDDJ||"), "iddj_norm").alias("k")).distinct()
    matched = principal.join(parents, principal.principal_key == parents.k, "left_semi").count()
    assert matched + cur.relations.principals_without_detail.count() == principal.count()
    # every harmonised row has exactly one severity; counts add up
    sev = cat.raw_clean.groupBy("severidad_maxima").count().collect()
    assert sum(r["count"] for r in sev) == cat.raw_clean.count()
    assert {r["severidad_maxima"] for r in sev} <= {"ok", "estructural", "medio", "alto", "critico"}
    # files per event adds up to all input rows
    assert cur.relations.files_per_event.agg(F.sum("filas_raw_clean")).first()[0] == cur.inputs.count()


def test_unified_origin_counts(spark):
    cur = Catalog(spark, SF_SMALL, "actual")
    uni = Catalog(spark, SF_SMALL, "unificado")
    u = uni.table("ddjj_personas")
    by_origin = {r["origen_dato"]: r["count"] for r in u.groupBy("origen_dato").count().collect()}
    assert by_origin["actual"] == cur.table("ddjj_personas").count()
    assert by_origin["historico"] == cur.consolidated.count()
    assert sum(by_origin.values()) == u.count()
    # resolution keys are unique per origin
    r = uni.table("resoluciones")
    assert r.select("resolucion_all_id").distinct().count() == r.count()
