"""Registered queries against their DuckDB oracle on the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as E
from siniestro.standins import BASE_TABLES
from conftest import SF_SMALL
import sys, os
sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools"))
from oracle_check import digest  # noqa: E402

SAMPLE = ["o1_kpis", "o3_declarations_per_resolution_filtered", "o4_top_departments", "o7_search_producers",
          "o13_geo_points", "o16_crop_ranking_percent", "o18_herd", "c2_clean_numeric", "c14_repair_coord",
          "k1_k9_quality_flags", "l5_consolidated_same_level", "l8_conflicts", "l9_e8_principals_without_detail",
          "m13_vw_all_agricultura", "o3_declarations_per_resolution_unified_one_resolution", "o19_herd_unified"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return con


def test_every_query_has_a_callable_and_entry_runs(spark):
    assert set(E.oracle_sql()) <= set(E.queries())
    assert E.entry(spark).count() >= 0


@pytest.mark.parametrize("name", SAMPLE)
def test_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rel = duck.sql(E.oracle_sql()[name])
    srows, drows = [tuple(r) for r in df.collect()], rel.fetchall()
    assert sorted(c.lower() for c in df.columns) == sorted(c.lower() for c in rel.columns)
    assert digest(df.columns, srows)[0] == digest(rel.columns, drows)[0]
