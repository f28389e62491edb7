"""Benchmark: headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Each query is executed in full through the ``noop`` sink (every row is
produced, nothing is collected to the driver) and timed wall-clock.  Prints
one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from siniestro.plans.catalog import Catalog  # noqa: E402
from siniestro.registry import QUERIES  # noqa: E402
from siniestro.session import get_spark  # noqa: E402

HEADLINE = [
    "o1_kpis", "o3_declarations_per_resolution", "o3_declarations_per_resolution_filtered", "o4_top_departments",
    "o5_damage_histogram", "o6_monthly_evolution", "o7_all_producers", "o9_declaration_headers_of_resolution",
    "o11_detail_crops_of_resolution", "o12_parcels", "o13_geo_points", "o14_crops", "o16_crop_ranking_percent",
    "o17_unclassified_summary", "o18_herd", "o20_top_improvements", "o21_legal_activity_without_dominant",
    "c1_clean_text_documents", "c7_normalize_key_documents", "c2_clean_numeric", "k1_k9_quality_flags",
    "k11_f14_describe_surfaces", "l5_consolidated_same_level", "l8_conflicts", "l9_e8_details_without_principal",
    "m10_vw_all_ddjj_personas", "o3_declarations_per_resolution_unified", "o15_crops_unified", "o19_herd_unified",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = get_spark(f"local[{cpus}]", int(cpus) * 2, app_name="siniestro-bench")
    # warm-up: JVM, parquet footers, codegen caches
    QUERIES["o2_rubro_list"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    timings: dict[str, float] = {}
    # the consolidated tables that l5, m10 and the *_unified reports read are written first, on a line of their own
    t0 = time.perf_counter()
    Catalog(spark, sf_dir).stage()
    timings["stage_consolidated_tables"] = round(time.perf_counter() - t0, 3)
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(timings.values()), 3), "unit": "sec",
                      "queries": timings, "sf": sf, "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
