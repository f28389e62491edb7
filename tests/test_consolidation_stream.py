"""The consolidation kept by the stream equals the batch result of the last state."""

import glob
import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from siniestro.operators.consolidate import load_inputs
from siniestro.operators.quality import add_quality_flags, apply_event_mapping
from siniestro.standins import standin
from siniestro.streaming.consolidation import (
    apply_batch, compact, curated_tables, deliver, read_tables, refresh_consolidation)

SHOWN = {"consolidated": ("row_id", "dedup_key", "superficie_total", "severidad_maxima", "flag_revision_manual"),
         "principal": ("row_id", "principal_key", "severidad_maxima"), "detail": ("row_id", "detalle_key", "superficie_total")}


def rows_of(frames):
    return {name: sorted(map(tuple, df.select(*SHOWN[name]).collect()), key=repr) for name, df in frames.items()}


def batch_result(rows, registry):
    return rows_of(curated_tables(load_inputs(add_quality_flags(apply_event_mapping(rows, registry)), registry)))


def stored(base):
    return sum(os.path.getsize(f) for f in glob.glob(f"{base}/store/**/*.parquet", recursive=True))


def test_changes_withdrawals_and_repeats(spark):
    raw, registry = standin(spark, SF_SMALL, "raw_rows"), standin(spark, SF_SMALL, "registro_eventos")
    base = tempfile.mkdtemp(prefix="consolidation-")
    landing = f"{base}/landing"

    def of(*files):
        return raw.filter(F.col("source_file").isin(*files))

    def run():
        refresh_consolidation(spark, landing, raw.schema, registry, f"{base}/state", max_files_per_trigger=2)

    early = of("F0.csv", "F2.csv", "F3.csv", "F5.csv", "F7.csv").withColumn("superficie_total", F.lit(-1.0))
    deliver(early, landing)
    run()
    assert rows_of(read_tables(spark, f"{base}/state")) == batch_result(early, registry)
    deliver(of("F0.csv", "F1.csv", "F3.csv", "F4.csv", "F6.csv"), landing, withdrawn=("F5.csv", "none.csv"))
    run()
    deliver(of("F2.csv", "F7.csv", "F0.csv"), landing, withdrawn=("F6.csv",))
    run()
    want = batch_result(raw.filter(~F.col("source_file").isin("F5.csv", "F6.csv")), registry)
    assert rows_of(read_tables(spark, f"{base}/state")) == want
    size = stored(f"{base}/state")
    for _ in range(1):   # state does not grow with deliveries of the same rows
        deliver(of("F2.csv", "F7.csv", "F0.csv"), landing)
        run()
    assert rows_of(read_tables(spark, f"{base}/state")) == want and stored(f"{base}/state") <= 1.2 * size


def test_a_batch_that_runs_twice_changes_nothing(spark):
    raw, registry = standin(spark, SF_SMALL, "raw_rows"), standin(spark, SF_SMALL, "registro_eventos")
    base = tempfile.mkdtemp(prefix="consolidation-")

    def delivered(files, run):
        return (raw.filter(F.col("source_file").isin(*files)).withColumn("retirado", F.lit(False))
                .withColumn("__run", F.lit(run)).withColumn("__time", F.lit("2024-01-01").cast("timestamp")))

    apply_batch(spark, base, delivered(["F0.csv", "F3.csv"], "a"), 0, registry)
    for _ in range(2):
        apply_batch(spark, base, delivered(["F1.csv", "F3.csv", "F4.csv"], "b"), 1, registry)
    want = batch_result(raw.filter(F.col("source_file").isin("F0.csv", "F1.csv", "F3.csv", "F4.csv")), registry)
    assert rows_of(read_tables(spark, base)) == want
    assert compact(spark, base) > 0 and compact(spark, base) == 0
    assert rows_of(read_tables(spark, base)) == want
