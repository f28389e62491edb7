"""P1 with C, K and L: the consolidation kept up to date inside the stream.

Harmonised files are delivered as ``<landing>/<run>/<files>``; a file may be
delivered again (its rows replace the earlier ones) or withdrawn (a row with
``retirado`` and no more).  Each micro-batch maps its rows to events, flags
them, and recomputes keys, winners and flags of the touched events only.

State, all under one folder:

- ``store``: live input rows with their keys by (event, batch); an event is written anew when
  it is touched, so superseded rows are gone from its newest partition;
- ``index``: per batch a small snapshot: which files an event's rows come from
  and which batch holds its newest partition;
- one table per curated result, by event.

Everything a batch writes is a partition with its own number (or an event it
overwrites whole), made from the snapshot before it: a batch that runs twice
after a failure writes the same again.  ``compact`` removes what the last
snapshot does not name, so state grows with the live rows, not with the number
of deliveries.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import normalize_key
from ..operators.consolidate import KEY_PREFIX, keyed_rows, load_inputs, with_keys
from ..operators.quality import add_quality_flags, apply_event_mapping
from ..operators.windows import keep_best
from ..session import materialize
from .refresh import BATCH, RUN, TIME

EVENT, CURRENT, WITHDRAWN = "clave_evento", "vigente", "retirado"
TABLES = ("consolidated", "principal", "detail")
_INDEX = f"source_file string, {EVENT} string, {CURRENT} long"


def event_key() -> Column:
    """The event as consolidation keys spell it; rows without one share ``_``."""
    key = normalize_key("evento_id")
    return F.when(key == "", F.lit("_")).otherwise(key)


def curated_tables(inputs: DataFrame) -> dict[str, DataFrame]:
    """L2-L6 over input rows that hold whole events: keys never span two of them.  Rows of the store have their keys."""
    keyed = inputs if f"{KEY_PREFIX}dedup_key" in inputs.columns else with_keys(inputs)
    return {"consolidated": keep_best(keyed_rows(keyed, "same_level_keyed"), "dedup_key", "prioridad", "row_id"),
            "principal": keep_best(keyed_rows(keyed, "principal_keyed"), "principal_key", "prioridad", "row_id"),
            "detail": keep_best(keyed_rows(keyed, "detail_keyed"), "detalle_key", "prioridad", "row_id")}


def deliver(rows: DataFrame, landing_path: str, withdrawn: tuple[str, ...] = ()) -> None:
    """One run: whole files, and the names of files that are withdrawn."""
    out = rows.withColumn(WITHDRAWN, F.lit(False))
    if withdrawn:
        gone = rows.sparkSession.createDataFrame([(f,) for f in withdrawn], "source_file string")
        out = out.unionByName(gone.withColumn(WITHDRAWN, F.lit(True)), allowMissingColumns=True)
    out.hint("rebalance", "source_file").write.parquet(f"{landing_path}/run-{uuid.uuid4().hex[:12]}")


def _files(spark: SparkSession, path: str):
    """The folder's file system and path."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _children(spark: SparkSession, path: str) -> dict[str, str]:
    """Partition folders directly below ``path``: value -> path."""
    system, place = _files(spark, path)
    if not system.exists(place):
        return {}
    found = [x.getPath() for x in system.listStatus(place) if x.isDirectory()]
    return {p.getName().split("=", 1)[1]: p.toString() for p in found if "=" in p.getName()}


def _write(df: DataFrame, path: str, *by: str) -> None:
    (df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*by).parquet(path))


def _snapshot(spark: SparkSession, base: str, before: int | None = None) -> DataFrame | None:
    """The newest index (older than batch ``before``), if any."""
    batches = {int(b): p for b, p in _children(spark, f"{base}/index").items()}
    known = [b for b in batches if before is None or b < before]
    return spark.read.schema(_INDEX).parquet(batches[max(known)]) if known else None


def apply_batch(spark: SparkSession, base: str, delivered: DataFrame, number: int, registry: DataFrame) -> None:
    """One micro-batch: ``delivered`` has harmonised rows, ``retirado``, run and time."""
    newest = materialize(delivered.groupBy("source_file").agg(F.max_by(RUN, F.struct(TIME, RUN)).alias(RUN)), "delivery")
    rows = delivered.join(newest, ["source_file", RUN], "left_semi").drop(RUN, TIME)
    files = newest.select("source_file")  # one row per file
    fresh = load_inputs(add_quality_flags(apply_event_mapping(rows.filter(~F.col(WITHDRAWN)).drop(WITHDRAWN), registry)), registry)
    fresh = materialize(with_keys(fresh).withColumn(EVENT, event_key()), "delivery-inputs")
    before = _snapshot(spark, base, number)
    live, untouched = fresh, None
    schema = fresh.withColumn(BATCH, F.lit(0).cast("long")).schema
    store = f"{base}/store"
    if before is not None:
        touched = materialize(before.join(files, "source_file", "left_semi").select(EVENT)
                              .unionByName(fresh.select(EVENT)).distinct(), "delivery-events")
        places = before.join(touched, EVENT, "left_semi").select(EVENT, F.col(CURRENT).alias(BATCH)).distinct()
        kept = (spark.read.schema(schema).parquet(store).join(F.broadcast(places), [EVENT, BATCH], "left_semi")  # one per event
                .join(files, "source_file", "left_anti").drop(BATCH))
        live = fresh.unionByName(kept)
        untouched = before.join(touched, EVENT, "left_anti")
    _write(live.withColumn(BATCH, F.lit(number).cast("long")), store, EVENT, BATCH)
    own = spark.read.schema(schema).parquet(store).filter(F.col(BATCH) == number).drop(BATCH)
    index = own.select("source_file", EVENT, F.lit(number).cast("long").alias(CURRENT)).distinct()
    if untouched is not None:
        index = index.unionByName(untouched)
    for name, df in curated_tables(own).items():
        _write(df, f"{base}/{name}", EVENT)
    # the snapshot comes last: until it is there, the one before it names the state
    index.coalesce(1).write.mode("overwrite").parquet(f"{base}/index/{BATCH}={number}")


def compact(spark: SparkSession, base: str) -> int:
    """Remove what the last snapshot does not name; returns how many folders.  Not while a batch runs."""
    last = _snapshot(spark, base)
    if last is None:
        return 0
    keep = {(r[0], str(r[1])) for r in last.select(EVENT, CURRENT).distinct().collect()}  # one per event
    indexes = _children(spark, f"{base}/index")
    gone = [p for b, p in indexes.items() if int(b) < max(map(int, indexes))]
    for event, path in _children(spark, f"{base}/store").items():
        gone += [p for b, p in _children(spark, path).items() if (event, b) not in keep]
    events = {e for e, _ in keep}
    for name in TABLES:
        gone += [p for e, p in _children(spark, f"{base}/{name}").items() if e not in events]
    for path in gone:
        system, place = _files(spark, path)
        system.delete(place, True)
    return len(gone)


def refresh_consolidation(spark: SparkSession, landing_path: str, schema: StructType, registry: DataFrame, base: str,
                          max_files_per_trigger: int | None = None) -> None:
    """Process all new deliveries, then stop; ``schema`` is that of the harmonised rows."""
    reader = spark.readStream.schema(schema.add(WITHDRAWN, "boolean") if WITHDRAWN not in schema.names else schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.format("parquet").load(f"{landing_path}/*").select(
        "*", F.regexp_extract("_metadata.file_path", "([^/]+)/[^/]+$", 1).alias(RUN),
        F.col("_metadata.file_modification_time").alias(TIME))
    query = (stream.writeStream.foreachBatch(lambda batch, number: apply_batch(spark, base, batch, number, registry))
             .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
    query.awaitTermination()
    compact(spark, base)


def read_tables(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The curated tables of the last snapshot's events."""
    last = _snapshot(spark, base)
    events = F.broadcast(last.select(EVENT).distinct())  # one row per event
    inputs = spark.read.parquet(f"{base}/store").drop(BATCH).withColumn(EVENT, F.col(EVENT).cast("string"))
    kinds = {name: df.schema for name, df in curated_tables(inputs).items()}  # a table may have no file yet
    return {name: spark.read.schema(kinds[name]).parquet(f"{base}/{name}").join(events, EVENT, "left_semi") for name in TABLES}
