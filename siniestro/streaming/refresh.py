"""Periodic reload of delivered files with Structured Streaming.

Deliveries land as ``<landing>/<run>/<files>``, one folder per run.  New files
are picked up by a file stream (``trigger(availableNow=True)``: process
everything new, then stop -- a scheduled batch with exactly-once bookkeeping
in the checkpoint).  What a delivery covers (a day, a source file) may be
delivered again in a later run: only the rows of its newest run count.

Each micro-batch puts its rows into a store partitioned by the refreshed key
and notes in a small index which run brought which delivery and key.  The
keys to recompute are those that any run of the batch's deliveries ever
touched; only their partitions of the store are read, and only their
partitions of the table are overwritten.  Store and index carry the batch
number as a partition that a retry overwrites, so a batch that runs twice
changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

RUN, TIME, BATCH = "__run", "__time", "__batch"


def land(df: DataFrame, path: str, day_col: str = "dia") -> None:
    """Deliver a table as one run, rows of a day together (a large day in several files)."""
    df.hint("rebalance", day_col).write.parquet(f"{path}/run-{uuid.uuid4().hex[:12]}")


def _write(df: DataFrame, path: str, *by: str) -> None:
    (df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*by).parquet(path))


def _newest_runs(index: DataFrame, delivery_col: str) -> DataFrame:
    """(delivery, run): the run that brought a delivery last."""
    return index.groupBy(delivery_col).agg(F.max_by(RUN, F.struct(TIME, RUN)).alias(RUN))


def refresh_landing(spark: SparkSession, landing_path: str, schema: StructType, table_path: str,
                    checkpoint_path: str, key: Callable[[DataFrame], DataFrame], partition_col: str,
                    rebuild: Callable[[DataFrame], DataFrame], delivery_col: str,
                    max_files_per_trigger: int | None = None) -> None:
    """Run the refresh until all delivered files are processed.

    ``key(df)`` maps rows to the partition values they affect (e.g. month);
    ``rebuild(rows)`` computes the table rows of those partitions from their
    live rows; ``delivery_col`` is what is delivered again as a whole.  A key
    whose rows have all moved elsewhere keeps its last partition in the table
    until :func:`live_keys` says otherwise.
    """
    store_path, index_path = f"{checkpoint_path}-store", f"{checkpoint_path}-index"
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(f"{landing_path}/*").select(
        "*", F.regexp_extract("_metadata.file_path", "([^/]+)/[^/]+$", 1).alias(RUN),
        F.col("_metadata.file_modification_time").alias(TIME))

    def upsert(batch: DataFrame, batch_id: int) -> None:
        rows = key(batch).withColumn(BATCH, F.lit(batch_id).cast("long"))
        _write(rows, store_path, partition_col, BATCH)
        store = spark.read.schema(rows.schema).parquet(store_path)
        own = store.filter(F.col(BATCH) == batch_id)
        places = own.groupBy(*dict.fromkeys((delivery_col, partition_col, RUN, BATCH))).agg(F.max(TIME).alias(TIME))
        _write(places, index_path, BATCH)
        index = spark.read.schema(places.schema).parquet(index_path)
        again = index.filter(F.col(BATCH) == batch_id).select(delivery_col).distinct()
        touched = index.join(again, delivery_col, "left_semi").select(partition_col).distinct()
        live = (store.join(touched, partition_col, "left_semi")
                .join(_newest_runs(index, delivery_col), [delivery_col, RUN], "left_semi"))
        _write(rebuild(live.drop(RUN, TIME, BATCH)), table_path, partition_col)

    q = (stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint_path)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def live_keys(spark: SparkSession, checkpoint_path: str, delivery_col: str, partition_col: str) -> DataFrame:
    """The keys that some delivery's newest run holds rows of."""
    index = spark.read.parquet(f"{checkpoint_path}-index")
    return (index.join(_newest_runs(index, delivery_col), [delivery_col, RUN], "left_semi")
            .select(F.col(partition_col).cast("string").alias(partition_col)).distinct())


def monthly_events(rows: DataFrame) -> DataFrame:
    """Monthly event summary per type (the refreshed table of the job)."""
    return rows.groupBy("mes", "event_type").agg(F.count(F.lit(1)).alias("eventos"),
                                                F.countDistinct("user_id").alias("usuarios"),
                                                F.max("value").alias("valor_max"))


def month_of(df: DataFrame) -> DataFrame:
    return df.withColumn("mes", F.date_format("ts", "yyyy-MM"))


def refresh_monthly_events(spark: SparkSession, runs: DataFrame | Sequence[DataFrame], work_dir: str,
                           max_files_per_trigger: int | None = 64) -> DataFrame:
    """Deliver one or more versions of ``events`` by day, run the refresh
    stream after each, return the refreshed monthly table."""
    landing, table, ckpt = f"{work_dir}/landing", f"{work_dir}/table", f"{work_dir}/checkpoint"
    for events in [runs] if isinstance(runs, DataFrame) else runs:
        delivered = events.withColumn("dia", F.date_format("ts", "yyyy-MM-dd"))
        land(delivered, landing)
        refresh_landing(spark, landing, delivered.schema, table, ckpt, month_of, "mes", monthly_events, "dia",
                        max_files_per_trigger)
    out_schema = "event_type string, eventos long, usuarios long, valor_max double, mes string"
    return (spark.read.schema(out_schema).parquet(table).join(live_keys(spark, ckpt, "dia", "mes"), "mes", "left_semi")
            .select("mes", "event_type", "eventos", "usuarios", "valor_max"))


__all__: Sequence[str] = ["land", "live_keys", "refresh_landing", "refresh_monthly_events", "monthly_events"]
