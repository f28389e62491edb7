"""Spark session and lineage helpers.

The library never creates a session implicitly inside a transformation;
callers pass their own ``SparkSession``.  ``get_spark`` is for tests, the
bench and command-line jobs.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_WRITTEN: dict[str, list[str]] = {}
"""Folders that materialize() wrote, by application."""

_REMOVALS: dict[str, int] = {}

_SHIPPED: set[str] = set()
"""Applications that have the package."""

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 * 1024 * 1024),
    # Small dimension tables (registries, lookups) are broadcast by size
    # statistics; anything above this stays a shuffle join.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    # Partition sizing for large inputs: scan splits of 256 MB; AQE coalesces
    # shuffle partitions towards 128 MB and splits skewed ones, so the static
    # shuffle partition count is only an upper bound.
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "siniestro") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("SINIESTRO_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for materialised intermediates.

    This is whatever the deployment names in ``spark.checkpoint.dir`` (a
    shared filesystem) or gave to ``setCheckpointDir``.  A scratch folder of
    our own is taken only where neither is set and driver and executors are
    one process; a cluster without a shared folder is an error, since each
    executor would write to its own disk.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="siniestro-ckpt-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured


HUGE_METHOD = "spark.sql.codegen.hugeMethodLimit"
JIT_LIMIT = 8000
"""Bytes of a method beyond which HotSpot only interprets it."""


def within_jit(spark: SparkSession) -> None:
    """Plans whose fused method the JVM would never compile run operator by
    operator, in methods that it does; a lower limit of the session stays."""
    if int(spark.conf.get(HUGE_METHOD, "65535")) > JIT_LIMIT:
        spark.conf.set(HUGE_METHOD, str(JIT_LIMIT))


ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def ready_for_python(spark: SparkSession) -> None:
    """Make a session fit for operators with Python tasks.

    Sends this package to the executors' Python workers, once per application
    (what ``--py-files`` does at submission), and bounds Arrow batches by
    bytes: ten thousand rows of whole texts may be any size.
    """
    context = spark.sparkContext
    spark.conf.set(ARROW_BYTES, DEFAULT_CONF[ARROW_BYTES])
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="siniestro-code-")) / "siniestro.zip"  # the driver serves it to the executors
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for source in sorted(root.rglob("*.py")):
            z.write(source, source.relative_to(root.parent).as_posix())
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and read it back.

    Cuts lineage so that a lost executor only recomputes from this table,
    and lets several downstream jobs share one scan.  Never a local
    checkpoint: the files live in the shared checkpoint folder.
    """
    spark = df.sparkSession
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.mode("overwrite").parquet(path)
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.parquet(path)


def removals(spark: SparkSession) -> int:
    """How often this application's materialised tables were removed."""
    return _REMOVALS.get(spark.sparkContext.applicationId, 0)


def remove_materialized(spark: SparkSession) -> int:
    """Delete what this application materialised; returns how many folders.

    To be called when all results are written: frames that still read an
    intermediate can't be computed afterwards.
    """
    application = spark.sparkContext.applicationId
    paths = _WRITTEN.pop(application, [])
    _REMOVALS[application] = removals(spark) + 1
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)
    return len(paths)


def materialize_all(frames: dict[str, DataFrame], prefix: str) -> dict[str, DataFrame]:
    """``materialize`` several independent tables concurrently: one Spark job
    per table, submitted from threads, so small jobs share the executors
    instead of running back to back."""
    if len(frames) <= 1:
        return {n: materialize(df, f"{prefix}-{n}") for n, df in frames.items()}
    with ThreadPoolExecutor(max_workers=len(frames)) as pool:
        futures = {n: pool.submit(materialize, df, f"{prefix}-{n}") for n, df in frames.items()}
        return {n: f.result() for n, f in futures.items()}
