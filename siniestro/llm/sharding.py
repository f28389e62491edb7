"""Operator 7: shards by longest-processing-time scheduling of groups that stay together.

Law ``bytes``: shards of nearly equal size.  Documents with equal texts are a
group.  Groups sorted by size go, largest first, to the least-loaded shard
through a heap.

Groups of equal size are interchangeable, so the driver schedules runs (size,
number of groups), not groups: :func:`schedule` says how many groups of a size
each shard takes, and loads are exactly those of a heap over all groups.
Sizes that differ are few: d of them need d * (d + 1) / 2 bytes, so there are
at most the square root of twice all bytes (14 million of 100 TB).  Spark
numbers the groups of a size - inside small hash chunks, the chunks' running
totals added, so no task sorts a size that many groups share - and a group's
number says its shard.

Slots are gapless per shard: documents are numbered inside small hash chunks
of a shard, and the chunks' running totals are added, so no task sorts a whole
shard.

Defined results: a null text has no bytes (size 1, crc32 0) and forms one
group with the empty text; a null ``doc_id`` is kept; repeated rows get slots
of their own (in no stated order among themselves); an empty table gives no
rows; groups of equal size go in order of their text's hash, equal loads to
the smaller shard; extra columns stay in :func:`shard`.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siniestro.llm.columns import doc_key, set_aside, text_or_empty
from siniestro.session import materialize

SHARDS = 8
CHUNK_ROWS = 20_000


def schedule(runs: Iterable[tuple[int, int]], shards: int = SHARDS) -> list[tuple[int, int, int, int]]:
    """Longest processing time first over runs (size, number of groups).

    Returns (size, shard, first, number): the groups of a size that a shard
    takes are those numbered from ``first`` on.  Before each of its groups of a
    run a shard has load + j * size, and the heap takes the smallest of these
    in turn; all but the last few groups of a long run are dealt at once, by
    bisecting for the level below which their loads lie.
    """
    heap = [(0, s) for s in range(shards)]
    out = []
    for size, number in sorted(runs, reverse=True):
        taken = [0] * shards
        if number > 2 * shards:
            def below(level: int, size: int = size) -> list[tuple[int, int]]:
                return [(s, max(0, (level - load + size - 1) // size)) for load, s in heap]

            low, high = min(heap)[0], max(heap)[0] + (number // shards + 1) * size
            while high - low > 1:
                middle = (low + high) // 2
                low, high = (middle, high) if sum(n for _, n in below(middle)) <= number else (low, middle)
            for s, n in below(low):
                taken[s] = n
            heap = [(load + taken[s] * size, s) for load, s in heap]
            heapq.heapify(heap)
        for _ in range(number - sum(taken)):
            load, s = heap[0]
            taken[s] += 1
            heapq.heapreplace(heap, (load + size, s))
        first = 0
        for s in range(shards):
            if taken[s]:
                out.append((size, s, first, taken[s]))
                first += taken[s]
    return out


def numbered(rows: DataFrame, keys: list[str], chunk: Column, order: list[str]) -> DataFrame:
    """``rows`` with ``_at``: a gapless number from 0 among those of equal ``keys``, by (chunk, order).

    Only a chunk is sorted in one task.
    """
    rows = rows.withColumn("_chunk", chunk)
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    start = (rows.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
             .select(*keys, "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    place = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    return (rows.withColumn("_place", F.row_number().over(place) - 1).join(start, [*keys, "_chunk"])
            .withColumn("_at", F.col("_start") + F.col("_place")).drop("_chunk", "_start", "_place"))


def shard(docs: DataFrame, shards: int = SHARDS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``docs`` without text, with ``size``, ``text_crc32``, ``shard`` and ``slot`` (like-named columns are replaced)."""
    spark = docs.sparkSession
    away, back = set_aside(docs, "text", "size", "text_crc32", "shard", "slot")
    raw = text_or_empty().cast("binary")
    rows = materialize(docs.select(
        *away, doc_key().alias("_id"), (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"), F.md5(raw).alias("_group")), "shard-rows")
    groups = materialize(rows.groupBy("_group").agg(F.sum("size").alias("_bytes")), "shard-groups")
    runs = groups.groupBy("_bytes").agg(F.count(F.lit(1)).alias("n")).collect()  # as many as there are sizes
    chunks = max(1, -(-rows.count() // chunk_rows))
    ranges = spark.createDataFrame(schedule(map(tuple, runs), shards), "_bytes long, shard int, _first long, _n long")
    placed = numbered(groups, ["_bytes"], F.pmod(F.xxhash64("_group"), F.lit(chunks)), ["_group"]) \
        .join(ranges, "_bytes") \
        .filter((F.col("_at") >= F.col("_first")) & (F.col("_at") < F.col("_first") + F.col("_n"))) \
        .select("_group", "shard")
    dealt = materialize(rows.join(placed, "_group"), "shard-dealt")
    slots = numbered(dealt, ["shard"], F.pmod(F.xxhash64("_id", "_group"), F.lit(chunks)), ["_id", "size", "text_crc32"])
    return slots.select(*back, "size", "text_crc32", "shard", F.col("_at").cast("long").alias("slot"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return shard(docs).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                              F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {"op7_sharding": op7_sharding}
ORACLE: dict[str, str] = {}
