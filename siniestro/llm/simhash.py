"""Operator 6: near-duplicates by SimHash, a byte-position inverted index and count filtering.

1. ``fingerprints`` - per document the majority vote of XXH64 (seed 42) over
   its word shingles, repeats included.
2. Equal fingerprints are one node (their smallest document).
3. Inverted index over byte positions: fingerprints that differ in at most
   two bits differ in at most two of eight bytes, so among the four pairs of
   bytes at least two are equal.  A posting is therefore (two byte pairs, four
   byte values): six postings per fingerprint, 2**32 values each, so that
   lists stay short where single bytes would hold n / 256 entries.
4. Pairs that share a posting of up to ``LIGHT`` entries are tallied: the
   number of equal positional bytes must reach the guaranteed minimum, then
   the differing bits are counted.
5. Longer postings emit no pairs.  Two values are within two bits of each
   other exactly if they share a value within one bit of both, so every entry
   is joined to the smallest entry of each such value (star edges, 33 per
   entry: the posting fixes the other 32 bits).  No link is lost or invented.
6. Connected components (:mod:`components`).

Defined results: a text of fewer words than a shingle is one shingle; no words
(null and empty text too): fingerprint zero, linked like any other; a null
``doc_id`` sorts first and is returned as null; rows that repeat a ``doc_id``
are all returned, each with the fingerprint of its own text, and belong to one
component; extra columns are ignored here and kept by :func:`keep_one`.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siniestro.llm.columns import NULL_ID, doc_key, set_aside
from siniestro.llm.components import components
from siniestro.llm.words import LOWER, word_blocks
from siniestro.session import materialize

SHINGLE = 3
MAX_BITS = 2
LIGHT = 32
SEED = 42

def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The SimHash of one text as an unsigned 64-bit number."""
    raw = (text or "").encode().translate(LOWER)
    ones, n = np.zeros(64, np.int64), 0
    digest = xxhash.xxh64_intdigest
    for words in word_blocks(raw, shingle - 1):
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        k = min(shingle, len(words))
        pairs = zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist(), strict=True)
        votes = np.array([digest(joined[a:b], SEED) for a, b in pairs], np.uint64)
        ones += np.unpackbits(votes.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
        n += len(votes)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0]) if n else 0


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(id, fp): one row per row of ``docs``; null ids are the smallest long."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), shingle) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(found, np.uint64).view(np.int64))], names=["id", "fp"])

    return docs.select(doc_key().alias("id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(work, "id long, fp long")


def _pair(fp: Column, i: int) -> Column:
    """Byte pair i (0 lowest) of a fingerprint."""
    return F.shiftrightunsigned(fp, 16 * i).bitwiseAND(F.lit(0xFFFF).cast("long"))


def postings(nodes: DataFrame) -> DataFrame:
    """(posting, fp, id): the byte-position index; a posting names two byte pairs and their values."""
    fp = F.col("fp")
    keys = [F.lit(t << 32).cast("long").bitwiseOR(F.shiftleft(_pair(fp, i), 16)).bitwiseOR(_pair(fp, j))
            for t, (i, j) in enumerate(combinations(range(4), 2))]
    return nodes.select(F.explode(F.array(*keys)).alias("posting"), "fp", "id")


def links(nodes: DataFrame, max_bits: int = MAX_BITS, light: int = LIGHT) -> DataFrame:
    """(u, v): edges whose components are those of all pairs within ``max_bits``; ``nodes``: distinct (fp, id)."""
    if max_bits not in (1, 2):
        raise ValueError("the index guarantees its matches for one or two bits")
    index = postings(nodes)
    sized = materialize(index.join(index.groupBy("posting").count().filter("count > 1"), "posting"), "simhash-index")
    few = sized.filter(F.col("count") <= light).select("posting", "fp", "id")
    other = few.select("posting", F.col("fp").alias("fp2"), F.col("id").alias("id2"))
    differ = F.col("fp").bitwiseXOR(F.col("fp2"))
    byte = [F.shiftrightunsigned(differ, 8 * i).bitwiseAND(F.lit(255).cast("long")) for i in range(8)]
    tally = sum((F.when(b == 0, 1).otherwise(0) for b in byte[1:]), F.when(byte[0] == 0, 1).otherwise(0))
    pairs = (few.join(other, "posting").filter("id < id2").filter(tally >= 8 - max_bits)
             .filter(F.bit_count(differ) <= max_bits).select(F.col("id").alias("u"), F.col("id2").alias("v")))
    many = sized.filter(F.col("count") > light)
    bit = F.expr("shiftleft(1L, bit)")
    spread = many.select("posting", "fp", "id", F.explode(F.sequence(F.lit(0), F.lit(64))).alias("bit"))
    # only bits outside the posting's own byte pairs; 64 is the value itself
    table = [(i, j) for i, j in combinations(range(4), 2)]
    free = F.lit(False)
    for t, (i, j) in enumerate(table):
        free = free | ((F.shiftright("posting", 32) == t) & ~F.floor(F.col("bit") / 16).isin(i, j))
    if max_bits == 2:
        centre = F.when(F.col("bit") == 64, F.col("fp")).otherwise(F.col("fp").bitwiseXOR(bit))
        stars = spread.filter((F.col("bit") == 64) | free).select("id", centre.alias("c"), F.lit(0).alias("k"))
    else:
        stars = spread.filter((F.col("bit") < 64) & free).select(
            "id", F.col("fp").bitwiseAND(F.bitwise_not(bit)).alias("c"), F.col("bit").alias("k"))
    stars = stars.distinct()
    low = stars.groupBy("c", "k").agg(F.min("id").alias("u"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    starred = stars.join(low, ["c", "k"]).filter("id <> u").select("u", F.col("id").alias("v"))
    return pairs.unionByName(starred).distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                    light: int = LIGHT) -> DataFrame:
    """(id, fp, component): per row of ``docs``; ids with null as the smallest long."""
    marked = materialize(fingerprints(docs, shingle), "simhash")
    nodes = materialize(marked.groupBy("fp").agg(F.min("id").alias("id")), "simhash-nodes")
    # rows that repeat an id under several texts tie those texts' nodes together
    repeated = marked.distinct().groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    tied = (marked.join(repeated, "id", "left_semi").distinct().join(nodes.withColumnRenamed("id", "v"), "fp")
            .select(F.col("id").alias("u"), "v"))
    roots = components(links(nodes, max_bits, light).unionByName(tied))
    owner = nodes.join(roots.withColumnRenamed("node", "id"), "id", "left") \
        .select("fp", F.coalesce("root", "id").alias("component"))
    return marked.join(owner, "fp").select("id", "fp", "component")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The documents whose id is the smallest of their group; all columns stay."""
    found = near_duplicates(docs, shingle, max_bits)
    gone = found.filter("id <> component").select(F.col("id").alias("_id")).distinct()
    away, back = set_aside(docs)
    return docs.select(*away, doc_key().alias("_id")).join(gone, "_id", "left_anti").select(*back)


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    null = F.lit(NULL_ID)
    return near_duplicates(docs).select(
        F.nullif("id", null).alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.nullif("component", null).alias("component_id"))


QUERIES = {"op6_simhash_near_dedup": op6_simhash_near_dedup}
ORACLE: dict[str, str] = {}
