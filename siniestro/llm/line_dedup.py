"""Operator 2: drop lines that a smaller document already holds.

DataFrame functions only.  A line's key is hashed to 128 bits; text never
leaves the scan of the first pass.

1. ``line_keys`` - one small row per line: hash, document, position.
2. ``first_holders`` - the rows are range-partitioned by hash and a slice of
   the document id, sorted by document and position inside; the rows of the
   first two documents of each (hash, slice) are streamed off the sorted run
   (a window group limit: nothing is buffered).  A line that a third of all
   documents hold so spreads over ``SLICES`` runs.  These few rows per hash
   are then reduced to its smallest document; hashes that one document alone
   holds fall out.
3. ``keep_bitmaps`` - rows of a shared hash outside its first holder are
   marked; a document's dropped places become 64-bit words of its bitmap, and
   only words with a dropped line are stored (the others are all ones).  AQE
   splits the join of a hot hash.
4. ``drop_lines`` - documents meet their bitmap by id and keep the lines left.

Defined results: null and empty text are one empty line; keys under
``MIN_CHARS`` code points are never dropped; the smallest id that holds a key
keeps all its lines; a null ``doc_id`` sorts first and is one document; rows
that repeat a ``doc_id`` are one document, each row losing the lines whose
keys an earlier document holds; extra columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siniestro.llm.columns import doc_key, lower_ascii, set_aside, text_or_empty, text_version
from siniestro.session import materialize

MIN_CHARS = 10
SLICES = 64
BLANKS = " \t\n\x0b\x0c\r"


def lines_of(name: str = "text") -> Column:
    return F.split(text_or_empty(name), "\n", -1)


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(h, id, version, pos): every line whose key is long enough to count."""
    lines = docs.select(doc_key().alias("id"), text_version().alias("version"),
                        F.posexplode(lines_of()).alias("pos", "line"))
    key = F.btrim("line", F.lit(BLANKS))
    return (lines.select("id", "version", "pos", key.alias("line")).filter(F.length("line") >= min_chars)
            .select(F.unhex(F.md5(lower_ascii(F.col("line")))).alias("h"), "id", "version", "pos"))


def first_holders(keys: DataFrame, slices: int = SLICES) -> DataFrame:
    """(h, holder): the smallest document of every hash that at least two documents hold."""
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    run = Window.partitionBy("h", "slice").orderBy("id")
    return (keys.withColumn("slice", F.pmod(F.xxhash64("id"), F.lit(slices)).cast("int"))
            .repartitionByRange(parts, "h", "slice").sortWithinPartitions("h", "slice", "id", "pos")
            .withColumn("nth", F.dense_rank().over(run)).filter("nth <= 2")
            .groupBy("h").agg(F.min("id").alias("holder"), F.max("id").alias("other"))
            .filter("holder < other").select("h", "holder"))


def keep_bitmaps(keys: DataFrame, holders: DataFrame) -> DataFrame:
    """(id, version, masks, dense, n_dropped): 64-bit words of the places to drop.

    ``masks`` has only words with a dropped line; ``dense`` has all words up
    to the last of these, for look-up by place.
    """
    dropped = keys.join(holders, "h").filter("id <> holder")
    words = (dropped.groupBy("id", "version", F.expr("cast(pos div 64 as int)").alias("word"))
             .agg(F.expr("bit_or(shiftleft(1L, pos % 64))").alias("mask")))
    packed = words.groupBy("id", "version").agg(
        F.sort_array(F.collect_list(F.struct("word", "mask"))).alias("masks"),
        F.sum(F.expr("bit_count(mask)")).cast("long").alias("n_dropped"))
    return packed.withColumn("dense", F.expr("""aggregate(masks, cast(array() as array<bigint>),
        (a, m) -> concat(a, array_repeat(0L, m.word - size(a)), array(m.mask)))"""))


def drop_lines(docs: DataFrame, min_chars: int = MIN_CHARS, slices: int = SLICES) -> DataFrame:
    """``docs`` with ``text`` without the dropped lines, ``n_lines`` before and ``n_dropped``.

    A document that loses nothing keeps its text (null too).
    """
    keys = materialize(line_keys(docs, min_chars), "line-keys")
    # written, so that both sides of the next join are plain shuffles, which AQE can split at a hot hash
    holders = materialize(first_holders(keys, slices), "line-holders")
    masks = keep_bitmaps(keys, holders).select(
        F.col("id").alias("_id"), F.col("version").alias("_version"), F.col("dense").alias("_dense"),
        F.col("n_dropped").alias("_dropped"))
    away, back = set_aside(docs, "n_lines", "n_dropped")
    joined = docs.select(*away, F.col("text").alias("_text"), doc_key().alias("_id"), text_version().alias("_version")) \
        .join(masks, ["_id", "_version"], "left")
    text = text_or_empty("_text")
    n_lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    left = F.filter(lines_of("_text"), lambda line, i: (
        F.getbit(F.coalesce(F.get(F.col("_dense"), F.floor(i / 64).cast("int")), F.lit(0).cast("long")),
                 F.pmod(i, F.lit(64))) == 0))
    kept = F.when(F.col("_dense").isNull(), F.col("_text")).otherwise(F.array_join(left, "\n")).alias("text")
    out = [kept if c == "text" else column
           for c, column in zip((c for c in docs.columns if c not in ("n_lines", "n_dropped")), back, strict=True)]
    return joined.select(*out, n_lines.cast("long").alias("n_lines"),
                         F.coalesce("_dropped", F.lit(0).cast("long")).alias("n_dropped"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of :func:`drop_lines` over all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return drop_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


SQL = r"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as pos from documents),
keyed as (
  select doc_id, pos, line,
    translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k from lines),
shared as (
  select k, min(doc_id) as holder from keyed where length(k) >= 10 group by k having count(distinct doc_id) > 1),
marked as (
  select doc_id, pos, line, coalesce(doc_id <> holder, false) as gone from keyed left join shared using (k))
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from marked group by doc_id
"""

QUERIES = {"op2_line_dedup": op2_line_dedup}
ORACLE = {"op2_line_dedup": SQL}
