"""Operator 12: mix sources to target weights by Pareto order sampling.

DataFrame functions only.  A document's size is its number of words.

1. ``source_targets`` - sources in code point order (null last) get their
   weights; together they share ``share`` times all words; a target stops at
   ``cap`` times its source's words and the excess goes to the others by
   weight.  Closed form: sources by cap / weight; those whose cap is below the
   common level stop there, all others get weight times the level.
2. Certain whole copies: every document of a source gets
   floor(target / source words) copies.  What is then missing, R words, is
   drawn as one more copy of some documents.
3. Inclusion probabilities of that draw: l = min(1, a * w), with
   w = floor(256 * sqrt(size)) and ``a`` such that the expected words are R.
   Documents that come to 1 are certain.  (Equal chances would leave it to a
   few long documents how many words a source gets; chances proportional to
   size would drop most short documents of a source that shrinks.)
4. Pareto order: documents rank by the odds of a uniform number over the odds
   of inclusion, u / (1 - u) over l / (1 - l).  The sample has a fixed size in
   words: the documents in rank order up to the point nearest R.  So a
   source's words miss its target by half of one document at most.

No source is sorted as a whole.  Ranks are cut into buckets, words are summed
per bucket before they are shuffled, and only the bucket in which R falls is
sorted (at most about ``BUCKET_ROWS`` rows, since the order is random).  One
row per source says where to cut; it is written first, so that Spark knows its
size, and it meets the documents where these are: no text is shuffled.  What
passes one task: one small row per source, and one per bucket or distinct size
of a source.

The uniform number is made of the document's id and text (md5), so reruns
agree.

Defined results: a null or empty text has size 0 and is taken 0 times its
words; null is a source of its own (the last); the empty source name is
another; a null id takes part; rows that repeat id and text in one source
share one draw and are taken alike; equal ranks go by id, then by the text's
md5; an empty table gives no rows; a source without words has target 0; extra
columns stay.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siniestro.llm.columns import doc_key, set_aside, text_or_empty
from siniestro.session import materialize

WEIGHTS = (3, 1, 2)
SHARE = Fraction(3, 2)
CAP = 2
SEED = 12
WORD = r"[^\x20\x09-\x0D]+"
BUCKETS = 1024
BUCKET_ROWS = 20_000
OUT = ("size", "source_size", "target", "copies", "taken")

_EXACT = "decimal(38,0)"
_PLAN = ("source_size", "target", "base", "missing", "cut", "scale", "edge", "last")


def _drawn(seed: int) -> Column:
    """Uniform in (0, 1), from 52 bits of the md5 of seed, id and text hash."""
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("_id").cast("string"), F.lit("")), F.col("_hash")))
    return (F.conv(F.substring(key, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def _measured(docs: DataFrame, seed: int, *more: Column) -> DataFrame:
    """(…, _id, _source, _hash, size, u) of every document."""
    text = text_or_empty()
    return (docs.select(*more, F.col("doc_id").alias("_id"), F.col("source").cast("string").alias("_source"),
                        F.md5(text).alias("_hash"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"))
            .withColumn("u", _drawn(seed)))


def _weight() -> Column:
    return F.floor(256 * F.sqrt(F.col("size").cast("double")))


def _rank() -> Column:
    """Odds of u over odds of inclusion; 0 for certain documents, null without words."""
    chance = F.col("scale") * _weight()
    certain = F.col("cut").isNull() | (F.col("size") > F.col("cut")) | (chance >= 1)
    odds = F.col("u") / (1 - F.col("u"))
    return F.when(F.col("size") == 0, None).when(certain, F.lit(0.0)).when(chance > 0, odds / (chance / (1 - chance)))


def _bucket(buckets: int) -> Column:
    """Buckets of rank / (1 + rank), which spreads over 0 to 1; the cut is near the middle."""
    return F.floor(F.col("rank") / (1 + F.col("rank")) * buckets).cast("int")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: Fraction = SHARE, cap: int = CAP) -> DataFrame:
    """(_source, source_size, target) from (_source, source_size): one row per source.

    Integer products up to the one division, so that the result does not
    depend on the order of sums.
    """
    up, down = Fraction(share).numerator, Fraction(share).denominator
    every = F.lit(1).alias("every")
    by_name = Window.partitionBy("every").orderBy(F.col("_source").asc_nulls_last())
    whole = Window.partitionBy("every")
    cases = F.element_at(F.array(*(F.lit(int(w)) for w in weights)), F.pmod(F.col("no") - 1, F.lit(len(weights))) + 1)
    named = (sizes.select("*", every).withColumn("no", F.row_number().over(by_name)).withColumn("w", cases)
             .withColumn("most", (F.col("source_size") * cap).cast(_EXACT))
             .withColumn("all", F.sum("source_size").over(whole).cast(_EXACT)))
    by_level = Window.partitionBy("every").orderBy(F.col("most").cast("double") / F.col("w"), "no")
    first = (named.withColumn("before", F.coalesce(
                 F.sum("most").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast(_EXACT))
             .withColumn("open", F.sum("w").over(by_level.rowsBetween(0, Window.unboundedFollowing)))
             .withColumn("left", (F.col("all") * up - F.col("before") * down).cast(_EXACT))
             .withColumn("stops", F.col("most") * down * F.col("open") <= F.col("left") * F.col("w")))
    # the first source that does not stop knows what is left for itself and those after it
    level = F.struct("left", "open")
    ranked = first.withColumn("level", F.min(F.when(~F.col("stops"), F.struct(
        (F.col("most").cast("double") / F.col("w")).alias("r"), "no", level.alias("at")))).over(whole))
    target = F.when(F.col("stops"), F.col("most").cast("double")).otherwise(
        (F.col("level.at.left") * F.col("w")).cast("double") / (F.col("level.at.open") * down).cast("double"))
    return ranked.select("_source", "source_size", target.alias("target"))


def _chances(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Targets with the draw's size and scale: sizes above ``cut`` are certain."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("base", whole) \
        .withColumn("missing", F.col("target") - F.col("base") * F.col("source_size"))
    some = rows.filter("size > 0").groupBy("_source", "size").agg(F.count(F.lit(1)).alias("n"))
    some = some.join(targets.select(F.col("_source").alias("_of"), "missing"), F.col("_source").eqNullSafe(F.col("_of")))
    large_first = Window.partitionBy("_source").orderBy(F.desc("size"))
    words = (F.col("n") * F.col("size")).cast(_EXACT)
    steps = (some.withColumn("w", _weight())
             .withColumn("larger", F.coalesce(
                 F.sum(words).over(large_first.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("double"))
             .withColumn("rest", F.sum((words * F.col("w")).cast(_EXACT))
                         .over(large_first.rowsBetween(0, Window.unboundedFollowing)).cast("double"))
             .withColumn("open", F.col("w") * (F.col("missing") - F.col("larger")) < F.col("rest")))
    cut = (steps.filter("open").groupBy("_source").agg(
        F.max("size").alias("cut"),
        F.max_by((F.col("missing") - F.col("larger")) / F.col("rest"), "size").alias("scale"))
        .withColumnRenamed("_source", "_of"))
    return targets.join(cut, F.col("_source").eqNullSafe(F.col("_of")), "left").drop("_of")


def _ranked(rows: DataFrame, plan: DataFrame, buckets: int) -> DataFrame:
    plan = plan.withColumnRenamed("_source", "_of")
    return (rows.join(plan, F.col("_source").eqNullSafe(F.col("_of"))).drop("_of")
            .withColumn("rank", _rank()).withColumn("bucket", _bucket(buckets)))


def mixing_plan(docs: DataFrame, weights=WEIGHTS, share: Fraction = SHARE, cap: int = CAP,
                seed: int = SEED) -> tuple[DataFrame, int]:
    """(one row per source, number of buckets): target, certain copies, and where the order of ranks is cut."""
    rows = materialize(_measured(docs, seed), "mix-rows")
    n = rows.count()
    buckets = max(BUCKETS, -(-n // BUCKET_ROWS))
    sizes = rows.groupBy("_source").agg(F.sum("size").alias("source_size"))
    chances = materialize(_chances(rows, source_targets(sizes, weights, share, cap)), "mix-chances")
    ranked = _ranked(rows, chances, buckets).filter("bucket is not null")
    sums = ranked.groupBy("_source", "bucket", "missing").agg(F.sum("size").alias("words"))
    order = Window.partitionBy("_source").orderBy("bucket")
    edges = (sums.withColumn("upto", F.sum("words").over(order))
             .filter(F.col("upto") > F.col("missing"))
             .groupBy("_source").agg(F.min(F.struct("bucket", (F.col("upto") - F.col("words")).alias("before"))).alias("e"))
             .select(F.col("_source").alias("_at"), F.col("e.bucket").alias("edge"), F.col("e.before").alias("before")))
    edges = materialize(edges, "mix-edges")
    tied = (ranked.join(edges, F.col("_source").eqNullSafe(F.col("_at")) & (F.col("bucket") == F.col("edge")))
            .groupBy("_source", "missing", "before", F.struct("rank", doc_key("_id").alias("id"), "_hash").alias("at"))
            .agg(F.sum("size").alias("words")))
    in_order = Window.partitionBy("_source").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = (tied.withColumn("upto", F.sum("words").over(in_order) + F.col("before"))
            .filter(F.col("upto") - F.col("words") / 2 <= F.col("missing"))
            .groupBy("_source").agg(F.max("at").alias("last")).withColumnRenamed("_source", "_at"))
    plan = (chances.join(edges.drop("before"), F.col("_source").eqNullSafe(F.col("_at")), "left").drop("_at")
            .join(last, F.col("_source").eqNullSafe(F.col("_at")), "left").drop("_at"))
    return materialize(plan.select("_source", *_PLAN), "mix-plan"), buckets


def mix(docs: DataFrame, weights=WEIGHTS, share: Fraction = SHARE, cap: int = CAP, seed: int = SEED) -> DataFrame:
    """``docs`` (``doc_id``, ``text``, ``source`` and others) with size, source_size, target, copies and taken.

    Like-named columns are replaced.  ``copies`` times the text goes into the
    mix; ``taken`` is that in words.
    """
    plan, buckets = mixing_plan(docs.select("doc_id", "text", "source"), weights, share, cap, seed)
    away, back = set_aside(docs, *OUT)
    here = F.struct(F.col("rank"), doc_key("_id").alias("id"), F.col("_hash"))
    # without an edge a source's ranks hold no more than what is missing: all are taken
    more = F.col("rank").isNotNull() & (F.col("edge").isNull() | (F.col("bucket") < F.col("edge")) | (
        (F.col("bucket") == F.col("edge")) & F.coalesce(here <= F.col("last"), F.lit(False))))
    copies = F.col("base").cast("long") + F.when(more, 1).otherwise(0).cast("long")
    return (_ranked(_measured(docs, seed, *away), plan, buckets).withColumn("copies", copies)
            .select(*back, "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")))


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document of :func:`mix` as often as it is taken."""
    mixed = mix(docs, **options)
    return mixed.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))


def op12_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


SQL = r"""
with d as (
  select doc_id, source, md5(coalesce(text, '')) as h,
         cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size from documents),
s as (select source, cast(sum(size) as bigint) as source_size from d group by source),
named as (
  select *, row_number() over (order by source nulls last) as no, 2 * source_size as most,
         (sum(source_size) over ()) as total from s),
weighed as (select *, ([3, 1, 2])[cast((no - 1) % 3 + 1 as integer)] as w from named),
level as (
  select *, 3 * total - 2 * coalesce(sum(most) over (order by cast(most as double) / w, no
                                     rows between unbounded preceding and 1 preceding), 0) as left_,
         sum(w) over (order by cast(most as double) / w, no rows between current row and unbounded following) as open_
  from weighed),
stops as (select *, most * 2 * open_ <= left_ * w as stop from level),
at_ as (select left_ as l, open_ as o from stops where not stop order by cast(most as double) / w, no limit 1),
targets as (
  select source, source_size,
         case when stop then cast(most as double) else cast(l * w as double) / cast(2 * o as double) end as target
  from stops left join at_ on true),
need as (
  select *, case when source_size = 0 then 0 else floor(target / source_size) end as base,
         target - case when source_size = 0 then 0 else floor(target / source_size) end * source_size as missing
  from targets),
hist as (
  select d.source, d.size, count(*) * d.size as words, floor(256 * sqrt(d.size)) as w, any_value(missing) as missing
  from d join need n on d.source is not distinct from n.source where d.size > 0 group by d.source, d.size),
steps as (
  select *, cast(coalesce(sum(words) over (partition by source order by size desc
                          rows between unbounded preceding and 1 preceding), 0) as double) as larger,
         cast(sum(cast(words * w as hugeint)) over (partition by source order by size desc
              rows between current row and unbounded following) as double) as rest from hist),
cut as (select source, max(size) as cut, arg_max((missing - larger) / rest, size) as scale
        from steps where w * (missing - larger) < rest group by source),
drawn as (
  select d.*, n.source_size, n.target, n.base, n.missing, c.cut, c.scale * floor(256 * sqrt(d.size)) as chance,
         (cast(('0x' || substr(md5(concat_ws(':', '12', coalesce(cast(doc_id as varchar), ''), h)), 1, 13)) as bigint)
          + 0.5::double) / 4503599627370496::double as u
  from d join need n on d.source is not distinct from n.source left join cut c on d.source is not distinct from c.source),
ranked as (
  select *, case when size = 0 then null when cut is null or size > cut or chance >= 1 then 0::double
                 when chance > 0 then (u / (1 - u)) / (chance / (1 - chance)) end as rank from drawn),
alike as (
  select source, rank, doc_id, h, sum(size) as words, any_value(missing) as missing
  from ranked where rank is not null group by source, rank, doc_id, h),
chosen as (
  select *, sum(words) over (partition by source order by rank, doc_id nulls first, h
                             rows between unbounded preceding and current row) - words / 2.0 <= missing as more
  from alike)
select r.doc_id, r.size, r.source_size, r.target,
       cast(r.size * (r.base + case when coalesce(c.more, false) then 1 else 0 end) as bigint) as taken
from ranked r left join chosen c on r.source is not distinct from c.source and r.rank = c.rank
  and r.doc_id is not distinct from c.doc_id and r.h = c.h
"""

QUERIES = {"op12_pareto_mix": op12_pareto_mix}
ORACLE = {"op12_pareto_mix": SQL}
