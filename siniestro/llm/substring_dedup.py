"""Operator 3: remove word windows that also stand earlier in the corpus.

Every window of ``WINDOW`` consecutive words has a Rabin-Karp hash.  Shuffling
one row per window would move many times the text, so a window is found
through its anchor: the smallest hash among its ``GRAM``-word grams (leftmost
on ties).  Equal windows have equal anchors, and neighbouring windows mostly
share one, so there is about one anchor per seven words.

1. ``anchors`` - each task hashes whole texts and writes one row per anchor:
   gram hash, hash of the words around it that its windows can reach
   (``ctx``), document, place and the range of windows.  Within a task only
   the earliest row of each (gram, ctx) is sent on; the windows of the others
   are known to be repeated.  A passage that a third of all documents hold so
   reaches the shuffle once per task, not once per document.
2. One shuffle by gram.  All rows but the earliest of a (gram, ctx) are
   repeated windows.  A gram seen with several surroundings is an edge of a
   repeated passage: its windows are looked at one by one.
3. ``edges`` - for those anchors only, every window's 128-bit hash, counted
   in Spark: all but the earliest start of a hash are repeated.
4. Removal ranges are merged per document into maximal intervals, and the
   words outside them stay.

Defined results: null or empty text has no words; fewer words than a window:
nothing is removed; a null ``doc_id`` is one document that sorts first; rows
that repeat a ``doc_id`` are versions of one document and get the decisions
of that id (no start is earlier than itself, so exact repeats of a row don't
remove each other); extra columns of the input are ignored by
:func:`removal_ranges` and kept by :func:`remove_repeats`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siniestro.llm.columns import doc_key, set_aside
from siniestro.llm.words import Rolling, chunks, find_words, hash_words, i64, inside, separators
from siniestro.session import materialize

WINDOW = 20
GRAM = 8

_SPACE = separators("space")
_ANCHORS = "gram long, ctx long, id long, at long, lo int, hi int, repeated boolean"
_EDGES = "h1 long, h2 long, id long, at long, repeated boolean"


def leftmost_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """For each start i: the place of the leftmost smallest of values[i:i+width]."""
    at = np.arange(len(values))
    span = 1
    while span < width:
        step = min(span, width - span)
        left, right = at[:-step], at[step:]
        at = np.where(values[left] <= values[right], left, right)
        span += step
    return at


def _anchor_runs(grams: np.ndarray, starts: np.ndarray, window: int, gram: int):
    """Anchors of the windows at ``starts``: place, first and last window start."""
    place = leftmost_minimum(grams, window - gram + 1)[starts]
    new = np.ones(len(place), bool)
    new[1:] = place[1:] != place[:-1]
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [len(place)])) - 1
    return place[first], starts[first], starts[last]


def _earliest(keys: list[np.ndarray], doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    """True where an equal key stands strictly earlier by (doc, at)."""
    order = np.lexsort((at, doc, *keys))
    head = np.zeros(len(order), bool)
    head[:1] = True
    for k in keys:
        head[1:] |= k[order][1:] != k[order][:-1]
    first = order[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
    later = np.empty(len(order), bool)
    later[order] = (doc[order] != doc[first]) | (at[order] != at[first])
    return later


class _Hashed:
    """Words, grams and windows of one chunk of documents."""

    def __init__(self, chunk, window: int, gram: int) -> None:
        self.words = find_words(chunk, _SPACE)
        self.hashes = hash_words(chunk.buf, self.words)
        self.rolling = Rolling(self.hashes)
        self.starts = inside(self.words, window)
        if len(self.starts):
            self.place, self.lo, self.hi = _anchor_runs(self.rolling.grams(gram), self.starts, window, gram)
            self.doc = np.searchsorted(self.words.off, self.place, side="right") - 1


def anchors(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Step 1: one row per anchor (``repeated``: an equal one stands earlier in the same task)."""
    reach = window - gram

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            held: list[tuple[np.ndarray, ...]] = []
            for chunk in chunks(batch.column(1)):
                x = _Hashed(chunk, window, gram)
                if not len(x.starts):
                    continue
                begin, stop = x.words.off[x.doc], x.words.off[x.doc + 1]
                lo, hi = np.maximum(x.place - reach, begin), np.minimum(x.place + window, stop)
                cut = ((x.place - lo) * (2 * window) + (hi - x.place)).astype(np.uint64)
                ctx = i64(x.rolling.run(lo, hi) + cut * np.uint64(0x9E3779B97F4A7C15))
                key = i64(x.rolling.run(x.place, x.place + gram))
                held.append((key, ctx, ids[chunk.first + x.doc], x.place - begin, x.lo - begin, x.hi - begin))
            if held:
                key, ctx, doc, at, lo, hi = (np.concatenate(c) for c in zip(*held, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(ctx), pa.array(doc), pa.array(at), pa.array(lo.astype(np.int32)),
                     pa.array(hi.astype(np.int32)), pa.array(_earliest([key, ctx], doc, at))],
                    names=["gram", "ctx", "id", "at", "lo", "hi", "repeated"])

    return docs.select(doc_key().alias("id"), F.col("text").cast("string").alias("text")).mapInArrow(work, _ANCHORS)


def edges(docs: DataFrame, wanted: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Step 3: the windows of the ``wanted`` (id, ats) anchors of each document."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            lists = batch.column(2)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            bound = np.concatenate(([0], np.cumsum(np.diff(lists.offsets.to_numpy()))))
            held: list[tuple[np.ndarray, ...]] = []
            for chunk in chunks(batch.column(1)):
                x = _Hashed(chunk, window, gram)
                if not len(x.starts):
                    continue
                span = flat[bound[chunk.first]:bound[chunk.first + chunk.size]]
                of = np.repeat(np.arange(chunk.size), np.diff(bound[chunk.first:chunk.first + chunk.size + 1]))
                hit = np.isin(x.place, span + x.words.off[of])
                lo, n = x.lo[hit], (x.hi - x.lo + 1)[hit]
                at = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(int(n.sum()))
                doc = np.repeat(x.doc[hit], n)
                half = at + window // 2
                held.append((i64(x.rolling.run(at, half)), i64(x.rolling.run(half, at + window)),
                             ids[chunk.first + doc], at - x.words.off[doc]))
            if held:
                h1, h2, doc, at = (np.concatenate(c) for c in zip(*held, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h1), pa.array(h2), pa.array(doc), pa.array(at),
                     pa.array(_earliest([h1, h2], doc, at))], names=["h1", "h2", "id", "at", "repeated"])

    joined = docs.select(doc_key().alias("id"), F.col("text").cast("string").alias("text")).join(wanted, "id")
    return joined.select("id", "text", "ats").mapInArrow(work, _EDGES)


def _later(keys: list[str]) -> Column:
    """True where a row of equal keys stands strictly earlier by (id, at)."""
    w = Window.partitionBy(*keys).orderBy("id", "at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (F.first("id").over(w) != F.col("id")) | (F.first("at").over(w) != F.col("at"))


def removal_ranges(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(id, ranges): ranges [lo, hi) of word places to remove, not yet merged."""
    found = materialize(anchors(docs, window, gram), "repeat-anchors")
    group = Window.partitionBy("gram")
    shared = (found.filter("not repeated")
              .withColumn("n", F.count(F.lit(1)).over(group))
              .withColumn("low", F.min("ctx").over(group)).withColumn("high", F.max("ctx").over(group))
              .filter("n > 1")
              .select("gram", "ctx", "id", "at", "lo", "hi", _later(["gram", "ctx"]).alias("repeated"),
                      (F.col("low") != F.col("high")).alias("edge")))
    shared = materialize(shared, "repeat-shared")
    wanted = (shared.filter("edge and not repeated").groupBy("id")
              .agg(F.collect_set("at").alias("ats")))
    single = materialize(edges(docs, wanted, window, gram), "repeat-edges")
    single_later = single.filter("not repeated").select("id", "at", _later(["h1", "h2"]).alias("repeated"))
    spans = (found.filter("repeated").select("id", "lo", (F.col("hi") + window).alias("hi"))
             .unionByName(shared.filter("repeated").select("id", "lo", (F.col("hi") + window).alias("hi")))
             .unionByName(single.filter("repeated").unionByName(
                 single_later.filter("repeated"), allowMissingColumns=True)
                 .select("id", F.col("at").cast("int").alias("lo"), (F.col("at") + window).cast("int").alias("hi"))))
    return spans.groupBy("id").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))


def merge(lo: np.ndarray, hi: np.ndarray, n: int) -> np.ndarray:
    """True for the words 0..n-1 that some range covers (the ranges' union)."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, np.minimum(lo, n), 1)
    np.add.at(depth, np.minimum(hi, n), -1)
    return np.cumsum(depth)[:n] > 0


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Documents with ``kept_text``, ``n_words``, ``n_removed`` and the merged ``removed`` intervals.

    All columns of ``docs`` stay; one of these four names among them is replaced.
    """
    made = ("kept_text", "n_words", "n_removed", "removed")
    away, back = set_aside(docs, *made)
    ranges = removal_ranges(docs, window, gram).withColumnRenamed("id", "_id")
    kept_rows = docs.select(*away, doc_key().alias("_id"), F.col("text").cast("string").alias("_text"))
    joined = kept_rows.join(ranges, "_id", "left").select(*kept_rows.columns, "ranges").drop("_id")
    schema = docs.select(*away).schema.add("kept_text", "string").add("n_words", "long") \
        .add("n_removed", "long").add("removed", T.ArrayType(T.StructType().add("lo", "integer").add("hi", "integer")))
    interval = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lists = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
            out: list[tuple] = []
            for text, ranges in zip(texts, lists, strict=True):
                words = (text.as_py() or "").encode().split()
                if not ranges.is_valid or not words:
                    out.append((b" ".join(words).decode(), len(words), 0, []))
                    continue
                pair = ranges.values
                gone = merge(pair.field(0).to_numpy(), pair.field(1).to_numpy(), len(words))
                turn = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
                kept = b" ".join([words[i] for i in np.flatnonzero(~gone)])
                out.append((kept.decode(), len(words), int(gone.sum()),
                            [{"lo": int(a), "hi": int(b)} for a, b in zip(turn[::2], turn[1::2], strict=True)]))
            kept, n, gone, cut = zip(*out, strict=True) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], pa.array(kept, pa.string()), pa.array(n, pa.int64()),
                 pa.array(gone, pa.int64()), pa.array(cut, interval)],
                names=[*batch.schema.names[:-2], *made])

    return joined.mapInArrow(work, schema).select(*back, *made)


def op3_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Digest of :func:`remove_repeats` over all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


SQL = """
with words as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
starts as (
  select doc_id, w, unnest(range(1, len(w) - 18)) as s from words where len(w) >= 20),
wins as (select doc_id, s, sha256(array_to_string(list_slice(w, s, s + 19), ' ')) as h from starts),
later as (
  select doc_id, s from (
    select doc_id, s, row_number() over (partition by h order by doc_id, s) as rn from wins) where rn > 1),
gone as (select distinct doc_id, unnest(range(s, s + 20)) as i from later),
kept as (
  select d.doc_id, len(d.w) as n_words, coalesce(len(g.gone), 0) as n_removed,
         array_to_string(case when g.gone is null then d.w
           else list_transform(list_filter(range(1, len(d.w) + 1), lambda i: not list_contains(g.gone, i)),
                               lambda i: d.w[i]) end, ' ') as kept
  from words d left join (select doc_id, list(i) as gone from gone group by doc_id) g using (doc_id))
select doc_id, n_words, n_removed, sha256(kept) as kept_sha256 from kept
"""

QUERIES = {"op3_substring_dedup": op3_substring_dedup}
ORACLE = {"op3_substring_dedup": SQL}
