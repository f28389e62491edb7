"""Operator 9: find benchmark items inside documents by size-partitioned MinHash containment.

A short item in a long document has a tiny Jaccard similarity, so both sides
are partitioned by size.  Items fall into classes by their number of distinct
five-word shingles (up to 8, 16, 32, ...); for each class documents are cut
into chunks as long as the class bound, which keeps an item and the chunks it
may stand in about equally large at any document length.

1. ``item_blocks`` - the items with their shingles, in blocks of a stated
   size; a block is what one pass over the documents searches for, so what is
   sent to the executors is bounded whatever the number of items.
2. ``candidates`` - each task hashes the shingles of whole documents and
   takes, per chunk, the smallest hash of every bin (one-permutation MinHash,
   two bins per shingle of the class bound, at least 64).  An item is a
   candidate of a document if one of its bin minima is a bin minimum of a
   chunk.  Each shared shingle is a chance of its own, so an item needs some
   of them: from nine shingles on, at least eight are shared at 0.8.
   Items of the smallest class (up to eight shingles, twelve words) have too
   few chances and are looked up exactly: an item that may lack m of its
   shingles is found by any m + 1 of them, and every shingle of the document,
   not only the bin minima, is looked up.
3. ``contained`` - candidates are verified in the same task on the words
   themselves: the share of the item's distinct shingles that the document has.

Words are runs of ASCII letters and digits and of other characters beyond
ASCII, A-Z lower-cased, so case and punctuation don't hide a passage.

Defined results: null or empty texts on either side have no words; an item of
fewer than five words has no shingle and matches nothing; repeated rows of
either table give one row per pair of ids; null ids are returned as null and
count as one id; extra columns are ignored here and kept by :func:`remove`.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siniestro.llm.columns import doc_key, set_aside
from siniestro.llm.words import (
    LOWER, Chunk, Rolling, Words, chunks, find_words, fold_ascii, hash_words, inside, separators)

SHINGLE = 5
CONTAINMENT = 0.8
BLOCK_WORDS = 2_000_000
"""Words of the items that one pass searches for; a larger benchmark takes more passes."""
SMALLEST = 8

_SEP = separators("alnum")
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: str | bytes | None) -> list[bytes]:
    raw = text.encode() if isinstance(text, str) else text or b""
    return _WORD.findall(raw.translate(LOWER))


def shingles_of(words: list[bytes], k: int = SHINGLE) -> set[bytes]:
    return {b" ".join(words[i:i + k]) for i in range(len(words) - k + 1)}


def size_class(n: int) -> int:
    """The bound of the class of an item with n shingles."""
    return max(SMALLEST, 1 << (n - 1).bit_length())


def may_lack(n: int, containment: float) -> int:
    """How many of its n shingles a contained item may lack."""
    return n - min(k for k in range(n + 1) if k == n or k >= containment * n)


def _bins(bound: int) -> int:
    """log2 of the number of bins of a class."""
    return max(6, (2 * bound).bit_length() - 1)


def bin_minima(hashes: np.ndarray, group: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The smallest hash of every (group, bin), its group, and how many low bits of the hashes are cut off.

    The bin is the hash's top bits.  Group and hash share one 64-bit number
    to sort by, so a hash loses as many low bits as the group needs.
    """
    cut = int(group[-1]).bit_length() if len(group) else 0
    key = np.sort((group.astype(np.uint64) << np.uint64(64 - cut) if cut else np.uint64(0)) | (hashes >> np.uint64(cut)))
    cell = key >> np.uint64(64 - cut - bits)
    head = np.ones(len(key), bool)
    head[1:] = cell[1:] != cell[:-1]
    key = key[head]
    if not cut:
        return key, np.zeros(len(key), np.int64), 0
    return key & np.uint64((1 << (64 - cut)) - 1), (key >> np.uint64(64 - cut)).astype(np.int64), cut


class _Block:
    """What one pass searches for: hashes and the items they stand for, sorted by hash.

    ``exact``: of the smallest class, as many of each item's shingles as a
    document can't all lack; ``classes``: the bin minima of the others.
    """

    def __init__(self, items: list[tuple[int | None, str | None]], shingle: int,
                 containment: float = CONTAINMENT) -> None:
        self.shingle = shingle
        self.items = [(key, s) for key, text in items if (s := shingles_of(words_of(text), shingle))]
        found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = defaultdict(list)
        for at, (_, grams) in enumerate(self.items):
            hashes = np.unique(_gram_hashes(sorted(grams), shingle))
            bound = size_class(len(grams))
            if bound == SMALLEST:
                low = hashes[:may_lack(len(grams), containment) + 1]
            else:
                low, _, _ = bin_minima(hashes, np.zeros(len(hashes), np.int64), _bins(bound))
            found[bound].append((low, np.full(len(low), at)))
        self.classes = {}
        for bound, parts in sorted(found.items()):
            low, at = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(low, kind="stable")
            self.classes[bound] = (low[order], at[order])
        self.exact = self.classes.pop(SMALLEST, None)


def _gram_hashes(grams: list[bytes], shingle: int) -> np.ndarray:
    """Hashes of shingles given as text, equal to those of the rolling pass."""
    buf = np.frombuffer(b"\n".join(grams), np.uint8)
    size = np.array([len(g) for g in grams])
    off = np.concatenate(([0], np.cumsum(size + 1)))
    off[-1] -= 1
    words = find_words(Chunk(0, buf, off), _SEP)
    return Rolling(hash_words(buf, words)).grams(shingle)[words.off[:-1]]


def _search(chunk: Chunk, block: _Block) -> set[tuple[int, int]]:
    """(document of the chunk, item) candidates."""
    buf = fold_ascii(chunk.buf)
    words: Words = find_words(chunk, _SEP)
    starts = inside(words, block.shingle)
    if not len(starts):
        return set()
    hashes = Rolling(hash_words(buf, words)).grams(block.shingle)[starts]
    doc = np.searchsorted(words.off, starts, side="right") - 1
    place = starts - words.off[doc]
    out: set[tuple[int, int]] = set()
    if block.exact:
        known, item = block.exact
        left = np.searchsorted(known, hashes)
        hit = np.flatnonzero(known[np.minimum(left, len(known) - 1)] == hashes)
        left = left[hit]
        right = np.searchsorted(known, hashes[hit], "right")
        for i, at in enumerate(hit):
            for j in item[left[i]:right[i]]:
                out.add((int(doc[at]), int(j)))
    for bound, (low, item) in block.classes.items():
        piece = place // bound
        new = np.ones(len(starts), bool)
        new[1:] = (piece[1:] != piece[:-1]) | (doc[1:] != doc[:-1])
        group = np.cumsum(new) - 1
        minima, of, cut = bin_minima(hashes, group, _bins(bound))
        low = low >> np.uint64(cut)
        left, right = np.searchsorted(low, minima, "left"), np.searchsorted(low, minima, "right")
        hit = np.flatnonzero(right > left)
        first = doc[np.flatnonzero(new)]
        for i in hit:
            for j in item[left[i]:right[i]]:
                out.add((int(first[of[i]]), int(j)))
    return out


def _pass(docs: DataFrame, block: _Block, containment: float) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(block)
    schema = "doc_id long, item_id long, n_shared int, n_shingles int"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = shared.value
        for batch in batches:
            ids, out = batch.column(0), []
            for chunk in chunks(batch.column(1)):
                by_doc: dict[int, list[int]] = defaultdict(list)
                for doc, item in _search(chunk, look):
                    by_doc[doc].append(item)
                for doc, items in by_doc.items():
                    have = shingles_of(words_of(chunk.buf[chunk.off[doc]:chunk.off[doc + 1]].tobytes()), look.shingle)
                    for item in items:
                        key, grams = look.items[item]
                        n = len(grams & have)
                        if n >= containment * len(grams):
                            out.append((ids[chunk.first + doc].as_py(), key, n, len(grams)))
            if out:
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()),
                     pa.array(cols[3], pa.int32())], names=["doc_id", "item_id", "n_shared", "n_shingles"])

    return docs.mapInArrow(work, schema)


def item_blocks(items: DataFrame, shingle: int = SHINGLE, block_words: int = BLOCK_WORDS,
                containment: float = CONTAINMENT) -> Iterator[_Block]:
    """The items in blocks of about ``block_words`` words, one partition at a time on the driver."""
    held: list[tuple[int | None, str | None]] = []
    size = 0
    for row in items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).toLocalIterator():
        n = len(row[1] or "") // 6 + 1
        if held and size + n > block_words:
            yield _Block(held, shingle, containment)
            held, size = [], 0
        held.append((row[0], row[1]))
        size += n
    yield _Block(held, shingle, containment)


def contained(docs: DataFrame, items: DataFrame, containment: float = CONTAINMENT, shingle: int = SHINGLE,
              block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, item_id, n_shared, n_shingles): every item contained in a document."""
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    found = None
    for block in item_blocks(items, shingle, block_words, containment):
        part = _pass(texts, block, containment)
        found = part if found is None else found.unionByName(part)
    return found.groupBy("doc_id", "item_id", "n_shingles").agg(F.max("n_shared").alias("n_shared"))


def remove(docs: DataFrame, items: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """The documents that contain no item; all columns stay."""
    bad = contained(docs, items, containment).select(doc_key().alias("_id")).distinct()
    away, back = set_aside(docs)
    return docs.select(*away, doc_key().alias("_id")).join(bad, "_id", "left_anti").select(*back)


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return contained(docs, items).select(
        "doc_id", "item_id", F.col("n_shared").cast("long").alias("n_shared"),
        F.col("n_shingles").cast("long").alias("n_shingles"),
        (F.col("n_shared") / F.col("n_shingles")).alias("containment"))


SQL = r"""
with words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
items as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
doc_grams as (
  select distinct doc_id, array_to_string(list_slice(w, s, s + 4), ' ') as g
  from (select doc_id, w, unnest(range(1, len(w) - 3)) as s from words where len(w) >= 5)),
item_grams as (
  select distinct item_id, array_to_string(list_slice(w, s, s + 4), ' ') as g
  from (select item_id, w, unnest(range(1, len(w) - 3)) as s from items where len(w) >= 5)),
sizes as (select item_id, count(*) as n_shingles from item_grams group by item_id),
hits as (select doc_id, item_id, count(*) as n_shared from doc_grams join item_grams using (g) group by all)
select doc_id, item_id, n_shared, n_shingles, n_shared / n_shingles as containment
from hits join sizes using (item_id) where n_shared >= 0.8 * n_shingles
"""

QUERIES = {"op9_benchmark_decontamination": op9_benchmark_decontamination}
ORACLE = {"op9_benchmark_decontamination": SQL}
