"""Operator 8: language identification by averaged hashed subword embeddings and a linear softmax.

A document is the mean of the embeddings of its subwords (byte 3-grams and
4-grams of the text with everything but letters turned into spaces, hashed
into ``BUCKETS``); a linear softmax reads the languages off that mean.  Both
layers are trained by stochastic gradient descent in numpy.

* Training: a sample of labelled rows, bounded by ``PER_LANGUAGE`` expected
  rows for each language, drawn by a hash of the id (the documented bound of
  this operator).  Tasks turn the sampled rows' whole texts into bucket
  counts; the driver receives at most ``BUCKETS`` counts per sampled row.
* Calibration: a fifth of the sample takes no part in training.  The
  temperature that minimises its log loss calibrates the probabilities.  Its
  whole texts and passages of them (2 to ``PASSAGE`` characters, grown to
  whole words) fall into classes by the bit length of their number of
  subwords; a class's rejection threshold is the confidence that all but
  ``REJECT`` of it reach, so a single word is held against single words and a
  long text against long ones.  A class of fewer than ``ENOUGH`` texts is
  joined by the shorter ones next to it, and then by the longer ones.
* Prediction: mean and linear layer are both linear, so each bucket's score
  for each language is computed once and a document's scores are sums over
  its subwords.  Whole texts, no shuffle.

Defined results: null text or text without any letter is ``und`` with score 0
and is rejected; without any labelled training row every text is ``und`` and
only texts without letters are rejected; with one learned language every text
with a letter has probability 1 and stays; a text of one or two bytes has no
subword to hold against and stays if it has a letter; ties in probability go to the
language that sorts first; null ids count as the empty string in the fold;
repeated rows are scored each; extra columns stay in :func:`keep_known`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siniestro.llm.columns import fold_of, set_aside
from siniestro.llm.words import Chunk, chunks

BUCKETS = 1 << 14
PER_LANGUAGE = 300
DIMENSIONS = 16
EPOCHS = 12
RATE = 0.5
REJECT = 0.001
PASSAGE = 1024
ENOUGH = 250
UNKNOWN = "und"

_LETTER = np.zeros(256, bool)
_LETTER[128:] = True
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_FOLD = np.full(256, 32, np.uint8)
_FOLD[_LETTER] = np.flatnonzero(_LETTER)
_FOLD[65:91] += 32


def subwords(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all subwords of a chunk and the document each belongs to."""
    b = _FOLD[chunk.buf].astype(np.uint32)
    n = len(b)
    doc = np.repeat(np.arange(chunk.size), np.diff(chunk.off))
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    found, of = [], []
    for k, factor in ((3, 0x9E3779B1), (4, 0x85EBCA77)):
        if n < k:
            continue
        gram = b[:n - k + 1].copy()
        for j in range(1, k):
            gram |= b[j:n - k + 1 + j] << np.uint32(8 * j)
        inner = b[1:n - k + 2] != 32  # a letter behind the first byte, all in one document
        ok = np.flatnonzero(inner & (doc[:n - k + 1] == doc[k - 1:]))
        found.append(((gram[ok] * np.uint32(factor)) >> shift).astype(np.int32))
        of.append(doc[ok])
    if not found:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(of)


@dataclass
class Model:
    languages: list[str] = field(default_factory=list)
    scores: np.ndarray = field(default_factory=lambda: np.zeros((BUCKETS, 0)))  # per bucket and language
    bias: np.ndarray = field(default_factory=lambda: np.zeros(0))
    temperature: float = 1.0
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(64))  # per bit length of the number of subwords

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        x = logits / self.temperature
        x = np.exp(x - x.max(axis=1, keepdims=True))
        return x / x.sum(axis=1, keepdims=True)


Counts = tuple[np.ndarray, np.ndarray]
Sample = list[tuple[str, np.ndarray, np.ndarray]]


def _bit_length(n: np.ndarray) -> np.ndarray:
    return np.frexp(n.astype(np.float64))[1]


def _thresholds(level: np.ndarray, confidence: np.ndarray, reject: float) -> np.ndarray:
    """Per class the confidence that all but ``reject`` of its calibration texts reach."""
    out = np.zeros(64)
    for at in range(1, 64):
        # nearest first: the class, the shorter ones, the longer ones
        reach = [*range(at, 0, -1), *range(at + 1, 64)]
        use = np.zeros(len(level), bool)
        for other in reach:
            if use.sum() >= ENOUGH:
                break
            use |= level == other
        if use.any():
            out[at] = np.quantile(confidence[use], reject) - 1e-9  # sums in another order differ in the last bits
    return out


def train(sample: Sample, epochs: int = EPOCHS, rate: float = RATE, reject: float = REJECT,
          passages: list[list[Counts]] | None = None) -> Model:
    """Fit on (language, buckets, counts) rows; every fifth row of a language, and its passages, calibrate."""
    languages = sorted({lang for lang, _, _ in sample})
    if not languages:
        return Model()
    number = {lang: i for i, lang in enumerate(languages)}
    seen = dict.fromkeys(languages, 0)
    fit, held = [], []
    fit_texts, held_texts = [], []
    for row, (lang, at, count) in enumerate(sample):
        if not len(at):
            continue
        seen[lang] += 1
        (held_texts if seen[lang] % 5 == 0 else fit_texts).extend([(at, count), *(passages[row] if passages else [])])
        (held if seen[lang] % 5 == 0 else fit).append((number[lang], at, (count / count.sum()).astype(np.float32)))
    if not fit:
        return Model()
    rng = np.random.default_rng(8)
    table = rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    layer, bias = np.zeros((DIMENSIONS, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    steps, done = epochs * len(fit), 0
    for _ in range(epochs):
        for i in rng.permutation(len(fit)):
            lang, at, weight = fit[i]
            mean = weight @ table[at]
            logits = mean @ layer + bias
            error = np.exp(logits - logits.max())
            error /= error.sum()
            error[lang] -= 1
            step = np.float32(rate * (1 - done / steps))
            back = layer @ error
            layer -= step * np.outer(mean, error)
            bias -= step * error
            # a step per subword, as if each were seen by itself
            table[at] -= step * (weight[:, None] * len(at) ** 0.5) * back
            done += 1
    model = Model(languages, (table @ layer).astype(np.float64), bias.astype(np.float64))
    check = held or fit
    logits = np.array([weight @ model.scores[at] + model.bias for _, at, weight in check])
    truth = np.array([lang for lang, _, _ in check])

    def loss(t: float) -> float:
        x = logits / t
        x = x - x.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(x).sum(axis=1)) - x[np.arange(len(x)), truth]))

    model.temperature = min(np.geomspace(0.25, 8, 61), key=loss)
    texts = [(at, n) for at, n in (held_texts or fit_texts) if len(at)]
    logits = np.array([n @ model.scores[at] / n.sum() + model.bias for at, n in texts])
    level = _bit_length(np.array([n.sum() for _, n in texts]))
    model.thresholds = _thresholds(level, model.probabilities(logits).max(axis=1), reject)
    return model


def passages_of(text: str, seed: int) -> list[str]:
    """Passages of 2, 4, ... ``PASSAGE`` characters at places drawn by ``seed``, grown to the blanks around them."""
    rng = np.random.default_rng(seed)
    out, size = [], 2
    while size <= PASSAGE and size < len(text):
        for _ in range(4 if size <= 64 else 2):
            at = int(rng.integers(0, len(text) - size + 1))
            lo, hi = text.rfind(" ", max(at - size, 0), at) + 1, text.find(" ", at + size, at + 2 * size)
            lo = lo or (0 if at <= size else at)
            out.append(text[lo:at + size if hi < 0 else hi])
        size *= 2
    return out


def _counts(texts: pa.Array) -> list[Counts]:
    """Bucket counts of each text."""
    out = []
    for chunk in chunks(texts, 1 << 20):
        at, doc = subwords(chunk)
        order = np.argsort(doc, kind="stable")
        at, doc = at[order], doc[order]
        edge = np.searchsorted(doc, np.arange(chunk.size + 1))
        for i in range(chunk.size):
            found, n = np.unique(at[edge[i]:edge[i + 1]], return_counts=True)
            out.append((found, n.astype(np.int32)))
    return out


def sample_of(docs: DataFrame, trained_on: Column,
              per_language: int = PER_LANGUAGE) -> tuple[Sample, list[list[Counts]]]:
    """Bucket counts of about ``per_language`` rows of each language (fewer where there are fewer) and their passages."""
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                       F.col("text").cast("string").alias("text")).filter(trained_on & F.col("lang").isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}  # one row per language
    if not sizes:
        return [], []
    limits = F.create_map(*(F.lit(x) for lang, n in sorted(sizes.items())
                            for x in (lang, int(min(1.0, per_language / n) * (1 << 31)))))
    draw = F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit("")), F.lit(8)), F.lit(1 << 31))
    drawn = rows.withColumn("draw", draw).filter(F.col("draw") < limits[F.col("lang")])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, sizes = [], []
            for seed, text, whole in zip(batch.column(0), batch.column(2), _counts(batch.column(2)), strict=True):
                parts = [whole, *_counts(pa.array(passages_of(text.as_py() or "", seed.as_py()), pa.string()))]
                out.append([np.concatenate(x) for x in zip(*parts, strict=True)])
                sizes.append([len(at) for at, _ in parts])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([a for a, _ in out], pa.list_(pa.int32())),
                 pa.array([n for _, n in out], pa.list_(pa.int32())), pa.array(sizes, pa.list_(pa.int32()))],
                names=["draw", "lang", "at", "n", "size"])

    counted = drawn.select("draw", "lang", "text").mapInArrow(
        count, "draw long, lang string, at array<int>, n array<int>, size array<int>").toArrow()
    found = []
    for lang, draw, at, n, size in zip(*(counted.column(i) for i in (1, 0, 2, 3, 4)), strict=True):
        cuts = np.cumsum(size.values.to_numpy())[:-1]
        parts = list(zip(np.split(at.values.to_numpy(), cuts), np.split(n.values.to_numpy(), cuts), strict=True))
        found.append((lang.as_py(), draw.as_py(), parts))
    found.sort(key=lambda x: (x[1], x[0], len(x[2][0][1])))
    return [(lang, *parts[0]) for lang, _, parts in found], [parts[1:] for _, _, parts in found]


def predict(docs: DataFrame, model: Model, *carried: Column) -> DataFrame:
    """``carried`` columns, ``lang_pred``, ``score`` and ``rejected`` per row of ``docs``."""
    texts = docs.select(*carried, F.col("text").cast("string").alias("_text"))
    schema = texts.select(*texts.columns[:-1]).schema
    for name, kind in (("lang_pred", "string"), ("score", "double"), ("rejected", "boolean")):
        schema = schema.add(name, kind)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        tables = [np.ascontiguousarray(m.scores[:, i]) for i in range(len(m.languages))]
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            best, score, least = np.zeros(len(texts), int), np.zeros(len(texts)), np.zeros(len(texts))
            for chunk in chunks(texts, 1 << 20):
                at, doc = subwords(chunk)
                n = np.bincount(doc, minlength=chunk.size)
                if not tables:
                    continue
                sums = np.stack([np.bincount(doc, t[at], chunk.size) for t in tables], axis=1)
                p = m.probabilities(sums / np.maximum(n, 1)[:, None] + m.bias)
                rows = slice(chunk.first, chunk.first + chunk.size)
                best[rows], score[rows] = p.argmax(axis=1), p.max(axis=1)
                least[rows] = m.thresholds[_bit_length(n)]
            letters = [_has_letter(t.as_py()) for t in texts]
            known = [x and bool(tables) for x in letters]
            names = [m.languages[i] if k else UNKNOWN for i, k in zip(best, known, strict=True)]
            score = np.where(known, score, 0.0)
            bad = ~np.array(letters, bool) | (np.array(known, bool) & (score < least))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(names, pa.string()), pa.array(score), pa.array(bad)],
                names=[*batch.schema.names[:-1], "lang_pred", "score", "rejected"])

    return texts.mapInArrow(work, schema)


def _has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def learn(docs: DataFrame, folds: int = 3, held_out: int = 1, per_language: int = PER_LANGUAGE) -> Model:
    """A model from the labelled rows outside the held-out fold."""
    sample, passages = sample_of(docs, fold_of("doc_id", folds) != held_out, per_language)
    return train(sample, passages=passages)


def keep_known(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that the model does not reject; all columns stay."""
    away, back = set_aside(docs)
    return predict(docs, model, *away).filter("not rejected").select(*back)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return predict(docs, learn(docs), F.col("doc_id"), (fold_of("doc_id", 3) == 1).alias("held_out"))


QUERIES = {"op8_language_id": op8_language_id}
ORACLE: dict[str, str] = {}
