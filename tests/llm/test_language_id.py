import zlib

import numpy as np
from common import docs_of, odd_rows
from pyspark.sql import functions as F

from siniestro.llm.language_id import Model, keep_known, learn, op8_language_id, predict, train

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    out = op8_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = out.collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)
    assert sum(r.rejected for r in rows) / len(rows) < 0.01


def test_prediction_uses_text_only(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    model = learn(docs)
    one = {r.doc_id: (r.lang_pred, r.score) for r in predict(docs, model, F.col("doc_id")).collect()}
    other = docs.withColumn("lang", F.lit("xx")).withColumn("doc_id", F.col("doc_id") + 10_000)
    two = {r.doc_id - 10_000: (r.lang_pred, r.score) for r in predict(other, model, F.col("doc_id")).collect()}
    assert one == two


def test_odd_rows(spark):
    train_on = [(100 + i, "the cat sat on the mat" if i % 2 else "der hund und die katze", "en" if i % 2 else "de")
                for i in range(80)]
    docs = docs_of(spark, [*train_on, *odd_rows(), (50, "123 !!! 456"), (51, "日本"), (52, "und der", None)])
    model = learn(docs)
    assert model.languages == ["de", "en"]
    rows = predict(docs, model, F.col("doc_id"), F.col("text")).collect()
    assert len(rows) == len(train_on) + len(odd_rows()) + 3
    for r in rows:
        if not any(map(str.isalpha, r.text or "")):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
        else:
            assert r.lang_pred in ("de", "en") and r.score > 0
    kept = keep_known(docs, model)
    assert kept.columns == docs.columns and 0 < kept.count() < len(rows)


WORDS = {"en": "the cat sat on a mat and then went out with another friend through rain while people were watching",
         "de": "der hund und die katze sind nicht mehr auf dem weg nach hause weil es schon wieder regnet"}


def sentences(lang, n, seed, words=WORDS):
    rng = np.random.default_rng(seed)
    return [" ".join(rng.choice(words[lang].split(), int(rng.integers(5, 120)))) for _ in range(n)]


def test_foreign_and_gibberish_go_and_short_clean_texts_stay(spark):
    known = [(1000 * k + i, t, lang) for k, lang in enumerate(WORDS) for i, t in enumerate(sentences(lang, 400, k))]
    rng = np.random.default_rng(5)
    gibberish = [" ".join("".join(rng.choice(list("bcdfghjklmnpqrstvwxz"), 7)) for _ in range(60)) for _ in range(40)]
    foreign = {"fi": "kaikki ihmiset syntyv\u00e4t vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu",
               "ru": "\u0432\u0441\u0435 \u043b\u044e\u0434\u0438 \u0440\u043e\u0436\u0434\u0430\u044e\u0442\u0441\u044f "
                     "\u0441\u0432\u043e\u0431\u043e\u0434\u043d\u044b\u043c\u0438 \u0438 \u0440\u0430\u0432\u043d\u044b\u043c\u0438"}
    away = gibberish + [t for lang in foreign for t in sentences(lang, 40, 7, foreign)]
    clean = [t for lang in WORDS for t in sentences(lang, 100, 8)]
    short = [w for text in WORDS.values() for w in text.split()] + ["on the mat", "der hund", "Die Katze!"]
    model = learn(docs_of(spark, known))
    rejected = {r.text: r.rejected for r in predict(docs_of(spark, list(enumerate(away + clean + short))), model,
                                                    F.col("text")).collect()}
    assert sum(rejected[t] for t in away) >= 0.95 * len(away)
    assert sum(rejected[t] for t in clean) <= 0.02 * len(clean)
    assert not any(rejected[t] for t in short)


def test_without_labels(spark):
    docs = docs_of(spark, [(1, "some text"), (2, None), (3, "12")])
    model = learn(docs)
    assert model.languages == []
    got = {r.doc_id: (r.lang_pred, r.rejected) for r in predict(docs, model, F.col("doc_id")).collect()}
    assert got == {1: ("und", False), 2: ("und", True), 3: ("und", True)}
    assert predict(docs.limit(0), model, F.col("doc_id")).count() == 0


def test_one_language_and_empty_samples():
    assert train([]).languages == []
    assert isinstance(train([("en", np.zeros(0, np.int32), np.zeros(0, np.int32))]), Model)
    assert train([("en", np.array([1, 2]), np.array([1, 1]))]).languages == ["en"]
