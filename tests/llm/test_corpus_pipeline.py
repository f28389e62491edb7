import hashlib

import corpus_pipeline as P
from common import SF, collected, docs_of, odd_rows
from pyspark.sql import functions as F
from test_decontamination import brute as brute_hits
from test_line_dedup import brute as brute_lines
from test_simhash import brute as brute_groups

from siniestro.llm import language_id


def pairs(frame):
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]


def test_every_stage_against_a_plain_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]

    model = language_id.learn(docs)
    known = {r.doc_id for r in language_id.predict(docs, model, F.col("doc_id")).collect() if not r.rejected}
    one = P.identify_language(spark, docs, SF).cache()
    assert one.columns == columns and {r.doc_id for r in one.collect()} == known and len(known) > 190

    two = P.dedup_lines(spark, one, SF).cache()
    want = {r["doc_id"]: r["kept_sha256"] for r in brute_lines(pairs(one))}
    assert two.columns == columns
    assert {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in pairs(two)} == want

    three = P.dedup_near(spark, two, SF).cache()
    want = {r["doc_id"] for r in brute_groups(pairs(two)) if r["doc_id"] == r["component_id"]}
    assert three.columns == columns and {i for i, _ in pairs(three)} == want

    four = P.decontaminate(spark, three, SF).cache()
    bad = {i for i, *_ in brute_hits(pairs(three), items)}
    assert four.columns == columns and {i for i, _ in pairs(four)} == want - bad

    five = P.tokenise(spark, four, SF)
    want = sorted((i, hashlib.sha256(t.encode()).hexdigest()) for i, t in pairs(four))
    assert sorted((r.doc_id, r.decoded_sha256) for r in five.collect()) == want
    whole = P.run(spark, SF)
    assert sorted((r.doc_id, r.decoded_sha256) for r in whole.collect()) == want


def test_odd_rows_through_all_stages(spark):
    rows = [(i, t, "en" if i and i % 2 else "de", "s", 1) for i, t in odd_rows()]
    docs = docs_of(spark, rows)
    for _, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert 0 < P.tokenise(spark, docs, SF).count() < len(rows)
    none = docs_of(spark, []).limit(0)
    for _, stage in P.STAGES:
        assert collected(stage(spark, none, SF)) == []
