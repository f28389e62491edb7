import random

import numpy as np

from common import SF, collected, docs_of, odd_rows, texts
from pyspark.sql import functions as F

from siniestro.llm.pieces import MARK, Vocabulary, decode, encode, load, op5_sentencepiece

VOCABULARY = load()
SCORES = {p: (s, i) for p, s, i in VOCABULARY.pieces}
LONGEST = max(map(len, SCORES))
OTHER = "\U0010FFFF"  # stands for a literal mark


def brute(text):
    """Viterbi over every substring of the whole text; on equal sums the longer last piece."""
    s = "".join(OTHER if c == MARK else MARK if c == " " else c for c in " " + text) if text else ""
    best = [(0.0, [])]
    for i in range(1, len(s) + 1):
        top = None
        for n in range(min(LONGEST, i), 0, -1):
            hit = SCORES.get(s[i - n:i])
            if hit and (top is None or best[i - n][0] + hit[0] > top[0]):
                top = (best[i - n][0] + hit[0], (i - n, [hit[1]]))
        if s[i - 1] not in SCORES:
            value = best[i - 1][0] + VOCABULARY.unknown
            char = MARK if s[i - 1] == OTHER else s[i - 1]
            if top is None or value > top[0]:
                top = (value, (i - 1, [VOCABULARY.byte_ids[b] for b in char.encode()]))
        best.append((top[0], top[1]))
    ids, i = [], len(s)
    while i:
        back, own = best[i][1]
        ids[:0] = own
        i = back
    return ids


def test_matches_brute_force_and_round_trips(spark):
    rows = texts(spark)
    out = {r.doc_id: r for r in op5_sentencepiece(spark, SF).collect()}
    assert len(out) == len(rows)
    for i, text in rows[:40]:
        assert out[i].token_ids == brute(text)
    want = collected(docs_of(spark, rows).select("doc_id", F.sha2("text", 256).alias("decoded_sha256")))
    assert collected(spark.createDataFrame(
        [(i, r.decoded_sha256) for i, r in out.items()], "doc_id long, decoded_sha256 string")) == want


def test_strange_texts():
    rng = random.Random(1)
    alphabet = ["a", "the", " ", "  ", "\n", "é", "▁", "\x00", "日本", "🙂", "zq", "\t", "ing"]
    for _ in range(200):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 14)))
        ids = np.frombuffer(VOCABULARY.encode([text])[0], np.int32)
        assert ids.tolist() == brute(text)
        assert VOCABULARY.decode(ids) == text
    assert VOCABULARY.decode(np.array([-5, 10**6, 1, 2])) == ""


def test_vocabulary_with_marks_inside():
    v = Vocabulary([("▁a", -1.0, 256), ("b", -1.5, 257), ("▁a▁b", -1.2, 258)], list(range(256)), 259)
    assert v.stretch is None and list(v.best([" a b", " a bb"])) == [[258], [258, 257]]
    assert np.frombuffer(v.encode(["a b"])[0], np.int32).tolist() == [258]


def test_punctuation_that_pieces_join():
    pieces = [("▁a", -1.0, 256), ("b", -1.0, 257), ("a.b", -0.5, 258), (",", -1.0, 259), ("a", -2.0, 260), (".", -1.0, 261)]
    v = Vocabulary(pieces, list(range(256)), 262)
    assert "\\." not in v.stretch and "," in v.stretch
    assert np.frombuffer(v.encode(["xa.b,b"])[0], np.int32).tolist()[-3:] == [258, 259, 257]


def test_odd_rows_and_columns(spark):
    docs = docs_of(spark, [(*r, "en", "s", 1, 7) for r in odd_rows()], ", token_ids int")
    out = decode(encode(docs, VOCABULARY), VOCABULARY)
    assert set(out.columns) == {*docs.columns, "decoded"}
    rows = out.collect()
    assert len(rows) == len(odd_rows())
    assert all(r.decoded == r.text and (r.token_ids is None) == (r.text is None) for r in rows)
    assert decode(encode(docs.limit(0), VOCABULARY), VOCABULARY).count() == 0
