import hashlib

import numpy as np
import pytest
from common import SF, collected, docs_of, odd_rows, texts
from pyspark.sql import functions as F

from siniestro.llm.substring_dedup import leftmost_minimum, op3_substring_dedup, remove_repeats
from siniestro.llm.words import chunks, find_words, hash_words, separators


def brute(rows, window=20):
    order = sorted(range(len(rows)), key=lambda i: -1 if rows[i][0] is None else rows[i][0])
    first = {}
    for i in order:
        w = (rows[i][1] or "").encode().split()
        for a in range(len(w) - window + 1):
            first.setdefault(tuple(w[a:a + window]), (rows[i][0], a))
    out = []
    for i, text in rows:
        w = (text or "").encode().split()
        gone = {j for a in range(len(w) - window + 1) if first[tuple(w[a:a + window])] != (i, a)
                for j in range(a, a + window)}
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
        out.append({"doc_id": i, "n_words": len(w), "n_removed": len(gone),
                    "kept_sha256": hashlib.sha256(kept).hexdigest()})
    return sorted(out, key=repr)


def digest(frame):
    return collected(frame.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")))


def test_matches_brute_force(spark):
    assert collected(op3_substring_dedup(spark, SF)) == brute(texts(spark))


def test_odd_rows(spark):
    rows = odd_rows()
    assert digest(remove_repeats(docs_of(spark, rows))) == brute(rows)


@pytest.mark.parametrize("seed", range(3))
def test_random_repeats(spark, seed):
    rng = np.random.default_rng(seed)
    passages = [[f"w{x}" for x in rng.integers(0, 30, n)] for n in (20, 21, 35, 60)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(4):
            words += [f"v{x}" for x in rng.integers(0, 6, int(rng.integers(0, 30)))]
            words += passages[int(rng.integers(0, 4))]
        rows.append((i, " ".join(words)))
    rows += [(100, "a " * 300), (101, "a " * 25), (102, "a b " * 50)]
    assert digest(remove_repeats(docs_of(spark, rows))) == brute(rows)


def test_intervals_are_maximal(spark):
    base = " ".join(f"w{i}" for i in range(60))
    out = {r.doc_id: r for r in remove_repeats(docs_of(spark, [(1, base), (2, "x " + base + " y")])).collect()}
    assert out[1].removed == [] and [(r.lo, r.hi) for r in out[2].removed] == [(1, 61)]
    assert out[2].kept_text == "x y"


def test_columns_stay_and_empty(spark):
    docs = docs_of(spark, [(1, "a b", "en", "s", 3, "z")], ", removed string")
    out = remove_repeats(docs)
    assert {"lang", "source", "n_chars", "removed"} <= set(out.columns) and out.first().n_words == 2
    assert remove_repeats(docs_of(spark, []).limit(0)).count() == 0


def test_leftmost_minimum():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 5, 200).astype(np.uint64)
    for width in (1, 2, 5, 13):
        got = leftmost_minimum(x, width)
        assert got.tolist() == [i + int(np.argmin(x[i:i + width])) for i in range(len(x) - width + 1)]


def test_words_are_hashed_alike_wherever_they_stand():
    import pyarrow as pa

    rows = ["ab cd  é", None, "", "cd", "é ab", "x" * 3_000_000 + " ab"]
    seen = {}
    for chunk in chunks(pa.chunked_array([rows[:3], rows[3:]], pa.string()), 8):
        words = find_words(chunk, separators("space"))
        for s, e, h in zip(words.start, words.end, hash_words(chunk.buf, words), strict=True):
            assert seen.setdefault(chunk.buf[s:e].tobytes(), h) == h
    assert len(seen) == len(set(seen.values())) == 4
