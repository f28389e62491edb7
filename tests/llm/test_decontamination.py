import numpy as np
from common import SF, collected, docs_of, odd_rows, texts

from siniestro.llm.decontamination import contained, op9_benchmark_decontamination, remove, shingles_of, words_of


def brute(docs, items):
    out = set()
    have = [(i, shingles_of(words_of(t))) for i, t in docs]
    for key, text in items:
        want = shingles_of(words_of(text))
        for i, grams in have:
            if want and len(want & grams) >= 0.8 * len(want):
                out.add((i, key, len(want & grams), len(want)))
    return out


def rows_of(frame):
    return {(r.doc_id, r.item_id, r.n_shared, r.n_shingles) for r in frame.collect()}


def items_of(spark, rows, extra=""):
    return spark.createDataFrame(rows, "item_id long, text string" + extra)


def test_matches_brute_force(spark):
    assert rows_of(op9_benchmark_decontamination(spark, SF)) == brute(texts(spark), texts(spark, "benchmark"))


def test_items_of_all_sizes_in_long_documents(spark):
    rng = np.random.default_rng(2)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 5000, n)]
    items, docs = [], []
    for k, n in enumerate((3, 4, 5, 6, 9, 13, 20, 40, 70, 150, 600)):
        text = word(n)
        items.append((k, " ".join(text)))
        for rep in range(6):
            copy = list(text)
            if rep == 5 and n > 40:
                copy[n // 2] = "changed"
            docs.append((k * 10 + rep, " ".join(word(int(rng.integers(0, 3000))) + copy + word(2000)).upper()))
    docs += [(1000 + i, " ".join(word(500))) for i in range(20)]
    want = brute(docs, items)
    assert len(want) >= 9 * 5
    assert rows_of(contained(docs_of(spark, docs), items_of(spark, items))) == want
    assert rows_of(contained(docs_of(spark, docs), items_of(spark, items), block_words=50)) == want


def test_short_items_are_never_missed(spark):
    rng = np.random.default_rng(9)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 50_000, n)]
    items, docs = [], []
    for k in range(3000):
        text = word(5 + k % 8)
        items.append((k, " ".join(text)))
        copy = [*text[:-1], "changed"] if len(text) >= 9 and k % 16 >= 8 else text
        docs.append((k, " ".join(word(int(rng.integers(20, 60))) + copy + word(40))))
    got = rows_of(contained(docs_of(spark, docs), items_of(spark, items)))
    assert {(i, j) for i, j, _, _ in got} == {(k, k) for k in range(3000)}


def test_odd_rows(spark):
    docs = [*odd_rows(), (40, "a b c d e f g"), (40, "a b c d e f g"), (41, "A, b; c d-e f g!"), (None, "a b c d e f g")]
    items = [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, None), (3, ""), (4, "a b c"), (None, "b c d e f g")]
    assert rows_of(contained(docs_of(spark, docs), items_of(spark, items))) == brute(docs, items)
    kept = remove(docs_of(spark, docs), items_of(spark, items))
    assert {r.doc_id for r in kept.collect()} == {1, 2, 3, 4, 5, 6, 7, 8, 9}


def test_empty_tables_and_columns(spark):
    none = items_of(spark, []).limit(0)
    docs = docs_of(spark, [(1, "a b c d e f", "en", "s", 1, 3)], ", item_id int")
    assert contained(docs, none).count() == 0 and remove(docs, none).columns == docs.columns
    assert contained(docs.limit(0), items_of(spark, [(1, "a b c d e f", 2)], ", doc_id int")).count() == 0
    assert collected(remove(docs, items_of(spark, [(1, "a b c d e f", 2)], ", doc_id int"))) == []
