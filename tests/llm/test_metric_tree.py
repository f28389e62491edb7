import math

import numpy as np
import pandas as pd

from siniestro.llm.metric_tree import K, Tree, build_pages, op1_metric_tree_topk, quantised, search

SF = "/root/testdata/sf0.001"


def brute(rows, queries, k=K):
    """(query, rank, vec, score) of rows (id, integers)."""
    out = []
    for q, x in queries:
        found = sorted((-int(np.dot(x, y)), i) for i, y in rows if i != q and len(y) == len(x))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found[:k])]
    return sorted(out)


def floored(rows):
    return [(i, np.array([math.floor(256 * x) for x in v])) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]


def hits(frame):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in frame.collect())


def test_matches_brute_force(spark):
    rows = floored((r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect())
    assert hits(op1_metric_tree_topk(spark, SF)) == brute(rows, [r for r in rows if r[0] % 50 == 0])


def _tree(ids, vectors, page):
    top = float(max((vectors.astype(float) ** 2).sum(axis=1)))
    return Tree(pd.DataFrame(build_pages(ids, vectors, top, page=page, fanout=4)), top)


def test_tree_is_exact_and_prunes():
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 100, (20, 8))
    vectors = np.floor(centres[rng.integers(0, 20, 3000)] + rng.normal(0, 3, (3000, 8))).astype(np.int64)
    vectors[:900] = vectors[0]  # copies
    tree = _tree(np.arange(3000), vectors, 16)
    assert max(map(len, tree.ids)) <= 16 and sum(map(len, tree.ids)) == 3000
    for q in range(0, 3000, 100):
        want = [(0, -s, i) for s, i in sorted((-int(vectors[q] @ v), i) for i, v in enumerate(vectors) if i != q)[:5]]
        one = np.array([q]), vectors[q:q + 1], 5
        assert tree.search(*one, np.array([-np.inf])) == want
        assert tree.search(*one, np.array([float(want[4][1])]))[0] == want[0]
    asked = np.arange(0, 3000, 7)
    got = tree.search(asked, vectors[asked], 5, np.full(len(asked), -np.inf))
    scores = vectors[asked] @ vectors.T
    for row, q in enumerate(asked):
        best = sorted((-int(s), i) for i, s in enumerate(scores[row]) if i != q)[:5]
        assert [(s, i) for r, s, i in got if r == row] == [(-s, i) for s, i in best]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 4)]) for i in range(0, 300)]
    rows += [(1000 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(150)]  # ties
    rows += [(50, rows[50][1]), (400, None), (401, [nan, 1.0, 1.0, 1.0]), (402, [1.0, None, 0.0, 0.0]), (403, []),
             (404, [inf, 0.0, 0.0, 0.0]), (None, [1.0, 1.0, 1.0, 1.0]), (450, [1.0, 2.0]), (451, [2.0, 1.0]),
             (500, [0.1])]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, cell int")
    vectors = quantised(frame, "vec_id", "embedding")
    plain = floored((r.vec_id, r.embedding) for r in frame.dropDuplicates(["vec_id", "embedding"]).collect())
    got = hits(search(vectors, vectors.filter("id % 50 = 0")))
    assert got == brute(plain, [r for r in plain if r[0] % 50 == 0])
    assert [x for x in got if x[0] == 500] == [] and [x[2] for x in got if x[0] == 450] == [451]


def test_dense_cells_are_cut_again_and_large_components(spark):
    from siniestro.llm.metric_tree import build_index
    rng = np.random.default_rng(6)
    # nearly all rows in one dense place, a third of them equal, some far away, some beyond what fits floats
    dense = np.concatenate((rng.normal(50, 0.05, (700, 4)), np.tile([[50.0] * 4], (400, 1)), rng.normal(0, 40, (20, 4)),
                            rng.normal(0, 2e5, (6, 4)), [[1e9, 0, 0, -1e9]]))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(dense)], "vec_id long, embedding array<double>")
    vectors = quantised(frame, "vec_id", "embedding")
    pages, cells = build_index(vectors, tree_rows=64, max_pivots=64)
    assert cells.second[4] and sum(len(r.ids) for r in pages.select("ids").collect()) == len(dense)
    top = 2 ** 26
    plain = [(i, np.array([max(-top, min(top, math.floor(256 * x))) for x in v])) for i, v in enumerate(dense)]
    assert hits(search(vectors, vectors.filter("id % 50 = 0"))) == brute(plain, [r for r in plain if r[0] % 50 == 0])


def test_empty(spark):
    frame = quantised(spark.createDataFrame([], "vec_id long, embedding array<float>"), "vec_id", "embedding")
    assert search(frame, frame).count() == 0
