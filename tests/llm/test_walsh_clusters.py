import hashlib
import math

import numpy as np
from common import SF, collected

from siniestro.llm.walsh_clusters import OUT, cluster, nearest, op13_walsh_clusters, sequency, walsh


def brute(rows, k=40, rounds=5, dim=64):
    """Digest rows of (id, vector) by plain search."""
    kept = [(i, [max(-2 ** 27, min(2 ** 27, math.floor(256 * float(x)))) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest()
    cents = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]
    away = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    place = lambda: [min(range(len(cents)), key=lambda j: (away(v, cents[j]), j)) for _, v in kept]
    for _ in range(rounds):
        at = place()
        for j in range(len(cents)):
            mine = [v for (_, v), c in zip(kept, at, strict=True) if c == j]
            if mine:
                cents[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    at = place()
    dist = [away(v, cents[c]) for (_, v), c in zip(kept, at, strict=True)]
    inertia = {c: sum(d for d, x in zip(dist, at, strict=True) if x == c) for c in at}
    return sorted(({"vec_id": i, "cluster": c, "distance": d, "cluster_inertia": inertia[c], "inertia": sum(dist),
                    "centroid_sha256": hashlib.sha256(",".join(map(str, cents[c])).encode()).hexdigest()}
                   for (i, _), c, d in zip(kept, at, dist, strict=True)), key=repr)


def frame(spark, rows, more=""):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>" + more).repartition(3)


def test_matches_brute_force(spark):
    rows = [(r[0], list(r[1])) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select(
        "vec_id", "embedding").collect()]
    assert collected(op13_walsh_clusters(spark, SF)) == brute(rows)


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    some = [(i, rng.normal(size=64).tolist()) for i in range(60)]
    same = [0.25] * 64
    big = [3.0e5 if i % 2 else -3.0e5 for i in range(64)]
    rows = [*some, *((100 + i, same) for i in range(50)), (7, same), (7, same), (None, same), (200, None),
            (201, same[:63]), (202, [None, *same[1:]]), (203, [float("nan"), *same[1:]]),
            (204, [float("inf"), *same[1:]]), (205, big), (206, [1e30, *same[1:]]), (207, [])]
    assert collected(cluster(frame(spark, rows)).select("vec_id", *OUT)) == brute(rows)


def test_few_vectors_and_none(spark):
    rows = [(1, [1.0] * 64), (2, [-1.0] * 64)]
    assert collected(cluster(frame(spark, rows)).select("vec_id", *OUT)) == brute(rows)
    assert cluster(frame(spark, rows).limit(0)).count() == 0


def test_columns_stay(spark):
    out = cluster(frame(spark, [(1, [1.0] * 64, "x", 5)], ", cluster string, coefs int"))
    assert set(out.columns) == {"vec_id", "embedding", "coefs", *OUT}
    assert [(r.coefs, r.cluster, r.distance) for r in out.collect()] == [(5, 0, 0)]


def test_transform_and_search():
    rng = np.random.default_rng(2)
    x, c = rng.integers(-9, 9, (300, 64)), rng.integers(-9, 9, (17, 64))
    c[5] = c[3]  # ties go to the smaller number
    assert (walsh(walsh(x)) == 64 * x).all()
    order = sequency(64)
    assert sorted(order) == list(range(64)) and order[0] == 0
    number, total = nearest(walsh(x)[:, order], walsh(c)[:, order])
    full = ((x[:, None] - c[None]) ** 2).sum(axis=2)
    assert (number == full.argmin(axis=1)).all() and (total == 64 * full.min(axis=1)).all()
