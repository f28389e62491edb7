import re

import numpy as np
import xxhash
from common import LOWER, SF, collected, docs_of, odd_rows, texts

from siniestro.llm.components import components
from siniestro.llm.simhash import fingerprint, keep_one, links, near_duplicates, op6_simhash_near_dedup


def brute_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not w:
        return 0
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute(rows):
    """component of each row by union-find over all pairs."""
    order = lambda i: -1 if i is None else i
    fps = [brute_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2 or rows[i][0] == rows[j][0]:
                a, b = find(i), find(j)
                if a != b:
                    root[a] = b
    low = {}
    for i, (d, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), 1 << 70), order(d))
    out = [{"doc_id": d, "fingerprint": f"{fps[i]:016x}", "component_id": None if low[find(i)] < 0 else low[find(i)]}
           for i, (d, _) in enumerate(rows)]
    return sorted(out, key=repr)


def test_matches_brute_force(spark):
    assert collected(op6_simhash_near_dedup(spark, SF)) == brute(texts(spark))


def test_odd_rows(spark, tmp_path):
    rows = odd_rows()
    docs_of(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    assert collected(op6_simhash_near_dedup(spark, str(tmp_path))) == brute(rows)


def test_long_text_in_blocks():
    text = ("Alpha beta gamma delta " * 30_000 + "x" * 1_200_000 + " one two") * 2
    assert fingerprint(text) == brute_fingerprint(text)


def _groups(spark, values, light, max_bits=2):
    nodes = spark.createDataFrame([(int(np.uint64(v).astype(np.int64)), i) for i, v in enumerate(values)],
                                  "fp long, id long")
    found = {r.node: r.root for r in components(links(nodes, max_bits, light)).collect()}
    return [found.get(i, i) for i in range(len(values))]


def _brute_groups(values, max_bits=2):
    label = list(range(len(values)))
    changed = True
    while changed:
        changed = False
        for i in range(len(values)):
            for j in range(len(values)):
                if (values[i] ^ values[j]).bit_count() <= max_bits and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


def test_links_in_long_and_short_postings(spark):
    rng = np.random.default_rng(5)
    values = set()
    for centre in rng.integers(0, 1 << 63, 6):
        for _ in range(25):
            v = int(centre)
            for b in rng.integers(0, 64, int(rng.integers(0, 6))):
                v ^= 1 << int(b)
            values.add(v)
    values = sorted(values)
    for bits in (1, 2):
        want = _brute_groups(values, bits)
        assert _groups(spark, values, 1000, bits) == want  # pairs only
        assert _groups(spark, values, 2, bits) == want  # nearly all by stars


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (103, 101), (200, 200), (None, 4), (300, 100)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 101: 100, 103: 100, 300: 100}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_keep_one(spark):
    docs = docs_of(spark, [(3, "a b c d"), (1, "A b c D"), (2, None), (9, ""), (5, "else where it goes")])
    out = keep_one(docs)
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == [1, 2, 5]
    assert near_duplicates(docs_of(spark, []).limit(0)).count() == 0
