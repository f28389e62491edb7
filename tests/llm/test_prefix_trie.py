import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from common import BLANK_WORD, SF, collected

from siniestro.llm import prefix_trie as P
from siniestro.llm.prefix_trie import OUT, conversations, op11_prefix_trie, prefix_trie, rebuilt

TURNS = "conv_id long, turn long, role string, text string"


def brute(rows):
    """Nodes of (conv_id, turn, role, text) by plain prefixes."""
    own = defaultdict(list)
    for c, k, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((k is not None, k, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest(), role, text))
    turns = {c: [(x[3], x[4]) for x in sorted(some, key=lambda x: (x[0], x[1] or 0, x[2]))] for c, some in own.items()}
    whole = {}
    for c, some in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        whole[c] = [*turns.get(base, [])[:h], *some[h:]]
    members = defaultdict(list)
    for c in sorted(whole):
        for d in range(len(whole[c]) + 1):
            members[tuple(whole[c][:d])].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    words = lambda p: len(BLANK_WORD.findall(p[-1][1])) if p else 0
    saved, leaves = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(m) - 1) * words(p)
            leaves[p[:d]] += not children[p]
    return sorted(({"conv_id": min(m), "depth": len(p), "parent_conv_id": min(members[p[:-1]]) if p else None,
                    "n_convs": len(m), "n_children": children[p], "n_leaves": leaves[p], "saved_tokens": saved[p],
                    "ends_sha256": hashlib.sha256(",".join(str(c) for c in m if len(whole[c]) == len(p)).encode()).hexdigest()}
                   for p, m in members.items()), key=repr)


def trie(spark, rows):
    return collected(prefix_trie(rebuilt(conversations(spark.createDataFrame(rows, TURNS).repartition(3)))))


def test_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    assert collected(op11_prefix_trie(spark, SF)) == brute(rows)


def test_odd_rows(spark):
    rows = [(1, 0, "user", "a b"), (1, 1, None, "a b"), (1, 1, "", "a b"), (1, 1, "", "a b"), (1, None, "user", None),
            (None, 0, "user", "lost"), (20, 0, "u", ""), (21, 0, "u", ""), (22, 5, "u", None), (-3, 0, "x", "y"),
            (-20, 0, "x", "z"), (41, 0, "u", "x"), (7, 0, "user", "w " * 50_000), (8, 0, "u:1", "2"), (9, 0, "u", ":12"),
            *((30, i, "r", f"t{i % 3}") for i in range(700))]
    assert trie(spark, rows) == brute(rows)


@pytest.mark.parametrize("seed", range(3))
def test_many_shared_prefixes_over_many_partitions(spark, seed):
    """A third of all conversations are copies, first turns are few; nodes reach over the bounds of partitions."""
    rng = random.Random(seed)
    hot = [("user", "hi there"), ("bot", "well well"), ("user", "no")]
    rows = []
    for c in rng.sample(range(2000), 260):
        some = hot if rng.random() < 0.35 else [(rng.choice("ab"), rng.choice(["x", "y z", ""])) for _ in range(rng.randrange(1, 6))]
        rows += [(c, k, role, text) for k, (role, text) in enumerate(some)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 23)
    try:
        assert trie(spark, rows) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_turnless_and_empty(spark):
    none = "conv long, turns array<struct<h:string,words:long>>"
    out = collected(prefix_trie(spark.createDataFrame([(3, []), (2, [])], none)))
    assert [(r["conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["ends_sha256"]) for r in out] == [
        (2, 2, 0, 1, hashlib.sha256(b"2,3").hexdigest())]
    assert trie(spark, [(None, 0, "a", "b")]) == []
    assert prefix_trie(spark.createDataFrame([], none)).columns == list(OUT)


def test_extra_columns_are_ignored(spark):
    frame = spark.createDataFrame([(20, 0, "a", "b", 5, "x")], TURNS + ", conv int, h string")
    assert len(collected(prefix_trie(rebuilt(conversations(frame))))) == 2


def test_extents_by_range_minima():
    import numpy as np

    rng = np.random.default_rng(0)
    values = rng.integers(0, 5, 200)
    table = P.Minima(values)
    for at in range(200):
        for depth in range(6):
            right = at
            while right + 1 < 200 and values[right + 1] >= depth:
                right += 1
            left = at
            while left > 0 and values[left] >= depth:
                left -= 1
            one = np.array([at]), np.array([depth])
            assert table.right(*one)[0] == right and table.left(*one)[0] == left
            assert table.least(np.array([left]), np.array([right]))[0] == values[left:right + 1].min()
