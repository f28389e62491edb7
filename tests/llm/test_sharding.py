import heapq
import random
import zlib
from collections import Counter, defaultdict

from common import SF, docs_of, odd_rows, texts

from siniestro.llm.sharding import op7_sharding, schedule, shard


def verify(rows, out, shards=8):
    size = lambda t: len((t or "").encode()) + 1
    assert len(out) == len(rows)
    assert sorted((repr(r.doc_id), r.size, r.text_crc32) for r in out) == sorted(
        (repr(i), size(t), zlib.crc32((t or "").encode())) for i, t in rows)
    slots, load = defaultdict(list), defaultdict(int)
    for r in out:
        slots[r.shard].append(r.slot)
        load[r.shard] += r.size
    assert set(slots) <= set(range(shards))
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    groups = defaultdict(set)
    for r in out:
        groups[(r.size, r.text_crc32)].add(r.shard)
    assert all(len(x) == 1 for x in groups.values())
    return load


def plain_heap(sizes, shards=8):
    """Loads and, per size, how many groups each shard takes, one group after the other."""
    heap, taken = [(0, s) for s in range(shards)], defaultdict(int)
    for size in sorted(sizes, reverse=True):
        load, s = heapq.heappop(heap)
        taken[size, s] += 1
        heapq.heappush(heap, (load + size, s))
    return {s: load for load, s in heap}, dict(taken)


def group_sizes(rows):
    size = Counter()
    for _, t in rows:
        size[t or ""] += len((t or "").encode()) + 1
    return list(size.values())


def same_as_heap(rows, load, shards=8):
    want, _ = plain_heap(group_sizes(rows), shards)
    assert {s: load.get(s, 0) for s in range(shards)} == want


def test_all_documents(spark):
    out = op7_sharding(spark, SF).collect()
    same_as_heap(texts(spark), verify(texts(spark), out))
    assert {(r.law, r.grown_shard) for r in out} == {("bytes", None)}


def test_small_chunks(spark):
    rows = texts(spark)
    same_as_heap(rows, verify(rows, shard(docs_of(spark, rows), chunk_rows=7).collect()))


def test_odd_rows_and_hot_group(spark):
    rows = [*odd_rows(), *((100 + i, "the very same text") for i in range(200))]
    same_as_heap(rows, verify(rows, shard(docs_of(spark, rows)).collect()))
    many = [(i, f"{i:05d}") for i in range(1000)]  # all of one size
    same_as_heap(many, verify(many, shard(docs_of(spark, many), chunk_rows=30).collect()))
    assert shard(docs_of(spark, []).limit(0)).count() == 0


def test_columns_stay(spark):
    out = shard(docs_of(spark, [(1, "a", "en", "s", 1, 9)], ", slot int"))
    assert {"doc_id", "lang", "source", "n_chars", "size", "text_crc32", "shard", "slot"} == set(out.columns)


def test_schedule_is_longest_first():
    rng = random.Random(1)
    for _ in range(300):
        shards = rng.randrange(1, 9)
        sizes = [rng.randrange(1, rng.choice([4, 50, 3000])) for _ in range(rng.randrange(0, 400))]
        sizes += [rng.randrange(1, 20)] * rng.randrange(0, 300)
        got = schedule(Counter(sizes).items(), shards)
        assert {(size, s): n for size, s, _, n in got} == plain_heap(sizes, shards)[1]
    assert schedule([], 3) == []


def test_schedule_of_very_long_runs():
    got = schedule([(5, 10**10 + 3), (10**12, 1), (1, 10**9)], 8)
    assert sum(n for size, _, _, n in got if size == 5) == 10**10 + 3
    load = Counter()
    for size, s, _, n in got:
        load[s] += size * n
    assert max(load[s] for s in range(1, 8)) - min(load[s] for s in range(1, 8)) <= 1
