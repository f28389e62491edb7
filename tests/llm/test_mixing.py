import hashlib
import math
from collections import defaultdict
from fractions import Fraction

from common import BLANK_WORD, SF, collected, docs_of, odd_rows

from siniestro.llm.mixing import mix, mixed_rows, mixing_plan, op12_pareto_mix


def targets(sizes, weights=(3, 1, 2)):
    """The contract's words: share by weight, stop at twice the size, deal out the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, out, free = Fraction(3, 2) * sum(sizes.values()), {}, list(names)
    while free:
        whole = sum(weight[s] for s in free)
        above = [s for s in free if left * weight[s] / whole >= 2 * sizes[s]]
        if not above:
            out |= {s: left * weight[s] / whole for s in free}
            break
        for s in above:
            out[s] = Fraction(2 * sizes[s])
            left -= out[s]
            free.remove(s)
    return out


def brute(rows):
    """(doc_id, size, source_size, target, taken) of (doc_id, text, source); rows that repeat all three go together."""
    size = lambda t: len(BLANK_WORD.findall(t or ""))
    of = defaultdict(list)
    for i, t, s in rows:
        of[s].append((i, t or "", size(t)))
    goal = targets({s: sum(x[2] for x in some) for s, some in of.items()})
    out = []
    for s, some in of.items():
        words = sum(x[2] for x in some)
        target = float(goal[s])
        base = math.floor(target / words) if words else 0
        missing = target - base * words
        weight = lambda n: math.floor(256 * math.sqrt(n))
        certain, rest = 0, sorted((n for _, _, n in some if n), reverse=True)
        while rest and weight(rest[0]) * (missing - certain) >= sum(weight(n) * n for n in rest):
            top = rest[0]
            certain += sum(n for n in rest if n == top)
            rest = [n for n in rest if n < top]
        scale = (missing - certain) / sum(weight(n) * n for n in rest) if rest else 0
        ranked = defaultdict(int)
        for i, t, n in some:
            h = hashlib.md5(t.encode()).hexdigest()
            u = (int(hashlib.md5(f"12:{'' if i is None else i}:{h}".encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52
            chance = scale * weight(n)
            if n and (not rest or n > rest[0] or chance >= 1):
                ranked[(0.0, -1 if i is None else i, h)] += n
            elif n and chance > 0:
                ranked[((u / (1 - u)) / (chance / (1 - chance)), -1 if i is None else i, h)] += n
        upto, more = 0, set()
        for key, n in sorted(ranked.items()):
            if upto + n / 2 <= missing:
                more.add(key[1:])
            upto += n
        for i, t, n in some:
            copies = base + ((-1 if i is None else i, hashlib.md5(t.encode()).hexdigest()) in more)
            out.append({"doc_id": i, "size": n, "source_size": words, "target": target, "taken": copies * n})
    return sorted(out, key=repr)


def digest(frame):
    return collected(frame.select("doc_id", "size", "source_size", "target", "taken"))


def near(out, rows):
    source = {(i, len(BLANK_WORD.findall(t or ""))): s for i, t, s in rows}
    got, goal, most = defaultdict(int), {}, defaultdict(int)
    for r in out:
        s = source[(r["doc_id"], r["size"])]
        got[s] += r["taken"]
        goal[s] = r["target"]
        most[s] = max(most[s], r["size"])
        assert r["taken"] <= 2 * r["size"]
    assert all(abs(got[s] - goal[s]) <= most[s] / 2 for s in goal)


def test_all_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()]
    out = digest(op12_pareto_mix(spark, SF))
    assert out == brute(rows)
    near(out, rows)


def test_odd_rows_and_hot_source(spark):
    rows = [*((i, t, s) for i, t in odd_rows() for s in ("a", None)), (50, "", "empty"), (51, None, "empty"),
            *((100 + i, f"one two three {i} " * (1 + i % 7), "hot") for i in range(600)), (52, "x y", ""),
            *((800 + i, "the very same text", "b") for i in range(40))]
    docs = docs_of(spark, [(i, t, None, s, None) for i, t, s in rows])
    assert digest(mix(docs)) == brute(rows)


def test_reruns_and_partitions_agree(spark):
    docs = docs_of(spark, [(i, "w " * (1 + i * i % 50), None, f"s{i % 4}", None) for i in range(300)])
    assert digest(mix(docs)) == digest(mix(docs.repartition(7)))


def test_columns_stay_and_rows_repeat(spark):
    docs = docs_of(spark, [(1, "a b", "en", "s", 3, 9, "k"), (2, "c", "en", "t", 1, 8, "l")], ", taken int, rank string")
    out = mix(docs)
    assert set(out.columns) == {"doc_id", "text", "lang", "source", "n_chars", "rank", "size", "source_size", "target",
                                "copies", "taken"}
    copies = {r["doc_id"]: r["copies"] for r in out.collect()}
    rows = mixed_rows(docs).collect()
    assert {i: sum(r.doc_id == i for r in rows) for i in copies} == copies


def test_empty_table(spark):
    assert mix(docs_of(spark, []).limit(0)).count() == 0


def test_no_python_in_the_plans(spark):
    docs = docs_of(spark, [(1, "a b", None, "s", None)])
    plan = mix(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert mixing_plan(docs)[0].count() == 1
