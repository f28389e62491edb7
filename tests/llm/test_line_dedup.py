import hashlib
from collections import defaultdict

from common import LOWER, SF, collected, docs_of, odd_rows, texts
from pyspark.sql import functions as F

from siniestro.llm.line_dedup import drop_lines, line_keys, op2_line_dedup

BLANKS = " \t\n\x0b\x0c\r"


def key(line):
    return line.strip(BLANKS).translate(LOWER)


def brute(rows):
    """Digest rows of (doc_id, text); None sorts first."""
    order = lambda i: -1 if i is None else i
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                holders[key(line)].add(order(i))
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (len(holders[key(x)]) > 1 and min(holders[key(x)]) != order(i))]
        out.append({"doc_id": i, "n_lines": len(lines), "n_dropped": len(lines) - len(kept),
                    "kept_sha256": hashlib.sha256("\n".join(kept).encode()).hexdigest()})
    return sorted(out, key=repr)


def digest(frame):
    return collected(frame.select("doc_id", "n_lines", "n_dropped",
                                  F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")))


def test_matches_brute_force(spark):
    assert collected(op2_line_dedup(spark, SF)) == brute(texts(spark))


def test_odd_rows(spark):
    rows = [*odd_rows(), (20, "A line that comes back\nshort\n a LINE that comes back\t\nown line of twenty"),
            (21, "short\nA line that comes back\nshort"), (19, "x\na line that comes back"),
            (22, "\n".join(f"line number {i}" for i in range(3000))),
            (23, "\n".join(f"line number {i}" for i in range(2999, -1, -1)) + "\nlast one of all")]
    assert digest(drop_lines(docs_of(spark, rows))) == brute(rows)


def test_hot_line(spark):
    rows = [(i, f"the very common line\nown line {i} here") for i in range(400)]
    assert digest(drop_lines(docs_of(spark, rows))) == brute(rows)


def test_columns_stay_and_clash(spark):
    docs = docs_of(spark, [(1, "a b c", "en", "s", 5, 1, "x"), (2, None, None, None, None, 2, None)],
                   ", n_lines int, h string")
    out = drop_lines(docs)
    assert set(out.columns) == {"doc_id", "text", "lang", "source", "n_chars", "h", "n_lines", "n_dropped"}
    assert [(r.doc_id, r.text, r.h, r.n_lines) for r in out.orderBy("doc_id").collect()] == [
        (1, "a b c", "x", 1), (2, None, None, 1)]


def test_empty_table(spark):
    assert drop_lines(docs_of(spark, []).limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = line_keys(docs_of(spark, [(1, "a")]))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
