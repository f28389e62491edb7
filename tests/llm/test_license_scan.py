import random
import re

from common import LOWER, SF, collected, docs_of, odd_rows, texts
from pyspark.sql import functions as F

from siniestro.llm.license_scan import (
    BASE, COVERAGE, FUNCTION_WORDS, PASSAGES, SHIFT, op4_license_scan, scan, template_table)

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
CONTRACT = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


def brute(rows):
    out = []
    for i, text in rows:
        w = WORD.findall((text or "").translate(LOWER))
        places = [(a, label) for phrase, label in BASE.items() for a in range(len(w))
                  if w[a:a + len(phrase.split())] == phrase.split()]
        starts = [a for a, _ in places]
        out.append({"doc_id": i, "n_words": len(w), "n_base": len(places), "first_word": min(starts, default=None),
                    "last_word": max(starts, default=None), "base_labels": ",".join(sorted({x for _, x in places}))})
    return sorted(out, key=repr)


def verdict(text, passages=PASSAGES):
    """(labels, score) by trying every span of a passage's diagonals in plain Python."""
    w = WORD.findall((text or "").translate(LOWER))
    grams = {}
    for i, pair in enumerate(zip(w, w[1:], strict=False)):
        grams.setdefault(pair, []).append(i)
    labels = {x for phrase, x in BASE.items()
              if any(w[a:a + len(phrase.split())] == phrase.split() for a in range(len(w)))}
    score = 1.0 if labels else 0.0
    for label, passage in passages.items():
        t = passage.split()
        voting = [(j, p) for j, p in enumerate(zip(t, t[1:], strict=False)) if not FUNCTION_WORDS.issuperset(p)]
        seen = {}
        for j, pair in voting:
            for i in grams.get(pair, ()):
                seen.setdefault(i - j, set()).add(j)
        runs = []
        for d in sorted(seen):
            if runs and d - runs[-1][-1] <= SHIFT:
                runs[-1].append(d)
            else:
                runs.append([d])
        best = 0.0
        for run in runs:
            places = [d + j for d in run for j in seen[d]]
            whole = max(places) + 1 - min(places) < 2 * len(t)
            for d in run:
                got = set().union(*(seen[e] for e in run if whole or 0 <= e - d < len(t)))
                best = max(best, len(got) / len(voting))
        if best >= COVERAGE:
            labels.add(label)
            score = max(score, best)
    return ",".join(sorted(labels)), score


def verdicts(rows):
    return sorted(((i, *verdict(t)) for i, t in rows), key=repr)


def scanned(frame):
    return sorted(((r.doc_id, r.labels, r.score) for r in frame.collect()), key=repr)


def contract(frame):
    return collected(frame.select(*CONTRACT))


def test_matches_brute_force(spark):
    out = op4_license_scan(spark, SF)
    assert contract(out) == brute(texts(spark))
    assert scanned(out) == verdicts(texts(spark))


def test_odd_rows(spark):
    rows = [*odd_rows(), (30, "CC-BY cc by, by cc. General  public\nLicense; All Rights Reserved!"),
            (31, "general public general public license license"), (32, "cc"), (33, "All rights are reserved"),
            (34, "cc by " * 500)]
    clash = {name: F.lit("x") for name in ("template", "votes0", "diagonal", "id", "version", "n")}
    out = scan(docs_of(spark, rows).withColumns(clash))
    assert contract(out) == brute(rows)
    assert scanned(out) == verdicts(rows)


def test_stray_votes_dont_hide_a_passage(spark):
    apache, rng = PASSAGES["apache-2.0"], random.Random(5)
    stray = "the license a the license b the license c the license d " * 8
    rows = [(1, apache + " " + stray), (2, stray + apache), (3, stray + apache + " " + stray), (4, stray),
            (5, apache + " " + stray + "x " * 40 + apache)]
    pool = [p.split() for p in PASSAGES.values()]
    for i in range(60):
        words = []
        for _ in range(rng.randrange(1, 6)):
            t = rng.choice(pool)
            a = rng.randrange(len(t))
            part = t if rng.random() < 0.4 else t[a:a + rng.randrange(2, 12)] * rng.randrange(1, 9)
            words += [x for x in part if rng.random() < 0.97]
        rows.append((10 + i, " ".join(words)))
    got = scanned(scan(docs_of(spark, rows)))
    assert got == verdicts(rows)
    found = {i: labels for i, labels, _ in got}
    assert found[4] == "" and all(found[i] == "apache-2.0" for i in (1, 2, 3, 5))


def test_templates_of_any_length(spark):
    long = " ".join(f"w{i}" for i in range(300))
    cut = " ".join(f"w{i}" for i in range(300) if i % 50)
    rows = [(1, "x " + long), (2, cut), (3, " ".join(long.split()[:200])), (4, PASSAGES["mit-text"])]
    got = {r.doc_id: r.labels for r in scan(docs_of(spark, rows), passages={"long": long}).collect()}
    assert got == {1: "long", 2: "long", 3: "", 4: ""}
    got = {r.doc_id: r.labels for r in scan(docs_of(spark, rows)).collect()}
    assert got == {1: "", 2: "", 3: "", 4: "mit,mit-text"}


def test_labels_and_score(spark):
    mit = PASSAGES["mit"]
    cut = mit.replace("free of charge", "free")  # words left out: a neighbouring diagonal
    rows = [(1, "So: " + mit.upper()), (2, "x " + cut), (3, " ".join(mit.split()[:8])), (4, "cc by"),
            (5, PASSAGES["cc-by-nc-4.0"]), (6, "nothing of it")]
    got = {r.doc_id: (r.labels, round(r.score, 2)) for r in scan(docs_of(spark, rows)).collect()}
    assert got[1] == ("mit", 1.0) and got[2][0] == "mit" and 0.8 <= got[2][1] < 1
    assert got[3] == ("", 0.0) and got[4] == ("cc-by", 1.0) and got[5] == ("cc-by,cc-by-nc-4.0", 1.0)
    assert got[6] == ("", 0.0)


def test_empty_and_native(spark):
    out = scan(docs_of(spark, []).limit(0))
    assert out.count() == 0
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert template_table(spark).count() < 500
