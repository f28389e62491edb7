"""Small inputs and plain re-computations for the operators' tests."""

import random
import re

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANK_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs_of(spark, rows, extra=""):
    """Documents from (doc_id, text) or fuller rows."""
    full = [(*r, *[None] * (5 - len(r))) if len(r) < 5 else r for r in rows]
    return spark.createDataFrame(full, DOCS + extra).repartition(3)


def texts(spark, table="documents"):
    return [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/{table}.parquet").select("*").collect()]


def odd_rows():
    """Nulls, empty and long texts, ties, repeated rows."""
    rng = random.Random(3)
    words = ["the", "Of", "réa", "über", "x1", "cc", "by", "end."]
    long = " ".join(rng.choice(words) + str(rng.randrange(4000)) for _ in range(30_000))
    return [(1, "one two three"), (2, None), (3, ""), (4, " \n\t "), (5, long), (6, long), (6, long),
            (None, "one two three"), (None, None), (7, "x" * 200_000), (8, "The end. The end."), (9, "\n\n\n")]


def collected(frame, key="doc_id"):
    """Rows as dicts, sorted by their text (nulls are fine)."""
    return sorted((r.asDict(True) for r in frame.collect()), key=repr)
