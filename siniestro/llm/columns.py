"""Column expressions that the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NULL_ID = -(2 ** 63)
"""Stands for a null id inside the operators, so that null sorts first and joins."""


def set_aside(docs: DataFrame, *without: str) -> tuple[list[Column], list[Column]]:
    """The columns of ``docs`` (but ``without``) under names of their own, and the way back.

    Operators carry a table's columns as c0, c1, ..., so that no name in it
    can clash with one of theirs.
    """
    kept = [c for c in docs.columns if c not in without]
    away = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)]
    return away, [F.col(f"c{i}").alias(c) for i, c in enumerate(kept)]


def doc_key(name: str = "doc_id") -> Column:
    """The id as a long, null as :data:`NULL_ID`."""
    return F.coalesce(F.col(name).cast("long"), F.lit(NULL_ID))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def text_version(name: str = "text") -> Column:
    """Tells rows of one id with different texts apart."""
    return F.xxhash64(text_or_empty(name))


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, nothing else (``lower`` is that for text in ASCII)."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def fold_of(column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (a null id counts as the empty string)."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(folds))
