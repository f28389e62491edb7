"""Set operations and reshaping."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .filters import CURRENT, HISTORIC


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """Union by name of frames with different column sets."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), list(frames))


def unify(current: DataFrame | None, historic: DataFrame, origin_col: str = "origen_dato") -> DataFrame:
    """``UNION ALL`` of the current and historic branches tagged with
    their origin; without a current table only the historic branch remains."""
    h = historic.withColumn(origin_col, F.lit(HISTORIC))
    if current is None:
        return h
    return union_all([current.withColumn(origin_col, F.lit(CURRENT)), h])


def distinct_union(col: str, *frames: DataFrame) -> DataFrame:
    """``SELECT DISTINCT c FROM (a UNION ALL b)``, nulls dropped."""
    return union_all([f.select(col) for f in frames]).filter(F.col(col).isNotNull()).distinct()


def schema_diff(spark: SparkSession, a: DataFrame, b: DataFrame) -> DataFrame:
    """Column names present on one side only, both directions."""
    left = spark.createDataFrame([(c,) for c in a.columns], "columna string")
    right = spark.createDataFrame([(c,) for c in b.columns], "columna string")
    return union_all([left.join(right, "columna", "left_anti").withColumn("lado", F.lit("solo_origen")),
                      right.join(left, "columna", "left_anti").withColumn("lado", F.lit("solo_destino"))])


def missing_names(spark: SparkSession, expected: Sequence[str], present: Iterable[str]) -> DataFrame:
    """Expected table/view names that are not present."""
    e = spark.createDataFrame([(n,) for n in expected], "nombre string")
    p = spark.createDataFrame([(n,) for n in present], "nombre string")
    return e.join(p, "nombre", "left_anti")


def drop_exact(df: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """Exact-row dedup, ignoring bookkeeping columns such as ``row_id``
    (the reference adds a unique order column first, so its dedup never
    removes anything -- T3; this is the opt-in working version)."""
    subset = [c for c in df.columns if c not in set(ignore)]
    return df.dropDuplicates(subset)


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], var_name: str = "variable",
         value_name: str = "valor") -> DataFrame:
    """Wide -> long."""
    return df.unpivot(list(ids), list(values), var_name, value_name)


def melt_pairs(df: DataFrame, ids: Sequence[str], pairs: Sequence[tuple[str, str, str]],
               label: str, first: str, second: str, cast: str = "bigint") -> DataFrame:
    """(label, col_a, col_b) triples -> one row per label with two values
    (all values cast to one type, as ``stack`` requires)."""
    args = ", ".join(f"'{lab}', CAST(`{a}` AS {cast}), CAST(`{b}` AS {cast})" for lab, a, b in pairs)
    sel = [f"`{i}`" for i in ids] + [f"stack({len(pairs)}, {args}) AS ({label}, {first}, {second})"]
    return df.selectExpr(*sel)
