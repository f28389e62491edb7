"""Joins (E1-E10).

Join strategy is left to Catalyst + AQE: small lookup tables are broadcast
from runtime statistics (``spark.sql.autoBroadcastJoinThreshold``), big
sides stay sort-merge joins, and AQE splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .filters import CURRENT, HISTORIC


def one_row_per(registry: DataFrame, on: str) -> DataFrame:
    """``registry`` unchanged, or an error when it is read: a second row for
    one ``on`` value would multiply rows.  Part of the plan: nothing runs
    while a query is built, and the query that meets the duplicate fails."""
    n = F.count(F.lit(1)).over(Window.partitionBy(on))
    complaint = F.concat(F.lit("registry has "), F.col("__n").cast("string"), F.lit(f" rows for {on} "),
                         F.coalesce(F.col(on).cast("string"), F.lit("null")))
    kind = registry.schema[on].dataType
    # the key itself, so that no optimisation can skip the check
    checked = F.when(F.col("__n") > 1, F.raise_error(complaint).cast(kind)).otherwise(F.col(on))
    return registry.withColumn("__n", n).withColumn(on, checked).drop("__n")


def attach_registry(df: DataFrame, registry: DataFrame, on: str = "source_file",
                    indicator: str | None = "sin_event_mapping", check: bool = True) -> DataFrame:
    """Rows LEFT JOIN registry on the file name, plus an unmatched flag.

    The registry must have one row per file, which the query itself checks.
    The join strategy is left to statistics and AQE.
    """
    if check:
        registry = one_row_per(registry, on)
    out = df.join(registry.withColumn("__matched", F.lit(True)), on=on, how="left")
    if indicator:
        out = out.withColumn(indicator, F.col("__matched").isNull())
    return out.drop("__matched")


def resolution_key(origin: Column, current_id: Column, event_id: Column) -> Column:
    """E3 rewrite: the disjunctive ON clause
    ``origin equal AND ((actual AND id equal) OR (historico AND event equal))``
    becomes one equi-key so the join is hashed on it, not on ``origin``."""
    return (F.when(origin == CURRENT, F.concat(F.lit("A|"), current_id.cast("string")))
             .when(origin == HISTORIC, F.concat(F.lit("H|"), event_id.cast("string"))))


def join_resolutions(decl: DataFrame, res: DataFrame, unified: bool = False, how: str = "inner") -> DataFrame:
    """E2 (current: on id) / E3 (unified: on the rewritten key)."""
    if not unified:
        return decl.join(res, on="id_resolucion", how=how)
    d = decl.withColumn("__rk", resolution_key(F.col("origen_dato"), F.col("id_resolucion_actual"), F.col("evento_id")))
    r = res.select(*[F.col(c).alias(f"r_{c}") for c in res.columns]).withColumn(
        "__rk", resolution_key(F.col("r_origen_dato"), F.col("r_id_resolucion_actual"), F.col("r_evento_id")))
    return d.join(r, on="__rk", how=how).drop("__rk")


def filter_resolution(decl: DataFrame, res: DataFrame, resolution_id: str) -> DataFrame:
    """``EXISTS`` form of E3 restricted to one resolution: a semi join."""
    r = res.filter(F.col("resolucion_all_id") == F.lit(resolution_id)).select(
        resolution_key(F.col("origen_dato"), F.col("id_resolucion_actual"), F.col("evento_id")).alias("__rk"))
    d = decl.withColumn("__rk", resolution_key(F.col("origen_dato"), F.col("id_resolucion_actual"), F.col("evento_id")))
    return d.join(r, on="__rk", how="left_semi").drop("__rk")


@dataclass(frozen=True)
class Dim:
    """One lookup in a star chain: ``table.pk = fact.fk`` bringing ``cols``
    (mapping source column -> output name)."""
    table: DataFrame
    fk: str | Column
    pk: str
    cols: dict[str, str]
    how: str = "left"


def lookup(df: DataFrame, dims: Sequence[Dim]) -> DataFrame:
    """E5: chained equi-joins to dimension tables (left by default)."""
    out = df
    for i, d in enumerate(dims):
        pk = f"__pk{i}"
        right = d.table.select(F.col(d.pk).alias(pk), *[F.col(s).alias(t) for s, t in d.cols.items()])
        fk = F.col(d.fk) if isinstance(d.fk, str) else d.fk
        out = out.join(right, on=fk == F.col(pk), how=d.how).drop(pk)
    return out


def join_declarations(fact: DataFrame, decl: DataFrame, fk: str, pk: str = "id_ddjj", how: str = "inner") -> DataFrame:
    """Fact rows joined to the declaration centre."""
    return fact.join(decl, on=F.col(fk) == F.col(pk), how=how)


def with_count(df: DataFrame, fact: DataFrame, key: str, fk: str, name: str) -> DataFrame:
    """Correlated ``(SELECT COUNT(*) FROM fact WHERE fk = key)`` written
    as pre-aggregation (map-side partial counts) + left join."""
    counts = fact.groupBy(F.col(fk).alias("__k")).agg(F.count(F.lit(1)).alias("__n"))
    return (df.join(counts, on=F.col(key) == F.col("__k"), how="left")
              .withColumn(name, F.coalesce(F.col("__n"), F.lit(0)))
              .drop("__k", "__n"))


def orphans(left: DataFrame, right: DataFrame, left_key: Column | str, right_key: Column | str) -> DataFrame:
    """E8 building block: rows of ``left`` whose key has no match in ``right``."""
    lk = F.col(left_key) if isinstance(left_key, str) else left_key
    rk = F.col(right_key) if isinstance(right_key, str) else right_key
    r = right.select(rk.alias("__rk")).distinct()
    return left.join(r, on=lk == F.col("__rk"), how="left_anti")


def by_id(df: DataFrame, col: str, value) -> DataFrame:
    """Point lookup; the literal predicate is pushed into the scan."""
    return df.filter(F.col(col) == F.lit(value))


def align(left: DataFrame, right: DataFrame, on: str | Sequence[str], left_suffix: str = "_origen",
          right_suffix: str = "_destino") -> DataFrame:
    """Full outer alignment of two per-table metric frames."""
    keys = [on] if isinstance(on, str) else list(on)
    l = left.select(*keys, *[F.col(c).alias(c + left_suffix) for c in left.columns if c not in keys])
    r = right.select(*keys, *[F.col(c).alias(c + right_suffix) for c in right.columns if c not in keys])
    return l.join(r, on=keys, how="full_outer")
