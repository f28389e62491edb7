"""Ranking, dedup, ordering.

Dedup is written as aggregates over fixed-width values, not as a window: they
are combined map-side, so a key holding a third of all rows shuffles a few
candidates per map task (a ``row_number`` window would sort the whole hot
group in one task), and they hash instead of sorting wide rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_best(df: DataFrame, key: str | Sequence[str], priority: str, order: str) -> DataFrame:
    """G1: one row per key: highest ``priority`` (a null one sorts last), then
    lowest ``order`` (ingest order), then smallest content hash.

    Winners are picked on key, priority and order alone; their rows are
    fetched by key and order.  Where ``order`` repeats within a key, the rows
    left are told apart by priority and content, on the partitioning and
    order that the join leaves behind, so exactly one stays.
    """
    keys = [key] if isinstance(key, str) else list(key)
    named = [f"__kb_key{i}" for i in range(len(keys))]
    p = F.col(priority).cast("double")
    rank = F.when(p.isNull() | F.isnan(p), F.lit(float("-inf"))).otherwise(p)
    rows = df.select("*", *[F.coalesce(F.col(k).cast("string"), F.lit("\x00")).alias(n) for k, n in zip(keys, named)],
                     F.col(order).alias("__kb_order"), rank.alias("__kb_rank"))
    first = rows.groupBy(*named, "__kb_rank").agg(F.min("__kb_order").alias("__kb_order"))
    best = first.groupBy(*named).agg(F.max_by("__kb_order", "__kb_rank").alias("__kb_order"))
    one = Window.partitionBy(*named, "__kb_order").orderBy(F.desc("__kb_rank"), "__kb_hash")
    content = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])  # of the winners only
    return (rows.join(best, [*named, "__kb_order"], "left_semi").withColumn("__kb_hash", content).withColumn("__kb_nth", F.row_number().over(one)).filter("__kb_nth = 1")
            .select(*[F.col(f"`{c}`") for c in df.columns]))


def group_sizes(df: DataFrame, keys: Sequence[str], name: str = "__n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def _dup_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Column]:
    """Keys occurring more than once (pre-aggregated, map-side combined),
    renamed so the join back is not a self-join; null-safe condition."""
    d = (group_sizes(df, keys).filter("__n > 1")
         .select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]))
    cond = None
    for i, k in enumerate(keys):
        c = F.col(k).eqNullSafe(F.col(f"__k{i}"))
        cond = c if cond is None else cond & c
    return d, cond


def duplicated(df: DataFrame, keys: Sequence[str], flag: str = "duplicado") -> DataFrame:
    """Flag every member of a duplicated key (pandas ``keep=False``;
    null equals null).  Counts are pre-aggregated, then joined back on a
    null-safe key; AQE splits a skewed join partition."""
    d, cond = _dup_keys(df, keys)
    d = d.withColumn("__dup", F.lit(True))
    out = df.join(d, on=cond, how="left")
    return out.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce(F.col("__dup"), F.lit(False)).alias(flag))


def duplicate_members(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """G2 (rows only): the members of duplicated keys, as a semi join."""
    d, cond = _dup_keys(df, keys)
    return df.join(d, on=cond, how="left_semi")


def drop_dominant(df: DataFrame, group: str, measure: str) -> DataFrame:
    """Remove the group with the largest total ``measure`` (ties: the
    smallest group value)."""
    tot = df.groupBy(group).agg(F.sum(measure).alias("__t"))
    top = tot.orderBy(F.desc("__t"), F.asc(group)).limit(1).select(group)
    return df.join(top, on=group, how="left_anti")


def share(df: DataFrame, c: str, name: str = "share") -> DataFrame:
    """Value / total of the whole frame.  The total is a scalar subquery
    (a distributed, partially aggregated sum), so no single-partition window
    and no join is needed."""
    return df.withColumn(name, F.col(c) / df.select(F.sum(c)).scalar())


def with_row_id(df: DataFrame, *ordinals: str, name: str = "row_id") -> DataFrame:
    """Ingest order id from persisted ordinals (file, sheet, row), never
    from ``monotonically_increasing_id`` which changes between runs."""
    return df.withColumn(name, F.struct(*[F.col(o) for o in ordinals]))


def top_n(df: DataFrame, metric: str, n: int, *tiebreak: str, ascending: bool = False) -> DataFrame:
    """H1/H2: top-N by a metric, nulls last, with explicit tie-breakers
    (planned as TakeOrderedAndProject: a per-partition top-N, no full sort)."""
    first = F.asc_nulls_last(metric) if ascending else F.desc_nulls_last(metric)
    return df.orderBy(first, *[F.asc(t) for t in tiebreak]).limit(n)


def ordered(df: DataFrame, *cols: str | Column) -> DataFrame:
    """H3: multi-key ordering."""
    return df.orderBy(*cols)


def preview(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """H4: first ``n`` rows in a deterministic order."""
    return (df.orderBy(*order) if order else df).limit(n)


def distinct_values(df: DataFrame, col: str | Column, alias: str | None = None) -> DataFrame:
    """H5: distinct lookup values (sort at the consumer)."""
    c = F.col(col) if isinstance(col, str) else col
    return df.select(c.alias(alias) if alias else c).distinct()
