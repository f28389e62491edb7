"""Parameterised SQL over the catalog (A15) and result reuse.

The dashboard's query path is SQL text with named parameters.  Spark binds
named parameter markers itself (``spark.sql(text, args={...})``); values are
never spliced into the text.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from .catalog import Catalog, resolve


def run_query(cat: Catalog, sql: str, params: Mapping[str, object] | None = None,
              tables: Sequence[str] = ()) -> DataFrame:
    """``sql`` with ``:name`` markers bound from ``params``; the logical
    tables it names in ``{table}`` placeholders are resolved for the
    catalog's mode (M18) and passed as DataFrames (no global views)."""
    frames = {t: cat.physical(resolve(t, cat.mode)) for t in tables}
    return cat.spark.sql(sql, args=dict(params or {}), **frames)


def cached(df: DataFrame) -> DataFrame:
    """Keep a result for reuse by several reports (memory, spilling to
    disk); batch jobs have no TTL -- the result lives until unpersisted."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)
