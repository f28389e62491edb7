"""Typed staging load with quarantine (A10) and access paths.

A row enters the staging table with the declared types, or it is rejected:
``checked`` adds to every row the list of (column, value, rule) it breaks, in
one projection.  Rejects are a table of their own; accepted and rejected rows
add up to the input, and no value is cut, rounded or dropped silently.

The source puts a secondary index on seven filter columns.  Here the layout
serves them: a directory per year, and inside it files ordered along a curve
that interleaves the rank bits of the other six, so every one of them is
confined to a part of the files by Parquet's statistics and dictionaries.
Identifiers that are looked up one by one get bloom filters.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import norm_staging_header, strip_ws
from ..schema import FLAG_COLUMNS, NUMERIC_COLUMNS
from ..session import materialize

# --- fixed values: staging types ---------------------------------------------------
TEXT_LENGTHS = {
    "evento_id": 100, "dto": 100, "source_file": 255, "source_sheet": 255, "dataset_role": 50, "relation_type": 50,
    "productor_nombre": 255, "documento_nro": 50, "cuit_cuil": 50, "departamento": 100, "localidad": 150, "paraje": 150,
    "actividad": 100, "cultivo": 150, "especie": 150, "categoria": 150, "severidad_maxima": 50,
}
INTEGER_COLUMNS = ("anio",)
DATETIME_COLUMNS = ("fecha_carga",)
INDEX_COLUMNS = ("evento_id", "anio", "departamento", "actividad", "cultivo", "source_file", "severidad_maxima")
# -----------------------------------------------------------------------------------
PARTITION = "anio"
LOOKUP_COLUMNS = ("codigo", "iddj", "documento_nro", "cuit_cuil")
RANK_BITS = 4
FILE_ROWS = 250_000   # one task sorts and writes as many
REJECTS = "array<struct<columna:string,valor:string,regla:string>>"


def _rule(name: str, kind: str) -> tuple[Column, Column, str] | None:
    """(typed value, broken, rule) of a column; None: taken as it is."""
    c = F.col(f"`{name}`")
    text = strip_ws(c.cast("string"))
    blank = F.coalesce(text, F.lit("")) == ""
    if name in TEXT_LENGTHS:
        return c.cast("string"), F.length(c.cast("string")) > TEXT_LENGTHS[name], f"longitud {TEXT_LENGTHS[name]}"
    if name in INTEGER_COLUMNS:
        number = F.when(text.rlike(r"^[+-]?\d+(\.0*)?$"), F.regexp_replace(text, r"\..*$", "")).try_cast("int")
        return number, ~blank & number.isNull(), "entero"
    if name in DATETIME_COLUMNS:
        moment = c if kind.startswith("timestamp") else text.try_cast("timestamp_ntz")
        return moment.cast("timestamp_ntz"), ~blank & moment.isNull(), "fecha"
    if name in FLAG_COLUMNS:
        flag = text.try_cast("boolean")
        return flag, ~blank & flag.isNull(), "booleano"
    if name in NUMERIC_COLUMNS:
        number = text.try_cast("double")
        return number, ~blank & number.isNull(), "numero"
    return None


def checked(df: DataFrame) -> DataFrame:
    """Staging names (C6), typed columns, ``fecha_carga`` where absent, and
    ``rechazos``: what each row breaks (empty: accepted)."""
    out = df.toDF(*[norm_staging_header(c) for c in df.columns])
    if "fecha_carga" not in out.columns:
        out = out.withColumn("fecha_carga", F.localtimestamp())
    typed, broken = [], []
    for name, kind in out.dtypes:
        rule = _rule(name, kind)
        if rule is None:
            typed.append(F.col(f"`{name}`"))
            continue
        value, wrong, text = rule
        typed.append(value.alias(name))
        broken.append(F.when(F.coalesce(wrong, F.lit(False)), F.struct(
            F.lit(name).alias("columna"), F.col(f"`{name}`").cast("string").alias("valor"), F.lit(text).alias("regla"))))
    flaws = F.array_compact(F.array(*broken)) if broken else F.array().cast(REJECTS)
    return out.select(*typed, flaws.alias("rechazos"))


def accepted(rows: DataFrame) -> DataFrame:
    return rows.filter(F.size("rechazos") == 0).drop("rechazos")


def rejected(rows: DataFrame, *ids: str) -> DataFrame:
    """One row per broken rule: the row's ids, column, value and rule."""
    return rows.filter(F.size("rechazos") > 0).select(*ids, F.explode("rechazos").alias("r")).select(*ids, "r.*")


def rank_bounds(df: DataFrame, columns: Sequence[str], bits: int = RANK_BITS) -> dict[str, list[tuple[str, int]]]:
    """Per column up to ``2**bits`` ranges of about equally many rows: (least value, number).

    Values are counted first (combined map-side); running counts over a
    column's distinct values give the ranks.  The driver gets at most
    ``2**bits`` values a column.
    """
    spelled = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in columns)
    counts = (df.selectExpr(f"stack({len(columns)}, {spelled}) AS (c, v)").filter("v is not null")
              .groupBy("c", "v").agg(F.count(F.lit(1)).alias("n")))
    own = Window.partitionBy("c")
    middle = F.sum("n").over(own.orderBy("v")) - F.col("n") / 2  # of the value's own rows
    ranked = counts.withColumn("range", F.floor(middle * (1 << bits) / F.sum("n").over(own)))
    found = ranked.groupBy("c", "range").agg(F.min("v").alias("v")).collect()
    return {c: sorted((r["v"], int(r["range"])) for r in found if r["c"] == c) for c in columns}


def curve(bounds: dict[str, list[tuple[str, int]]], bits: int = RANK_BITS) -> Column:
    """The rank bits of all columns interleaved, high bits first."""
    def rank(value: Column, values: list[tuple[str, int]]) -> Column:
        """Halving: ranges ascend with their least values."""
        if len(values) == 1:
            return F.lit(values[0][1])
        half = len(values) // 2
        return F.when(value >= F.lit(values[half][0]), rank(value, values[half:])).otherwise(rank(value, values[:half]))

    def ranked(c: str, values: list[tuple[str, int]]) -> Column:
        value = F.coalesce(F.col(c).cast("string"), F.lit(""))
        return F.when(value < F.lit(values[0][0]), F.lit(0)).otherwise(rank(value, values))

    ranks = [ranked(c, values) for c, values in bounds.items() if values]
    place, out = 0, F.lit(0).cast("long")
    for bit in range(bits):
        for r in reversed(ranks):
            one = F.shiftright(r, bit).bitwiseAND(F.lit(1)).cast("long")
            out = out + F.shiftleft(one, place)
            place += 1
    return out


@dataclass
class Staged:
    table: DataFrame
    rejects: DataFrame


def write_clustered(df: DataFrame, path: str, columns: Sequence[str] = INDEX_COLUMNS, lookups: Sequence[str] = LOOKUP_COLUMNS,
                    file_rows: int = FILE_ROWS) -> DataFrame:
    """The table by year, each year's files along the curve.

    Rows are range-partitioned by (year, place on the curve, row hash): the
    hash lets a place that very many rows share span several files.
    """
    have = set(df.columns)
    ranked = [c for c in columns if c in have and c != PARTITION]
    n = df.count()
    place = curve(rank_bounds(df, ranked)) if ranked and n else F.lit(0).cast("long")
    by = [PARTITION] if PARTITION in have else []
    w = df.select("*", place.alias("__place"), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).alias("__spread"))
    w = (w.repartitionByRange(max(1, -(-n // file_rows)), *by, "__place", "__spread")
         .sortWithinPartitions(*by, "__place", "__spread").drop("__place", "__spread"))
    out = w.write.mode("overwrite").option("maxRecordsPerFile", file_rows)
    for c in lookups:
        if c in have:
            out = (out.option(f"parquet.bloom.filter.enabled#{c}", "true")
                   .option(f"parquet.bloom.filter.expected.ndv#{c}", file_rows))
    (out.partitionBy(*by) if by else out).parquet(path)
    schema = df.schema if not by else df.select(*[c for c in df.columns if c not in by], *by).schema
    return df.sparkSession.read.schema(schema).parquet(path)


def load_staging(df: DataFrame, path: str, reject_path: str | None = None, ids: Sequence[str] = ("row_id",),
                 file_rows: int = FILE_ROWS) -> Staged:
    """The typed rows at ``path``, the broken rules at ``reject_path`` (``<path>_rechazos``).

    The input is read and checked once; the rejects, the ranks, the sample of
    the ranges and the table itself are passes over the checked rows.
    """
    rows = materialize(checked(df), "staging-checked")
    target = reject_path or f"{path.rstrip('/')}_rechazos"
    own = [c for c in ids if c in rows.columns]
    rejects = rejected(rows, *own)
    rejects.write.mode("overwrite").parquet(target)
    table = write_clustered(accepted(rows), path, file_rows=file_rows)
    return Staged(table, df.sparkSession.read.schema(rejects.schema).parquet(target))
