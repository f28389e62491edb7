"""Aggregations.

All aggregates are built-in, so Spark plans partial (map-side) aggregation
before the shuffle: a hot group costs one row per map task, not its size.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import _col

# --- fixed values ------------------------------------------------------------
HERD_CATEGORIES = [  # (label, stock column, deaths column), in report order
    ("Vacas", "cantivaca", "mortavaca"),
    ("Vaquillonas", "cantivaqui", "mortavaqui"),
    ("Terneros", "cantiterne", "mortaterne"),
    ("Novillos", "cantinovi", "mortanovi"),
    ("Novillitos", "cantinovilli", "mortanovilli"),
    ("Toros", "cantitoro", "mortatoro"),
    ("Bufalos", "cantibufa", "mortabufa"),
]
DESCRIBE_STATS = ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]
# -----------------------------------------------------------------------------


def count_by(df: DataFrame, *cols: str | Column, name: str = "n") -> DataFrame:
    """``COUNT(*)`` per group."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(name))


def count_mean_by(df: DataFrame, col: str | Column, metric: str, digits: int = 1,
                  count_name: str = "ddjj", mean_name: str = "pondf_prom") -> DataFrame:
    """count and ``ROUND(AVG(metric), digits)`` per group."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(count_name),
                               F.round(F.avg(metric), digits).alias(mean_name))


def histogram(df: DataFrame, col: str, lo: float = 0.0, hi: float = 100.0, bins: int = 20) -> DataFrame:
    """equal-width histogram over [lo, hi]; ``hi`` itself falls in the
    last bin.  Output: bin number (1-based), its bounds and the count."""
    width = (hi - lo) / bins
    b = F.least(F.floor((F.col(col) - F.lit(lo)) / F.lit(width)).cast("int") + 1, F.lit(bins))
    return (df.filter(F.col(col).between(lo, hi)).groupBy(b.alias("bin"))
              .agg(F.count(F.lit(1)).alias("n"))
              .select("bin", (F.lit(lo) + (F.col("bin") - 1) * width).alias("bin_lo"),
                      (F.lit(lo) + F.col("bin") * width).alias("bin_hi"), "n"))


def crop_totals(df: DataFrame, label: Column, sown: str, affected: str, decl: Column,
                approx: bool = False) -> DataFrame:
    """per crop label: two sums, row count, distinct declarations."""
    distinct = F.approx_count_distinct(decl) if approx else F.countDistinct(decl)
    return df.groupBy(label.alias("tipo_cultivo")).agg(
        F.sum(sown).alias("sembrada"), F.sum(affected).alias("afectada"),
        F.count(F.lit(1)).alias("registros"), distinct.alias("ddjj"))


def herd_totals(df: DataFrame, label: Column) -> DataFrame:
    """stock and deaths per (coalesced) category."""
    return df.groupBy(label.alias("categoria")).agg(F.sum("existencias").alias("existencias"),
                                                   F.sum("mortandad").alias("mortandad"))


def herd_totals_wide(df: DataFrame, categories=HERD_CATEGORIES) -> DataFrame:
    """The 7-branch UNION ALL of the reference in ONE scan: 14 sums in
    a single aggregate, then ``stack`` into 7 (category, stock, deaths) rows."""
    sums = []
    for i, (_, stock, deaths) in enumerate(categories):
        sums += [F.sum(stock).alias(f"s{i}"), F.sum(deaths).alias(f"d{i}")]
    wide = df.agg(*sums)
    args = ", ".join(f"'{label}', s{i}, d{i}" for i, (label, _, _) in enumerate(categories))
    return wide.selectExpr(f"stack({len(categories)}, {args}) AS (categoria, existencias, mortandad)")


def size_by(df: DataFrame, *cols: str, name: str = "filas") -> DataFrame:
    """group sizes, the null group included (pandas ``dropna=False``)."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(name))


def files_rows_by(df: DataFrame, *cols: str, file_col: str = "source_file") -> DataFrame:
    """distinct files and rows per group."""
    return df.groupBy(*cols).agg(F.countDistinct(file_col).alias("archivos"), F.count(F.lit(1)).alias("filas"))


def null_counts(df: DataFrame, name_col: str = "columna", value_col: str = "cantidad_nulos") -> DataFrame:
    """nulls per column in one pass, returned in long form."""
    wide = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)])
    args = ", ".join(f"'{c}', n{i}" for i, c in enumerate(df.columns))
    return wide.selectExpr(f"stack({len(df.columns)}, {args}) AS ({name_col}, {value_col})")


SKETCH = 100_000
"""Accuracy of the quantile sketch: its ranks are wrong by less than rows / SKETCH."""

WIDTHS = (3.0 / SKETCH, 3e-4, 3e-3, 3e-2, 1.0)
"""Brackets around a wanted share: the narrowest that holds the sketch's error and two rows more."""

_BASICS = (("n", F.count), ("a", F.avg), ("d", F.stddev_samp), ("i", F.min), ("x", F.max))


def _as_double(c: str) -> Column:
    return F.col(f"`{c}`").cast("double")


def _summary(df: DataFrame, cols: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """One row, one scan: per column j its basic statistics (n, a, d, i, x) and,
    per share i, values f and t that have the wanted rank between them (from a
    mergeable sketch)."""
    ends = [e for p in shares for w in WIDTHS for e in (max(0.0, p - w), min(1.0, p + w))]
    wide = df.agg(*[f(_as_double(c)).alias(f"{name}{j}") for j, c in enumerate(cols) for name, f in _BASICS],
                  *[F.percentile_approx(_as_double(c), ends, SKETCH).alias(f"s{j}") for j, c in enumerate(cols)])

    def end(j: int, i: int, side: int) -> Column:
        level = F.lit(len(WIDTHS) - 1)
        for k in reversed(range(len(WIDTHS) - 1)):
            level = F.when(F.col(f"n{j}") * (WIDTHS[k] - 1.0 / SKETCH) >= 2, F.lit(k)).otherwise(level)
        return F.get(f"s{j}", 2 * (i * len(WIDTHS) + level) + side)

    return wide.select(*[f"{name}{j}" for j in range(len(cols)) for name, _ in _BASICS], *[
        end(j, i, k).alias(f"{side}{j}_{i}") for j in range(len(cols)) for i in range(len(shares))
        for k, side in enumerate("ft")])


def _ranked_quantiles(df: DataFrame, cols: Sequence[str], shares: Sequence[float]) -> tuple[DataFrame, DataFrame]:
    """(variable, q0, q1, ...) and one row with all of :func:`_summary`.

    Both read the summary through one exchange: three scans of ``df`` in all.
    """
    one = F.broadcast(_summary(df, cols, shares))  # one row
    rows = df.select(*[_as_double(c).alias(f"v{j}") for j, c in enumerate(cols)]).crossJoin(one)
    cells = [(j, i, F.col(f"v{j}"), F.col(f"f{j}_{i}"), F.col(f"t{j}_{i}"))
             for j in range(len(cols)) for i in range(len(shares))]
    known = [f"{name}{j}" for j in range(len(cols)) for name, _ in _BASICS]
    whole = rows.agg(*[F.count_if(v < lo).alias(f"b{j}_{i}") for j, i, v, lo, _ in cells],
                     *[F.first(c).alias(c) for c in known])
    spelled = ", ".join(f"{j}, {i}, n{j}, b{j}_{i}" for j, i, *_ in cells)
    facts = whole.selectExpr(f"stack({len(cells)}, {spelled}) AS (col, share, rows, below)")
    hit = {(j, i): (v >= lo) & (v <= hi) for j, i, v, lo, hi in cells}
    near = F.array_compact(F.array(*[F.when(hit[j, i], F.struct(
        F.lit(j).alias("col"), F.lit(i).alias("share"), v.alias("valor"))) for j, i, v, _, _ in cells]))
    inside = (rows.filter(reduce(lambda x, y: x | y, hit.values())).select(F.explode(near).alias("x"))
              .groupBy("x.col", "x.share", "x.valor").agg(F.count(F.lit(1)).alias("n")))
    # one bracket holds a few of SKETCH parts of the rows, each distinct value once
    order = Window.partitionBy("col", "share").orderBy("valor").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (inside.withColumn("upto", F.sum("n").over(order)).join(F.broadcast(facts), ["col", "share"])
              .withColumn("last", F.col("below") + F.col("upto") - 1).withColumn("first", F.col("last") - F.col("n") + 1))
    place = (F.col("rows") - 1) * F.element_at(F.array(*(F.lit(float(p)) for p in shares)), F.col("share") + 1)

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("first") <= rank) & (rank <= F.col("last")), F.col("valor")))

    lo, hi = at(F.floor(place)), at(F.ceil(place))
    exact = ranked.groupBy("col", "share").agg(lo.alias("lo"), hi.alias("hi"), F.max(place - F.floor(place)).alias("w"))
    value = F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("w")
    names = F.element_at(F.array(*(F.lit(c) for c in cols)), F.col("col") + 1)
    return exact.groupBy(names.alias("variable")).agg(
        *[F.max(F.when(F.col("share") == i, value)).alias(f"q{i}") for i in range(len(shares))]), whole


def exact_quantiles(df: DataFrame, cols: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """One row per column: ``variable`` and the exact linear quantiles ``q0``,
    ``q1``, ...; no task sees a whole column.

    A mergeable sketch brackets every wanted rank between two values; rows
    below a bracket are counted, and only the values inside are ranked: a few
    of ``SKETCH`` parts of the rows, each distinct value once, however close
    they are to each other.  NaN is the largest value.
    """
    return _ranked_quantiles(df, cols, shares)[0]


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """pandas ``describe()``: count, mean, sample std, min, linear
    quartiles (exact), max."""
    shares = (0.25, 0.5, 0.75)
    quartiles, whole = _ranked_quantiles(df, cols, shares)
    spelled = ", ".join(f"'{c}', CAST(coalesce(n{j}, 0) AS DOUBLE), a{j}, d{j}, i{j}, x{j}" for j, c in enumerate(cols))
    basic = whole.selectExpr(f"stack({len(cols)}, {spelled}) AS (variable, count, mean, std, min, max)")
    both = basic.join(F.broadcast(quartiles), "variable", "left")
    stats = dict(zip(DESCRIBE_STATS, ["count", "mean", "std", "min", "q0", "q1", "q2", "max"], strict=True))
    spelled = ", ".join(f"'{name}', {k}, {source}" for k, (name, source) in enumerate(stats.items()))
    # at most eight rows per column from here on
    long = both.selectExpr("variable", f"stack({len(stats)}, {spelled}) AS (estadistica, orden, valor)")
    return long.groupBy("estadistica", "orden").agg(
        *[F.max(F.when(F.col("variable") == c, F.col("valor"))).alias(c) for c in cols])


def py_number_text(c: Column | str) -> Column:
    """How Python prints a float such as ``12.0``: integral values as
    ``<int>.0``, others through Spark's shortest representation."""
    c = _col(c).cast("double")
    integral = (c == F.floor(c)) & (F.abs(c) < 1e16)
    return F.when(integral, F.concat(F.floor(c).cast("bigint").cast("string"), F.lit(".0"))).otherwise(c.cast("string"))


def joined_distinct(c: Column | str, numeric: bool = False, sep: str = " | ") -> Column:
    """sorted distinct values joined by ``' | '`` (an aggregate)."""
    arr = F.sort_array(F.collect_set(_col(c)))
    if numeric:
        return F.array_join(F.transform(arr, py_number_text), sep)
    return F.array_join(F.transform(arr, lambda x: x.cast("string")), sep)


def profile(df: DataFrame, table: str | None = None) -> DataFrame:
    """Rows, distinct events and files, year range, critical rows,
    null events -- only for the columns the table has.  The table is grouped
    once by event and file (combined map-side); the distinct counts then read
    those few groups, not every row once per count."""
    cols = set(df.columns)
    keys = [c for c in ("evento_id", "source_file") if c in cols]
    parts = [F.count(F.lit(1)).alias("filas")]
    folds = [F.coalesce(F.sum("filas"), F.lit(0)).alias("filas")]
    if "evento_id" in cols:
        folds += [F.countDistinct("evento_id").alias("eventos"),
                  F.coalesce(F.sum(F.when(F.col("evento_id").isNull(), F.col("filas"))), F.lit(0)).alias("evento_id_nulos")]
    if "source_file" in cols:
        folds.append(F.countDistinct("source_file").alias("source_files"))
    if "anio" in cols:
        parts += [F.min("anio").alias("anio_min"), F.max("anio").alias("anio_max")]
        folds += [F.min("anio_min").alias("anio_min"), F.max("anio_max").alias("anio_max")]
    if "severidad_maxima" in cols:
        parts.append(F.count_if(F.lower(F.coalesce(F.col("severidad_maxima"), F.lit(""))) == "critico").alias("criticos"))
        folds.append(F.coalesce(F.sum("criticos"), F.lit(0)).alias("criticos"))
    out = df.groupBy(*keys).agg(*parts).agg(*folds)
    return out.select(F.lit(table).alias("tabla"), "*") if table else out


def totals(df: DataFrame, *cols: str, how: str = "sum") -> DataFrame:
    """scalar totals (sum of each column, nulls as 0) or means."""
    fn = {"sum": lambda c: F.coalesce(F.sum(c), F.lit(0)), "avg": F.avg}[how]
    return df.agg(*[fn(c).alias(c) for c in cols])
