"""Landing zone: delivered sheets as CSV files, registries, writers.

Layout on disk: ``<landing>/<source_file>/<source_sheet>.csv`` (header in the
first line, all values read as text); the ``.csv`` may also be a folder of
parts, each with the header.  A prefix ``<number>__`` before the sheet's name
is its place in the workbook; without one the sheets go by name.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .cells import Landed

# --- fixed values ------------------------------------------------------------
WORKBOOK_EXTENSIONS = ("xlsx", "xls", "xlsm")
LOCK_PREFIX = "~$"
# Tables of a delivered snapshot that stay out of the lake.
DEFAULT_EXCLUDED_TABLES = (
    "ddjj_personas_temp",
    "productos_bkp",
    "AnalisisOvinos",
    "usuarios_notix",
    "menu_admin",
    "submenu_admin",
    "permisos_admin",
    "permisos_submenu_admin",
)
# -----------------------------------------------------------------------------


def list_files(spark: SparkSession, path: str, extensions: Sequence[str]) -> DataFrame:
    """A1: files under ``path`` with one of ``extensions`` (case-insensitive),
    lock files (``~$``) skipped, sorted.  The ``binaryFile`` source lists
    files without reading their content when ``content`` is not selected."""
    pattern = "(?i)\\.(" + "|".join(extensions) + ")$"
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
             .select("path", "length", "modificationTime"))
    name = F.regexp_extract("path", "([^/]+)$", 1)
    return files.filter(F.col("path").rlike(pattern) & ~name.startswith(LOCK_PREFIX)).withColumn("nombre", name).orderBy("path")


def list_workbooks(spark: SparkSession, path: str) -> DataFrame:
    """A1 for delivered workbooks."""
    return list_files(spark, path, WORKBOOK_EXTENSIONS)


def list_landing(spark: SparkSession, path: str) -> DataFrame:
    """A1 for landed sheets: one row per CSV file with its workbook, sheet and
    the sheet's place (null where the name has none)."""
    f = list_files(spark, path, ("csv",))
    parts = F.regexp_extract("path", r"(?i)([^/]+)/([^/]+)\.csv(?:/[^/]+)?$", 1)
    sheet = F.regexp_extract("path", r"(?i)([^/]+)/([^/]+)\.csv(?:/[^/]+)?$", 2)
    place = F.regexp_extract(sheet, r"^(\d+)__", 1)
    return f.select("path", parts.alias("source_file"), F.regexp_replace(sheet, r"^\d+__", "").alias("source_sheet"),
                    F.when(place != "", place.cast("int")).alias("orden"), "length")


@dataclass
class Sheet:
    """One sheet as a frame: string columns with the raw header, plus the
    ``__row`` ordinal (0-based, file order)."""
    source_file: str
    source_sheet: str
    frame: DataFrame
    file_ordinal: int = 0
    sheet_ordinal: int = 0


def list_sheets(spark: SparkSession, path: str) -> list[Landed]:
    """A1: every landed sheet by workbook and place.  Only the listing reaches
    the driver; headers stay with the rows (``cells``)."""
    by_sheet: dict[tuple[str, str], list] = {}
    for r in list_landing(spark, path).collect():
        by_sheet.setdefault((r["source_file"], r["source_sheet"]), []).append((r["path"], r["orden"]))
    files = {f: i for i, f in enumerate(sorted({f for f, _ in by_sheet}))}
    out, seen = [], dict.fromkeys(files, 0)
    order = sorted(by_sheet, key=lambda k: (k[0], by_sheet[k][0][1] is None, by_sheet[k][0][1] or 0, k[1]))
    for f, sheet in order:
        out.append(Landed(f, sheet, files[f], seen[f], sorted(p for p, _ in by_sheet[f, sheet])))
        seen[f] += 1
    return out


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    """A3: one landed sheet, all columns text, plus its 0-based row ordinal.
    ``multiLine`` keeps each file in one split, so row order is file order."""
    df = (spark.read.option("header", True).option("multiLine", True).option("encoding", "UTF-8")
          .option("nullValue", "").option("inferSchema", False).option("escape", '"').csv(path))
    return df.withColumn("__row", F.monotonically_increasing_id())


def read_landing(spark: SparkSession, path: str) -> dict[str, list[Sheet]]:
    """A3: every landed sheet as a frame of its own, by workbook, in the
    workbook's order; jobs over all sheets read ``cells`` instead."""
    out: dict[str, list[Sheet]] = {}
    for s in list_sheets(spark, path):
        source = s.paths if len(s.paths) > 1 else s.paths[0]
        out.setdefault(s.source_file, []).append(
            Sheet(s.source_file, s.source_sheet, read_sheet(spark, source), s.file_ordinal, s.sheet_ordinal))
    return out


def read_registry(spark: SparkSession, path: str, required: Sequence[str]) -> DataFrame:
    """Registry CSV (UTF-8, possibly with a byte-order mark) with a
    required-column check."""
    df = spark.read.option("header", True).option("encoding", "UTF-8").option("escape", '"').csv(path)
    df = df.toDF(*[c.lstrip("﻿") for c in df.columns])
    missing = set(required) - set(df.columns)
    if missing:
        raise ValueError(f"registry lacks columns: {sorted(missing)}")
    return df


def read_curated(spark: SparkSession, path: str, schema) -> DataFrame:
    """A5: curated CSV read with an explicit schema (codes stay text)."""
    return spark.read.schema(schema).option("header", True).option("nullValue", "").option("escape", '"').csv(path)


def write_csv(df: DataFrame, path: str, encoding: str = "UTF-8") -> None:
    """CSV with header (the byte-order mark is an Excel nicety, dropped)."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').option("encoding", encoding).csv(path)


def write_report(frames: Mapping[str, DataFrame], path: str, fmt: str = "parquet") -> None:
    """A multi-sheet report: one directory per entry."""
    for name, df in frames.items():
        df.write.mode("overwrite").format(fmt).option("header", True).option("escape", '"').save(os.path.join(path, name))


def select_tables(names: Sequence[str], drop: Sequence[str] = DEFAULT_EXCLUDED_TABLES, keep: Sequence[str] = ()) -> list[str]:
    """Tables of a snapshot that enter the lake (case-insensitive
    exclusion list with explicit keep overrides)."""
    dropped = {d.lower() for d in drop} - {k.lower() for k in keep}
    return [n for n in names if n.lower() not in dropped]


def snapshot_tables(source: Mapping[str, DataFrame], dest_path: str, tables: Sequence[str],
                    allowed: Sequence[str] | None = None, at_once: int = 8) -> list[dict]:
    """Copy tables (zero dates repaired; protected names and names
    outside the allow-list refused), a few at a time; a failing table never
    stops the others, its error is in the result."""
    from ..functions.dates import repair_zero_dates
    from ..plans.validate import CURRENT_TABLES, is_protected
    allowed = set(CURRENT_TABLES if allowed is None else allowed)

    def copy(t: str) -> dict:
        try:
            if is_protected(t):
                raise ValueError(f"protected name: {t}")
            if t not in allowed:
                raise ValueError(f"not on the allow-list: {t}")
            if t not in source:
                raise ValueError(f"no such table: {t}")
            repair_zero_dates(source[t]).write.mode("overwrite").parquet(os.path.join(dest_path, t))
            return {"tabla": t, "error": None}
        except Exception as exc:  # noqa: BLE001 -- reported per table
            return {"tabla": t, "error": f"{type(exc).__name__}: {exc}"}

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        return list(pool.map(copy, tables))


def copy_errors(spark: SparkSession, results: Sequence[dict]) -> DataFrame:
    """The tables that were not copied, and why."""
    return spark.createDataFrame([(r["tabla"], r["error"]) for r in results if r["error"]], "tabla string, error string")


def export_csv(df: DataFrame, path: str) -> None:
    """Export a listing as CSV, as many files as it has partitions.  A
    listing that ends in a top-N (``LIMIT``) has one partition, hence one
    file; an unlimited one is written in parallel."""
    write_csv(df, path)
