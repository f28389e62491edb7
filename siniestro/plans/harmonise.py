"""Harmonisation job (A7, B12): registry-driven layouts over landed sheets,
then the registry mapping and quality flags (K), then consolidation (L).

One job for all files: their cells are one table (``sources.cells``), their
layouts are joined to it as data (``plans.layouts``).  What is wrong with a
file is data, too: a workbook whose header is ambiguous, or of which a record
is cut off, ragged or not UTF-8, gets the status ``error`` with the first
problem found, gives no rows, and stops nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.consolidate import Curated, consolidate
from ..operators.quality import add_quality_flags, apply_event_mapping
from ..schema import OUTPUT_COLUMNS
from ..session import materialize, materialize_all, within_jit
from ..sources.cells import Cells, Landed, all_flaws, cells_of, read_cells
from .layouts import LAYOUTS, harmonise_rows, picks, select_sheets, sheet_rows

# --- fixed values: per-file status ------------------------------------------------
STATUS_OK = "ok"
STATUS_UNKNOWN_LAYOUT = "formato_no_implementado"
STATUS_MISSING = "archivo_no_encontrado"
STATUS_ERROR = "error"
# -----------------------------------------------------------------------------------


@dataclass
class Harmonised:
    clean: DataFrame
    status: DataFrame


def chosen_sheets(sheets: Sequence[Landed], formats: Sequence[tuple[str, str]]) -> tuple[list, list]:
    """What the registry says of the listing, metadata only: the sheets to read
    as (number in the listing, sheet, layout), and each file's status so far."""
    by_file: dict[str, list[int]] = {}
    for number, s in enumerate(sheets):
        by_file.setdefault(s.source_file, []).append(number)
    chosen, status = [], []
    for archivo, formato in formats:
        if formato not in LAYOUTS:
            status.append((archivo, formato, STATUS_UNKNOWN_LAYOUT, None))
            continue
        if archivo not in by_file:
            status.append((archivo, formato, STATUS_MISSING, archivo))
            continue
        wanted = select_sheets(LAYOUTS[formato], [sheets[n] for n in by_file[archivo]])
        if not wanted:
            status.append((archivo, formato, STATUS_ERROR, "FileNotFoundError: no sheet to read"))
            continue
        chosen += [(n, sheets[n], formato) for n in by_file[archivo] if sheets[n] in wanted]
        status.append((archivo, formato, STATUS_OK, None))
    return chosen, status


def harmonise_cells(spark: SparkSession, cells: Cells, formats: Sequence[tuple[str, str]],
                    registry: DataFrame | None = None, written: bool = True) -> Harmonised:
    """B12 + A7: every registered file's layout over all cells at once.

    ``written=False`` leaves writing the rows to a caller that reads them
    once; the status counts those that are there."""
    within_jit(spark)
    chosen, status = chosen_sheets(cells.sheets, formats)
    sheets = sheet_rows(spark, chosen)
    first = (all_flaws(cells).join(sheets, "sheet").groupBy("source_file")
             .agg(F.min_by(F.concat(F.col("problem"), F.lit(" ("), F.col("source_sheet"), F.lit(")")), "sidx").alias("problem")))
    broken = materialize(first, "harmonise-broken")  # at most one row per file
    good = sheets.join(F.broadcast(broken), "source_file", "left_anti")
    parts = materialize(picks(cells.heads, good), "harmonise-parts")
    clean = harmonise_rows(cells, parts)
    if registry is not None:
        clean = add_quality_flags(apply_event_mapping(clean, registry))
    clean = clean.select(*OUTPUT_COLUMNS, "row_id")
    if written:
        clean = materialize(clean, "harmonised")
    counts = clean.groupBy(F.col("source_file").alias("archivo")).agg(F.count(F.lit(1)).alias("n"))
    known = spark.createDataFrame(status, "archivo string, formato string, estado string, error string")
    bad = F.col("problem").isNotNull() & (F.col("estado") == STATUS_OK)
    st = (known.join(broken.withColumnRenamed("source_file", "archivo"), "archivo", "left").join(counts, "archivo", "left")
          .withColumns({"error": F.when(bad, F.col("problem")).otherwise(F.col("error")),
                        "estado": F.when(bad, F.lit(STATUS_ERROR)).otherwise(F.col("estado"))})
          .withColumn("filas", F.when(F.col("estado") == STATUS_OK, F.coalesce("n", F.lit(0))).otherwise(F.lit(0)).cast("long"))
          .select("archivo", "formato", "estado", "filas", "error"))
    return Harmonised(clean, st)


def harmonise(spark: SparkSession, workbooks: Mapping[str, Sequence], formats: Sequence[tuple[str, str]],
              registry: DataFrame | None = None, written: bool = True) -> Harmonised:
    """:func:`harmonise_cells` over sheets that are frames."""
    return harmonise_cells(spark, cells_of(spark, workbooks), formats, registry, written)


def harmonise_landing(spark: SparkSession, path: str, formats: Sequence[tuple[str, str]],
                      registry: DataFrame | None = None, written: bool = True) -> Harmonised:
    """:func:`harmonise_cells` over the landing zone: one scan of the files that the registry wants."""
    from ..sources.landing import list_sheets
    sheets = list_sheets(spark, path)
    wanted = {n for n, _, _ in chosen_sheets(sheets, formats)[0]}
    few = [s if n in wanted else Landed(s.source_file, s.source_sheet, s.file_ordinal, s.sheet_ordinal)
           for n, s in enumerate(sheets)]
    return harmonise_cells(spark, read_cells(spark, few), formats, registry, written)


def harmonise_workbook(spark: SparkSession, layout_name: str, sheets: Sequence) -> DataFrame:
    """B12 for one workbook of frames: its layout over the sheets it reads, not written yet."""
    within_jit(spark)
    cells = cells_of(spark, {sheets[0].source_file: sheets})
    chosen, status = chosen_sheets(cells.sheets, [(sheets[0].source_file, layout_name)])
    if status[0][2] != STATUS_OK:
        raise FileNotFoundError(status[0][3])
    return harmonise_rows(cells, materialize(picks(cells.heads, sheet_rows(spark, chosen)), "harmonise-parts"))


def run_pipeline(spark: SparkSession, landing: str, formats: Sequence[tuple[str, str]],
                 registry: DataFrame) -> tuple[Harmonised, Curated]:
    """Stages 01-03 as one job from the landing zone: harmonise (written to
    the shared checkpoint folder), then consolidate from it with every curated
    table staged the same way."""
    h = harmonise_landing(spark, landing, formats, registry)
    return h, consolidate(h.clean, registry, stage_many=lambda frames: materialize_all(frames, "curated"))
