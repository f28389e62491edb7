"""Landed sheets as cells: one scan of all files, headers as data.

Whatever a sheet's header, its rows are (part, sheet, row, array of cells); a
part is one CSV file, its first record the header.  So 500 sheets with 500
headers are one scan of one shape, and layouts meet them by joins with small
tables (see ``plans.harmonise``).

Nothing a file holds stops the job.  The reader keeps the raw text of each
record beside its cells; from it every record says how many cells it has,
whether a quote was never closed and whether its bytes were UTF-8.  What is
wrong is a row of ``flaws``, never an exception.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import fold_accents, strip_ws
from ..session import materialize

MAX_CELLS = 255
PREVIEW_ROWS = 15
_HEADS = "part int, sheet int, cells array<string>"
_FLAWS = "sheet int, row long, problem string"
# rows of the listing: one per sheet or file, which the driver's own listing holds already
_LISTED = "key string, part int, sheet int"


@dataclass
class Landed:
    """One sheet of the listing: its place and, if landed, its files in order."""
    source_file: str
    source_sheet: str
    file_ordinal: int
    sheet_ordinal: int
    paths: Sequence[str] = ()


@dataclass
class Cells:
    """``sheets`` by number; ``heads`` (part, sheet, cells): the headers;
    ``rows`` (part, sheet, row, cells): the data, ``row`` counts from 0 in a
    sheet; ``flaws`` (sheet, row, problem): the first problem of each sheet."""
    sheets: Sequence[Landed]
    heads: DataFrame
    rows: DataFrame
    flaws: DataFrame


def plain_path(path: str) -> str:
    """A file's path without scheme and percent signs, as a key."""
    from urllib.parse import unquote
    return unquote(path.split(":", 1)[-1]).lstrip("/")


def _path_key() -> Column:
    path = F.replace(F.regexp_replace("_metadata.file_path", "^[^:]*:", ""), F.lit("+"), F.lit("%2B"))
    return F.ltrim(F.url_decode(path), F.lit("/"))


# Behind its comma: a cell that begins with a quote goes to the closing one, commas and line ends included; any other
# to the next comma.
QUOTED = r'"[^"]*+(?:""[^"]*+)*+"'
A_CELL = f",({QUOTED}[^,]*+|[^,]*+)"


def _unquoted(raw: Column) -> Column:
    """A cell's text; one with more than spaces behind its closing quote is taken as it stands."""
    cell = F.rtrim(raw)
    return F.when(cell.rlike(rf"\A{QUOTED}\z"), F.replace(
        F.substring(cell, F.lit(2), F.length(cell) - 2), F.lit('""'), F.lit('"'))).otherwise(raw)


def split_record(record: Column) -> Column:
    """The cells of one record's text; empty ones are null."""
    quoted = F.transform(F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(A_CELL), F.lit(1)), _unquoted)
    cells = F.when(F.contains(record, F.lit('"')), quoted).otherwise(F.split(record, ",", -1))
    return F.transform(cells, lambda c: F.when(c != "", c))


def _records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(key, id, cells, width, open, garbled) of every record; the plan does not know any header.

    A record never has as many cells as the schema, so the reader keeps its
    text in ``record``; one that has is too wide (``width`` null).  Cells are
    split from that text: the reader takes an error's time for each column of
    its schema that a record lacks, so only the first is asked of it.
    """
    names = [f"c{i}" for i in range(MAX_CELLS + 1)]
    raw = (spark.read.schema(", ".join(f"{n} string" for n in [*names, "record"])).option("header", False)
           .option("multiLine", True).option("encoding", "UTF-8").option("nullValue", "").option("escape", '"')
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "record")
           .option("ignoreMissingFiles", True).csv(list(paths)))
    some = raw.select(_path_key().alias("key"), F.monotonically_increasing_id().alias("id"), "c0", "record")
    bare = F.when(F.contains("record", F.lit('"')), F.regexp_replace("record", '"[^"]*"', "")).otherwise(F.col("record"))
    some = some.withColumn("bare", bare)
    width = F.length("bare") - F.length(F.replace("bare", F.lit(","), F.lit(""))) + 1
    return (some.withColumn("width", F.when(width <= MAX_CELLS, width))
            # more cells than the schema has: the file has an error, its cells are not read
            .withColumn("cells", F.when(F.col("width").isNull(), F.array("c0")).otherwise(split_record(F.col("record"))))
            .select("key", "id", F.slice("cells", F.lit(1), F.coalesce("width", F.lit(MAX_CELLS))).alias("cells"), "width",
                    F.coalesce(F.col("bare").rlike('(^|,)"'), F.lit(False)).alias("open"),
                    F.coalesce(F.contains("record", F.lit("\ufffd")), F.lit(False)).alias("garbled")))


def read_cells(spark: SparkSession, sheets: Sequence[Landed]) -> Cells:
    """All files of ``sheets`` by one scan, written once.

    A multi-line file is read by one task, so its records have consecutive
    ids; a row's number is its distance from the file's header plus the rows
    of the sheet's files before it.  No task holds a sheet and the driver
    reads no row.
    """
    listed = [(plain_path(p), p, s) for s, sheet in enumerate(sheets) for p in sheet.paths]
    if not listed:
        return Cells(sheets, spark.createDataFrame([], _HEADS),
                     spark.createDataFrame([], "part int, sheet int, row long, cells array<string>"),
                     spark.createDataFrame([], _FLAWS))
    places = F.broadcast(spark.createDataFrame([(key, i, s) for i, (key, _, s) in enumerate(listed)], _LISTED))
    table = materialize(_records(spark, [path for _, path, _ in listed]).join(places, "key").drop("key"), "cells")
    before = Window.partitionBy("sheet").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (table.groupBy("part", "sheet").agg(
                  F.min("id").alias("first"), F.count(F.lit(1)).alias("n"), F.min_by("width", "id").alias("cols"))
              .withColumn("before", F.coalesce(F.sum(F.col("n") - 1).over(before), F.lit(0)))
              .select("part", "first", "cols", "before"))
    # one row per file of the listing
    numbered = table.join(F.broadcast(materialize(firsts, "cell-parts")), "part").withColumn(
        "row", F.col("id") - F.col("first") - 1 + F.col("before"))
    where = F.concat(F.lit(": row "), (F.col("row") + 2).cast("string"), F.lit(": "))
    problem = (F.when(F.col("garbled"), F.concat(F.lit("EncodingError"), where, F.lit("not UTF-8")))
               .when(F.col("width").isNull(), F.concat(F.lit("TooWide"), where, F.lit(f"more than {MAX_CELLS} cells")))
               .when(F.col("open"), F.concat(F.lit("TruncatedRecord"), where, F.lit("a quote is never closed")))
               .when(~F.col("width").eqNullSafe(F.col("cols")), F.concat(
                   F.lit("RaggedRecord"), where, F.col("width").cast("string"), F.lit(" cells, the header has "),
                   F.col("cols").cast("string"))))
    flaws = (numbered.select("sheet", "row", problem.alias("problem")).filter("problem is not null")
             .groupBy("sheet").agg(F.min("row").alias("row"), F.min_by("problem", "row").alias("problem")))
    heads = numbered.filter("id = first").select("part", "sheet", "cells")
    # the byte-order mark is no part of the first header
    heads = heads.withColumn("cells", F.transform("cells", lambda c: F.ltrim(c, F.lit("﻿"))))
    rows = numbered.filter("id > first").select("part", "sheet", "row", "cells")
    return Cells(sheets, heads, rows, flaws)


def cells_of(spark: SparkSession, workbooks: Mapping[str, Sequence]) -> Cells:
    """Sheets that are frames (raw header, text columns and ``__row``) as cells."""
    from ..operators.setops import union_all
    sheets, heads, frames = [], [], []
    for group in workbooks.values():
        for s in group:
            header = [c for c in s.frame.columns if c != "__row"]
            number = len(sheets)
            sheets.append(Landed(s.source_file, s.source_sheet, s.file_ordinal, s.sheet_ordinal))
            heads.append((number, number, header))
            frames.append(s.frame.select(
                F.lit(number).alias("part"), F.lit(number).alias("sheet"), F.col("__row").cast("long").alias("row"),
                F.array(*(F.col(f"`{c}`").cast("string") for c in header)).alias("cells")))
    rows = union_all(frames) if frames else spark.createDataFrame([], "part int, sheet int, row long, cells array<string>")
    return Cells(sheets, spark.createDataFrame(heads, _HEADS), rows, spark.createDataFrame([], _FLAWS))


def header_names(heads: DataFrame) -> DataFrame:
    """(part, sheet, pos, name): normalised header cells (C5); blank ones have no name and are left out.

    A raw name that repeats is numbered (``A``, ``A.1``) before it is
    normalised, as the source's reader does.
    """
    cell = F.col("cell").cast("string")
    raw = (heads.select("part", "sheet", F.posexplode("cells").alias("pos", "cell"))
           .filter(F.coalesce(strip_ws(cell), F.lit("")) != ""))
    nth = F.row_number().over(Window.partitionBy("part", "cell").orderBy("pos"))
    named = raw.withColumn("nth", nth).withColumn(
        "raw", F.when(F.col("nth") > 1, F.concat("cell", F.lit("."), (F.col("nth") - 1).cast("string"))).otherwise(cell))
    folded = F.regexp_replace(fold_accents(F.upper(strip_ws("raw"))), "[^A-Z0-9]+", "_")
    return named.select("part", "sheet", "pos", F.btrim(folded, F.lit("_")).alias("name")).filter("name <> ''")


def header_flaws(heads: DataFrame) -> DataFrame:
    """(sheet, row, problem) of sheets whose header has two columns of one normalised name."""
    twice = header_names(heads).groupBy("sheet", "part", "name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    names = F.array_join(F.sort_array(F.collect_set("name")), "', '")  # of one header
    return twice.groupBy("sheet").agg(F.concat(
        F.lit("HeaderError: duplicate normalised headers: ['"), names, F.lit("']")).alias("problem")).select(
        "sheet", F.lit(-1).cast("long").alias("row"), "problem")


def all_flaws(cells: Cells) -> DataFrame:
    """(sheet, problem): the first problem of each sheet that has one."""
    both = cells.flaws.unionByName(header_flaws(cells.heads))
    return both.groupBy("sheet").agg(F.min_by("problem", "row").alias("problem"))


def listing_frame(spark: SparkSession, sheets: Sequence[Landed]) -> DataFrame:
    return spark.createDataFrame([(i, s.source_file, s.source_sheet) for i, s in enumerate(sheets)],
                                 "sheet int, archivo string, hoja string")


def inventory(spark: SparkSession, cells: Cells) -> DataFrame:
    """A2: per sheet its rows, columns, header joined by `` | ``, the first 15
    rows as text (bounded preview) and its problem, if any, as data.  One
    aggregate over all sheets."""
    line = F.concat_ws(" | ", F.transform("cells", lambda c: F.coalesce(c, F.lit(""))))
    early = F.when(F.col("row") < PREVIEW_ROWS, F.struct("row", line.alias("t")))
    counts = cells.rows.groupBy("sheet").agg(
        F.count(F.lit(1)).alias("filas"),
        F.array_join(F.transform(F.sort_array(F.collect_list(early)), lambda x: x["t"]), "\n").alias("vista_previa"))
    heads = cells.heads.groupBy("sheet").agg(F.min_by("cells", "part").alias("cells")).select(
        "sheet", F.size("cells").alias("columnas"),
        F.concat_ws(" | ", F.transform("cells", lambda c: F.coalesce(c, F.lit("")))).alias("encabezado"))
    return (listing_frame(spark, cells.sheets).join(counts, "sheet", "left").join(heads, "sheet", "left")
            .join(all_flaws(cells), "sheet", "left")
            .select("archivo", "hoja", F.coalesce("filas", F.lit(0).cast("long")).alias("filas"),
                    F.coalesce("columnas", F.lit(0)).alias("columnas"), F.coalesce("encabezado", F.lit("")).alias("encabezado"),
                    F.coalesce("vista_previa", F.lit("")).alias("vista_previa"), F.col("problem").alias("error")))
