"""Event consolidation.

Rows of one event that come from several files are deduplicated on a key:
same-level files on code (or an alternative identity), principal files on
the declaration id, agricultural detail on (event, id, species, category).
Every dedup is an aggregate (``keep_best``), every duplicate listing a
pre-aggregated count joined back, so hot keys (T4: all rows without any
identity share one key per event) never land whole in one task.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.misc import coalesce_event, ensure_columns
from ..functions.text import normalize_code, normalize_key
from ..schema import CONFLICT_COLUMNS, OUTPUT_TYPES
from .aggregates import py_number_text, size_by, files_rows_by
from .filters import role_is
from .joins import attach_registry
from .setops import drop_exact, melt
from .windows import duplicate_members, keep_best

# --- fixed values ------------------------------------------------------------
SAME_LEVEL_RELATIONS = ("consolidate_same_level", "standalone")
COMPLEMENTARY = "complementary_detail"
ROLE_PRINCIPAL, ROLE_DETAIL = "principal", "detalle_agricola"
DEFAULT_ROLE, DEFAULT_RELATION = "desconocido", "standalone"
ALT_SAME_LEVEL_KEY_COLUMNS = ["documento_nro", "productor_nombre", "departamento", "actividad", "cultivo"]
PRINCIPAL_ALT_KEY_COLUMNS = ["documento_nro", "productor_nombre", "departamento"]
DETAIL_KEY_COLUMNS = ["evento_id", "iddj", "especie", "categoria"]
REGISTRY_COLUMNS = ["source_file", "evento_id", "dataset_role", "relation_type", "evento_nombre",
                    "anio_inicio", "anio_fin", "prioridad", "comentario"]
# -----------------------------------------------------------------------------


def load_inputs(raw: DataFrame, registry: DataFrame) -> DataFrame:
    """L1: attach event metadata.  The event id is refreshed from the
    registry (registry -> row -> period, C11); role and relation keep the
    values written by the harmonisation step (T11), defaulting to
    ``desconocido`` / ``standalone``; name defaults to the event id and
    priority to 0.  ``sin_event_mapping`` flags files absent from the
    registry."""
    missing = set(REGISTRY_COLUMNS) - set(registry.columns)
    if missing:
        raise ValueError(f"registry lacks columns: {sorted(missing)}")
    raw = ensure_columns(raw, OUTPUT_TYPES)
    reg = registry.select("source_file", F.col("evento_id").alias("__ev_map"), "evento_nombre",
                          "anio_inicio", "anio_fin", "prioridad", "comentario")
    df = attach_registry(raw, reg, indicator="sin_event_mapping")
    return (df.withColumn("evento_id", coalesce_event(F.col("__ev_map"), F.col("evento_id"), F.col("periodo")))
              .withColumn("dataset_role", F.coalesce(F.col("dataset_role"), F.lit(DEFAULT_ROLE)))
              .withColumn("relation_type", F.coalesce(F.col("relation_type"), F.lit(DEFAULT_RELATION)))
              .withColumn("evento_nombre", F.coalesce(F.col("evento_nombre"), F.col("evento_id")))
              .withColumn("prioridad", F.coalesce(F.col("prioridad").cast("string").try_cast("double"), F.lit(0.0)))
              .drop("__ev_map"))


def _normalised(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
    """Add normalised key parts as columns first, so each part is computed
    once per row; the keys are then composed from these columns."""
    return df.withColumns(cols)


def _alt_key(cols: list[str]) -> Column:
    # only evaluated on rows without a code (CASE branches are lazy)
    return F.concat_ws("|", *[normalize_key(c) for c in cols])


def _same_level_columns(strip_float_suffix: bool, at: str = "") -> tuple[dict[str, Column], dict[str, Column]]:
    has = F.col(f"{at}codigo_norm") != ""
    return ({f"{at}evento_id_norm": normalize_key("evento_id"), f"{at}codigo_norm": normalize_code("codigo", strip_float_suffix)},
            {f"{at}dedup_key_type": F.when(has, "codigo").otherwise("alternativa"),
             f"{at}dedup_key": F.concat(F.col(f"{at}evento_id_norm"), F.lit("||"),
                                        F.when(has, F.concat(F.lit("CODIGO||"), F.col(f"{at}codigo_norm")))
                                         .otherwise(F.concat(F.lit("ALTERNATIVA||"), _alt_key(ALT_SAME_LEVEL_KEY_COLUMNS))))})


def _principal_columns(strip_float_suffix: bool, at: str = "") -> tuple[dict[str, Column], dict[str, Column]]:
    has = F.col(f"{at}iddj_norm") != ""
    return ({f"{at}evento_id_norm": normalize_key("evento_id"), f"{at}iddj_norm": normalize_code("iddj", strip_float_suffix)},
            {f"{at}principal_key_type": F.when(has, "iddj").otherwise("alternativa"),
             f"{at}principal_key": F.concat(F.col(f"{at}evento_id_norm"), F.lit("||"),
                                            F.when(has, F.concat(F.lit("IDDJ||"), F.col(f"{at}iddj_norm")))
                                             .otherwise(F.concat(F.lit("ALTERNATIVA||"), _alt_key(PRINCIPAL_ALT_KEY_COLUMNS))))})


def _detail_columns(strip_float_suffix: bool, at: str = "") -> tuple[dict[str, Column], dict[str, Column]]:
    parts = ["evento_id_norm", "iddj_norm", "especie_norm", "categoria_norm"]
    return ({f"{at}evento_id_norm": normalize_key("evento_id"), f"{at}iddj_norm": normalize_code("iddj", strip_float_suffix),
             f"{at}especie_norm": normalize_key("especie"), f"{at}categoria_norm": normalize_key("categoria")},
            {f"{at}detalle_key": F.concat_ws("||", *[f"{at}{c}" for c in parts])})


def same_level_key(df: DataFrame, strip_float_suffix: bool = False) -> DataFrame:
    """L2: ``EVENT||CODIGO||code`` or ``EVENT||ALTERNATIVA||doc|name|dept|activity|crop``."""
    df = ensure_columns(df, ["codigo", "evento_id"] + ALT_SAME_LEVEL_KEY_COLUMNS)
    parts, keys = _same_level_columns(strip_float_suffix)
    return _normalised(df, parts).withColumns(keys)


def principal_key(df: DataFrame, strip_float_suffix: bool = False) -> DataFrame:
    """L3: ``EVENT||IDDJ||iddj`` or ``EVENT||ALTERNATIVA||doc|name|dept``."""
    df = ensure_columns(df, ["evento_id", "iddj"] + PRINCIPAL_ALT_KEY_COLUMNS)
    parts, keys = _principal_columns(strip_float_suffix)
    return _normalised(df, parts).withColumns(keys)


def detail_key(df: DataFrame, strip_float_suffix: bool = False) -> DataFrame:
    """L4: ``event||iddj||species||category`` (normalised parts)."""
    df = ensure_columns(df, DETAIL_KEY_COLUMNS)
    parts, keys = _detail_columns(strip_float_suffix)
    return _normalised(df, parts).withColumns(keys)


def duplicate_rows(df: DataFrame, key: str) -> DataFrame:
    """Every row whose (non-blank) key occurs more than once."""
    return duplicate_members(df.filter(F.col(key).isNotNull() & (F.col(key) != "")), [key])


def conflicts(rows: DataFrame, key: str, columns: list[str] = CONFLICT_COLUMNS) -> DataFrame:
    """Per key and numeric variable with more than one distinct value:
    event, sorted distinct values, files, priorities and group size.

    Computed from the keyed rows directly (a variable can only conflict in a
    key that occurs more than once).  Both aggregates combine map-side; the
    values are first reduced to distinct (key, variable, value) triples, so
    a hot key's list is bounded by its distinct values, not its row count."""
    present = [c for c in columns if c in rows.columns]
    rows = rows.filter(F.col(key).isNotNull() & (F.col(key) != ""))
    group = rows.groupBy(key).agg(
        F.min("evento_id").alias("evento_id"),
        F.array_join(F.sort_array(F.collect_set(F.col("source_file").cast("string"))), " | ").alias("source_files"),
        F.array_join(F.transform(F.sort_array(F.collect_set("prioridad")), py_number_text), " | ").alias("prioridades"),
        F.count(F.lit(1)).alias("cantidad_registros")).filter("cantidad_registros > 1")
    long = melt(rows.select(key, *[F.col(c).cast("double").alias(c) for c in present]), [key], present, "variable", "valor")
    values = (long.filter(F.col("valor").isNotNull()).distinct()
                  .groupBy(key, "variable")
                  .agg(F.count(F.lit(1)).alias("__n"),
                       F.array_join(F.transform(F.sort_array(F.collect_list("valor")), py_number_text), " | ")
                        .alias("valores_distintos"))
                  .filter("__n > 1").drop("__n"))
    return (values.join(group, on=key, how="inner")
                  .select("evento_id", F.col(key).alias("clave"), "variable", "valores_distintos", "source_files",
                          "prioridades", "cantidad_registros"))


def conflict_values(rows: DataFrame, key: str, columns: list[str] = CONFLICT_COLUMNS) -> DataFrame:
    """L8 in long form: one row per (key, variable, distinct value) with its
    row count, for the variables that conflict.  Nothing is gathered per
    group, so a hot key with millions of distinct values stays distributed
    (the joined-string report is built from this same reduction)."""
    present = [c for c in columns if c in rows.columns]
    rows = rows.filter(F.col(key).isNotNull() & (F.col(key) != ""))
    long = melt(rows.select(key, *[F.col(c).cast("double").alias(c) for c in present]), [key], present, "variable", "valor")
    vals = long.filter(F.col("valor").isNotNull()).groupBy(key, "variable", "valor").agg(F.count(F.lit(1)).alias("filas"))
    conflicting = vals.groupBy(key, "variable").agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").drop("__n")
    return vals.join(conflicting, [key, "variable"], "left_semi").withColumnRenamed(key, "clave")


@dataclass
class SameLevel:
    consolidated: DataFrame
    duplicates: DataFrame
    conflicts: DataFrame


Stage = Callable[[DataFrame, str], DataFrame]


def _no_stage(df: DataFrame, name: str) -> DataFrame:
    return df


def consolidate_same_level(df: DataFrame, strip_float_suffix: bool = False, keep_unidentified: bool = False,
                           stage: Stage = _no_stage) -> SameLevel:
    """Same-level and standalone rows, one per dedup key (highest
    priority, then ingest order).  T4: rows with neither code nor any
    alternative identity share one key per event and collapse to one row;
    ``keep_unidentified=True`` keeps each of them instead."""
    same = stage(same_level_rows(df, strip_float_suffix, keep_unidentified), "same_level_keyed")
    dups = duplicate_rows(same, "dedup_key")
    best = stage(keep_best(same, "dedup_key", "prioridad", "row_id"), "consolidated")
    return SameLevel(best, dups, conflicts(same, "dedup_key"))


@dataclass
class Complementary:
    principal: DataFrame
    detail: DataFrame
    dup_principal: DataFrame
    dup_detail: DataFrame


def split_complementary(df: DataFrame, strip_float_suffix: bool = False, drop_exact_rows: bool = False,
                        stage: Stage = _no_stage) -> Complementary:
    """Complementary files split by role; principal deduplicated on L3,
    agricultural detail on L4.  Rows with another role or an unknown
    relation drop out of every output, as in the reference (T12).  The
    exact-row dedup of details is a no-op there (T3); ``drop_exact_rows``
    makes it real."""
    principal, detail = complementary_rows(df, strip_float_suffix, drop_exact_rows)
    principal, detail = stage(principal, "principal_keyed"), stage(detail, "detail_keyed")
    return Complementary(
        stage(keep_best(principal, "principal_key", "prioridad", "row_id"), "principal"),
        stage(keep_best(detail, "detalle_key", "prioridad", "row_id"), "detail"),
        duplicate_rows(principal, "principal_key"),
        duplicate_rows(detail, "detalle_key"),
    )


def detail_parent_key() -> Column:
    """Parent key of a detail row, always on the id form (so a principal
    keyed on its alternative identity is always an orphan)."""
    return F.concat(F.col("evento_id_norm"), F.lit("||IDDJ||"), F.col("iddj_norm"))


def principals_without_detail(principal: DataFrame, detail: DataFrame) -> DataFrame:
    """E8 (first half)."""
    parents = detail.select(detail_parent_key().alias("__pk")).distinct()
    return principal.join(parents, on=F.col("principal_key") == F.col("__pk"), how="left_anti")


def details_without_principal(principal: DataFrame, detail: DataFrame) -> DataFrame:
    """E8 (second half)."""
    keys = principal.select(F.col("principal_key").alias("__pk")).distinct()
    return detail.join(keys, on=detail_parent_key() == F.col("__pk"), how="left_anti")


@dataclass
class RelationReports:
    files_per_event: DataFrame
    roles_per_event: DataFrame
    principals_without_detail: DataFrame
    details_without_principal: DataFrame


def relation_reports(df: DataFrame, comp: Complementary) -> RelationReports:
    """Files per event, roles per event, both orphan lists."""
    return RelationReports(
        size_by(df, "evento_id", "source_file", "dataset_role", "relation_type", name="filas_raw_clean"),
        files_rows_by(df, "evento_id", "relation_type", "dataset_role"),
        principals_without_detail(comp.principal, comp.detail),
        details_without_principal(comp.principal, comp.detail),
    )


@dataclass
class Curated:
    inputs: DataFrame
    same_level: SameLevel
    complementary: Complementary
    relations: RelationReports

    def conflict_report(self) -> dict[str, DataFrame]:
        c = self.same_level.consolidated
        return {
            "duplicados_evento": self.same_level.duplicates,
            "conflictos_valores": self.same_level.conflicts,
            "resumen_por_evento": size_by(c, "evento_id", name="filas_consolidadas"),
            "archivos_sin_evento_id": size_by(c.filter(F.col("sin_event_mapping")), "source_file", "periodo"),
        }

    def relation_report(self) -> dict[str, DataFrame]:
        r = self.relations
        return {
            "archivos_por_evento": r.files_per_event,
            "roles_por_evento": r.roles_per_event,
            "principales_sin_detalle": r.principals_without_detail,
            "detalles_sin_principal": r.details_without_principal,
            "duplicados_principal": self.complementary.dup_principal,
            "duplicados_detalle": self.complementary.dup_detail,
            "conflictos_consolidacion": self.same_level.conflicts,
        }


def _belongs(table: str) -> Column:
    """Whether a row is one of a keyed table's."""
    if table == "same_level_keyed":
        return role_is("relation_type", *SAME_LEVEL_RELATIONS)
    role = ROLE_PRINCIPAL if table == "principal_keyed" else ROLE_DETAIL
    return role_is("relation_type", COMPLEMENTARY) & role_is("dataset_role", role)


def _own_key(key: str) -> Column:
    """T4 option: a key without any identity is one of its row's own."""
    blank = F.col(key).endswith("ALTERNATIVA||||||")
    return F.when(blank, F.concat(key, F.lit("#"), F.col("row_id").cast("string"))).otherwise(F.col(key))


KEYED = {"same_level_keyed": _same_level_columns, "principal_keyed": _principal_columns, "detail_keyed": _detail_columns}
KEY_PREFIX = "__key_"


def with_keys(df: DataFrame, strip_float_suffix: bool = False, keep_unidentified: bool = False) -> DataFrame:
    """L2-L4 on input rows: beside its own columns each row has the keys of
    the table it belongs to, under a prefix.  Written once, the three keyed
    tables are filters of it (:func:`keyed_rows`): no wide row is written
    again and no key made again."""
    df = ensure_columns(df, ["codigo", *PRINCIPAL_ALT_KEY_COLUMNS, *ALT_SAME_LEVEL_KEY_COLUMNS, *DETAIL_KEY_COLUMNS])
    parts: dict[str, tuple[Column, Column]] = {}
    keys: dict[str, Column] = {}
    for table, columns in KEYED.items():
        own = _belongs(table)
        for name, value in columns(strip_float_suffix, KEY_PREFIX)[0].items():
            parts[name] = (value, parts[name][1] | own if name in parts else own)
        keys.update({name: F.when(own, value) for name, value in columns(strip_float_suffix, KEY_PREFIX)[1].items()})
    out = _normalised(df, {name: F.when(used, value) for name, (value, used) in parts.items()}).withColumns(keys)
    return out.withColumn(f"{KEY_PREFIX}dedup_key", _own_key(f"{KEY_PREFIX}dedup_key")) if keep_unidentified else out


def keyed_rows(keyed: DataFrame, table: str) -> DataFrame:
    """One keyed table out of :func:`with_keys`."""
    parts, keys = KEYED[table](False)
    names = [*parts, *keys]
    plain = [F.col(f"`{c}`") for c in keyed.columns if not c.startswith(KEY_PREFIX) and c not in names]
    return keyed.filter(_belongs(table)).select(*plain, *[F.col(f"{KEY_PREFIX}{c}").alias(c) for c in names])


def same_level_rows(df: DataFrame, strip_float_suffix: bool = False, keep_unidentified: bool = False) -> DataFrame:
    """Same-level and standalone rows with their dedup key (L2, T4 option)."""
    same = same_level_key(df.filter(_belongs("same_level_keyed")), strip_float_suffix)
    return same.withColumn("dedup_key", _own_key("dedup_key")) if keep_unidentified else same


def complementary_rows(df: DataFrame, strip_float_suffix: bool = False,
                       drop_exact_rows: bool = False) -> tuple[DataFrame, DataFrame]:
    """Principal and agricultural-detail rows with their keys."""
    principal = principal_key(df.filter(_belongs("principal_keyed")), strip_float_suffix)
    detail = detail_key(df.filter(_belongs("detail_keyed")), strip_float_suffix)
    if drop_exact_rows:
        detail = drop_exact(detail, ignore=["row_id"])
    return principal, detail


StageMany = Callable[[dict[str, DataFrame]], dict[str, DataFrame]]


def consolidate(raw: DataFrame, registry: DataFrame, strip_float_suffix: bool = False,
                drop_exact_rows: bool = False, keep_unidentified: bool = False, stage: Stage = _no_stage,
                stage_many: StageMany | None = None) -> Curated:
    """The whole consolidation: three curated tables, two report sets.

    Intermediate tables may be materialised: ``stage`` one at a time, or
    ``stage_many`` a phase of independent tables at once (inputs with their
    keys; then the three deduplicated tables).  Every report set is then
    computed from the staged tables instead of re-running the
    harmonisation."""
    many = stage_many or (lambda frames: {n: stage(df, n) for n, df in frames.items()})
    staged = many({"inputs": with_keys(load_inputs(raw, registry), strip_float_suffix, keep_unidentified)})["inputs"]
    df = staged.drop(*[c for c in staged.columns if c.startswith(KEY_PREFIX)])
    same, principal_rows, detail_rows = (keyed_rows(staged, table) for table in KEYED)
    if drop_exact_rows:
        detail_rows = many({"detail_keyed": drop_exact(detail_rows, ignore=["row_id"])})["detail_keyed"]
    best = many({"consolidated": keep_best(same, "dedup_key", "prioridad", "row_id"),
                 "principal": keep_best(principal_rows, "principal_key", "prioridad", "row_id"),
                 "detail": keep_best(detail_rows, "detalle_key", "prioridad", "row_id")})
    same_level = SameLevel(best["consolidated"], duplicate_rows(same, "dedup_key"), conflicts(same, "dedup_key"))
    comp = Complementary(best["principal"], best["detail"], duplicate_rows(principal_rows, "principal_key"),
                         duplicate_rows(detail_rows, "detalle_key"))
    return Curated(df, same_level, comp, relation_reports(df, comp))
