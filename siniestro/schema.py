"""The harmonised 47-column declaration table."""

from __future__ import annotations

from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StringType, StructField, StructType

# --- fixed values: column order and types of the harmonised table -----------
OUTPUT_COLUMNS = [
    "evento_id", "periodo", "anio", "dto", "fecha_origen", "source_file", "source_sheet",
    "dataset_role", "relation_type", "iddj", "codigo", "solicitud_id", "productor_nombre",
    "documento_nro", "cuit_cuil", "departamento", "localidad", "paraje", "seccion", "renspa",
    "actividad", "cultivo", "especie", "categoria", "superficie_total", "superficie_agricola_uso",
    "superficie_agricola_afectada", "superficie_ganadera_uso", "superficie_ganadera_afectada",
    "existencias", "mortandad", "produccion_estimada", "produccion_obtenida",
    "porcentaje_afectacion_ganadera", "superficie_plantada_sembrada", "superficie_afectada",
    "porcentaje_afectacion", "observaciones", "flag_anio_corregido", "flag_anio_fuera_rango",
    "flag_superficie_negativa", "flag_agricola_afectada_mayor_uso", "flag_ganadera_afectada_mayor_uso",
    "flag_mortandad_mayor_existencias", "flag_superficie_total_menor_afectadas", "flag_revision_manual",
    "severidad_maxima",
]

# Columns passed through clean_text (C1) when a sheet is harmonised.
TEXT_COLUMNS = [
    "periodo", "dto", "iddj", "codigo", "solicitud_id", "productor_nombre", "documento_nro", "cuit_cuil",
    "departamento", "localidad", "paraje", "seccion", "renspa", "actividad", "cultivo", "especie",
    "categoria", "observaciones",
]

# Columns passed through clean_numeric.
NUMERIC_COLUMNS = [
    "superficie_total", "superficie_agricola_uso", "superficie_agricola_afectada", "superficie_ganadera_uso",
    "superficie_ganadera_afectada", "existencias", "mortandad", "produccion_estimada", "produccion_obtenida",
    "porcentaje_afectacion_ganadera", "superficie_plantada_sembrada", "superficie_afectada",
    "porcentaje_afectacion",
]

SURFACE_COLUMNS = [
    "superficie_total", "superficie_agricola_uso", "superficie_agricola_afectada",
    "superficie_ganadera_uso", "superficie_ganadera_afectada",
]

# The nine numerics compared between duplicate rows in the conflict report.
CONFLICT_COLUMNS = [
    "superficie_total", "superficie_agricola_uso", "superficie_agricola_afectada", "superficie_ganadera_uso",
    "superficie_ganadera_afectada", "existencias", "mortandad", "produccion_estimada", "produccion_obtenida",
]

FLAG_COLUMNS = [c for c in OUTPUT_COLUMNS if c.startswith("flag_")]
# -----------------------------------------------------------------------------

OUTPUT_TYPES: dict[str, str] = {}
for _c in OUTPUT_COLUMNS:
    if _c == "anio":
        OUTPUT_TYPES[_c] = "int"
    elif _c in NUMERIC_COLUMNS:
        OUTPUT_TYPES[_c] = "double"
    elif _c in FLAG_COLUMNS:
        OUTPUT_TYPES[_c] = "boolean"
    else:
        OUTPUT_TYPES[_c] = "string"

_TYPES = {"int": IntegerType(), "double": DoubleType(), "boolean": BooleanType(), "string": StringType()}
RAW_CLEAN_SCHEMA = StructType([StructField(c, _TYPES[t], True) for c, t in OUTPUT_TYPES.items()])
