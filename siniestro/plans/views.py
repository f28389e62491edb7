"""Legacy operational views (M19) of the declaration star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import Dim, lookup
from .catalog import Catalog

OTHER = "OTRO"   # fixed value: label when the address has no geography row


def producers_geography(cat: Catalog) -> DataFrame:
    """Producer with full geography; missing department/locality -> ``OTRO``."""
    j = lookup(cat.physical("productores"), [
        Dim(cat.physical("domicilios"), "DomicilioId", "DomicilioId",
            {"ProvinciaId": "__prov", "DepartamentoId": "__dep", "LocalidadId": "__loc"}),
        Dim(cat.physical("provincias"), "__prov", "ProvinciaId", {"ProvinciaDesc": "provincia"}),
        Dim(cat.physical("departamentos"), "__dep", "DepartamentoId", {"DepartamentoDesc": "__dd"}),
        Dim(cat.physical("localidades"), "__loc", "LocalidadId", {"LocalidadDesc": "__ld"}),
    ])
    return j.select("ProductorId", "ProductorDenominacion", "provincia",
                    F.coalesce("__dd", F.lit(OTHER)).alias("departamento"),
                    F.coalesce("__ld", F.lit(OTHER)).alias("localidad"))


def parcels_inner(cat: Catalog) -> DataFrame:
    """Parcel view with five INNER joins: a parcel whose activity, tenure,
    establishment, declaration or producer is missing disappears."""
    j = lookup(cat.physical("adremas"), [
        Dim(cat.physical("tipoactividad"), F.col("actividad").try_cast("int"), "TipoActividadId",
            {"TipoActividadDesc": "__act"}, how="inner"),
        Dim(cat.physical("tipotenencia"), "tenencia", "id", {"descripcion": "__ten"}, how="inner"),
        Dim(cat.physical("establecimientos"), "id_establecimiento", "id_establecimiento", {"nombre_estab": "nombre_estab"},
            how="inner"),
        Dim(cat.physical("ddjj_personas"), "ddjj", "id_ddjj", {"id_productor": "__prod"}, how="inner"),
        Dim(cat.physical("productores"), "__prod", "ProductorId", {"ProductorDenominacion": "productor"}, how="inner"),
    ])
    return j.select("adrema", "superficie", F.col("__act").alias("actividad"), F.col("__ten").alias("tenencia"),
                    "nombre_estab", F.col("ddjj").alias("id_ddjj"), "productor")


def _activities(cat: Catalog, fk: str, name: str = "actividad") -> Dim:
    return Dim(cat.physical("tipoactividad"), fk, "TipoActividadId", {"TipoActividadDesc": name})


def products(cat: Catalog) -> DataFrame:
    """Product with its type, activity and unit; what isn't found is null, no product disappears."""
    j = lookup(cat.physical("productos"), [
        Dim(cat.physical("productostipo"), "productotipoid", "productotipoid",
            {"ProductoTipoDesc": "tipo", "id_actividad": "__type_activity"}),
        _activities(cat, "actividadid"),
        _activities(cat, "__type_activity", "actividad_tipo"),
        Dim(cat.physical("unidades_medida"), "medida", "id", {"UnidadDesc": "unidad"}),
    ])
    return j.select("productoid", F.col("ProductoDesc").alias("producto"), "precio", "tipo", "actividad", "actividad_tipo", "unidad")


def product_types(cat: Catalog) -> DataFrame:
    """Product type with the activity it belongs to and the number of its products and their prices."""
    priced = (cat.physical("productos").groupBy(F.col("productotipoid").alias("__type"))
              .agg(F.count(F.lit(1)).alias("__n"), F.min("precio").alias("__low"), F.max("precio").alias("__high")))
    j = lookup(cat.physical("productostipo"), [
        _activities(cat, "id_actividad"),
        Dim(priced, "productotipoid", "__type", {"__n": "__n", "__low": "precio_min", "__high": "precio_max"}),
    ])
    return j.select("productotipoid", F.col("ProductoTipoDesc").alias("tipo"), "actividad",
                    F.coalesce("__n", F.lit(0)).alias("productos"), "precio_min", "precio_max")
