"""Legacy operational views and the parcel search over them."""

import pytest
from pyspark.sql import functions as F

from siniestro.plans import reports as R
from siniestro.plans import views
from siniestro.plans.catalog import Catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def cat(spark):
    return Catalog(spark, SF, "actual")


def test_no_product_disappears(cat):
    out = views.products(cat)
    assert out.count() == cat.physical("productos").count() == out.select("productoid").distinct().count()
    missing = out.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in ("tipo", "actividad", "unidad"))).first()
    assert missing["actividad"] > 0 and missing["unidad"] > 0
    assert out.filter("tipo is null and actividad_tipo is not null").count() == 0


def test_product_types_count_their_products(cat):
    types = views.product_types(cat)
    assert types.count() == cat.physical("productostipo").count()
    typed = views.products(cat).filter("tipo is not null")
    assert types.agg(F.sum("productos")).first()[0] == typed.count()
    assert types.filter("productos > 0 and precio_min > precio_max").count() == 0


def test_parcel_search(cat):
    every = views.parcels_inner(cat)
    name = every.select("productor").orderBy("productor").first()[0]
    found = R.parcels_of_producer(cat, name.upper()[2:])
    assert {r.productor for r in found.select("productor").collect()} == {name}
    assert found.count() == every.filter(F.col("productor") == name).count()
    assert R.parcels_of_producer(cat, "").count() == R.parcels_of_producer(cat, None).count() == every.count()
    assert R.parcels_of_producer(cat, "nobody of that name").count() == 0
