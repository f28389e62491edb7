"""The consolidation's keys: made once per row, the keyed tables are filters of the written inputs."""

from siniestro.operators.consolidate import (KEY_PREFIX, KEYED, complementary_rows, consolidate, keyed_rows, same_level_rows,
                                             with_keys)

COLUMNS = ("row_id long, evento_id string, relation_type string, dataset_role string, codigo string, iddj string, documento_nro string, "
           "productor_nombre string, departamento string, actividad string, cultivo string, especie string, categoria string")
ROWS = [(1, "Ev 1", "standalone", None, " 12.0 ", None, "4", "Ana", "X", "A", "B", None, None),
        (2, "Ev 1", "consolidate_same_level", "principal", None, "5", "4", "Ána", "X", "A", None, None, None),
        (3, None, "standalone", "otro", None, None, None, None, None, None, None, None, None),
        (4, "Ev 2", "complementary_detail", "principal", "1", None, "4", "Ana", "X", None, None, None, None),
        (5, "Ev 2", "complementary_detail", "detalle_agricola", "1", "9.0", None, None, None, None, None, "maíz", "a b"),
        (6, "Ev 2", "complementary_detail", "otro", "1", "9", None, None, None, None, None, None, None),
        (7, "Ev 2", None, "principal", "1", "9", None, None, None, None, None, None, None)]


def test_keyed_tables_are_those_of_the_rules(spark):
    inputs = spark.createDataFrame(ROWS, COLUMNS)
    for options in ({}, {"strip_float_suffix": True, "keep_unidentified": True}):
        keyed = with_keys(inputs, **options)
        plain = (same_level_rows(inputs, **options), *complementary_rows(inputs, options.get("strip_float_suffix", False)))
        for table, want in zip(KEYED, plain, strict=True):
            got = keyed_rows(keyed, table)
            rows = sorted(map(tuple, want.collect()), key=repr)
            assert got.columns == want.columns and rows and sorted(map(tuple, got.collect()), key=repr) == rows


def test_wide_rows_are_staged_once(spark):
    staged = []
    registry = spark.createDataFrame([], "source_file string, evento_id string, dataset_role string, relation_type string, "
                                         "evento_nombre string, anio_inicio int, anio_fin int, prioridad int, comentario string")
    raw = spark.createDataFrame(ROWS, COLUMNS)
    out = consolidate(raw, registry, stage_many=lambda frames: staged.extend(frames) or frames)
    assert staged == ["inputs", "consolidated", "principal", "detail"]
    assert not [c for c in out.inputs.columns if c.startswith(KEY_PREFIX)]


def test_stream_tables_take_the_keys_of_the_store(spark):
    from siniestro.streaming.consolidation import curated_tables
    inputs = spark.createDataFrame([(*r, 1.0) for r in ROWS], COLUMNS + ", prioridad double")
    keyed = with_keys(inputs)
    stored = curated_tables(spark.createDataFrame(keyed.collect(), keyed.schema))
    for name, df in curated_tables(inputs).items():
        assert stored[name].columns == df.columns
        assert sorted(r["row_id"] for r in stored[name].collect()) == sorted(r["row_id"] for r in df.collect())
        assert "regexp_replace" not in stored[name]._jdf.queryExecution().optimizedPlan().toString()
