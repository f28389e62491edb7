import corpus_pipeline
from common import SF, docs_of

from siniestro.llm import class_lm, decontamination, language_id, line_dedup, pieces, sharding, simhash, substring_dedup

EXTRA = ["_id", "id", "_version", "_text", "c0", "c1", "ranges", "fp", "h", "word", "n", "slot", "shard", "draw", "_in",
         "_row", "item_id", "component", "size", "g", "with.dot"]


def wide(spark):
    rows = [(i, f"some text of its own number {i} and more words\nthe line that all of them have", "en", "s", 3,
             *(f"{c}{i}" for c in EXTRA)) for i in range(12)]
    return docs_of(spark, rows, "".join(f", `{c}` string" for c in EXTRA))


def test_every_column_comes_through(spark):
    docs = wide(spark)
    items = spark.createDataFrame([(1, "quite another text of many words", "x")], "item_id long, text string, doc_id string")
    model = language_id.learn(docs)
    counts = class_lm.word_counts(docs.select("text"))
    lm = class_lm.learn(docs.select("text"), counts)
    vocabulary = pieces.load()
    outs = [line_dedup.drop_lines(docs), substring_dedup.remove_repeats(docs), simhash.keep_one(docs),
            decontamination.remove(docs, items), language_id.keep_known(docs, model), class_lm.score(docs, lm, counts),
            pieces.decode(pieces.encode(docs, vocabulary), vocabulary), sharding.shard(docs)]
    for out in outs:
        replaced = {"shard", "slot", "size"}
        names = [c for c in EXTRA if c not in replaced]
        assert set(names) <= set(out.columns), set(names) - set(out.columns)
        for r in out.select("doc_id", *(f"`{c}`" for c in names)).collect():
            assert list(r)[1:] == [f"{c}{r.doc_id}" for c in names]


def test_pipeline_stages_keep_them(spark):
    docs = wide(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == wide(spark).columns
