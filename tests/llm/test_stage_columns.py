"""The pipeline's stages keep columns of any name, and take tables without rows."""

import corpus_pipeline
from ledgerleaf.llm.tools import free_prefix
from pyspark.sql import functions as F

NAMES = ["_id", "_hash", "_keep", "_rows", "_turn", "_words", "_place", "_start", "_whole", "__id", "size", "rank", "node", "again"]
STAGES = dict(corpus_pipeline.STAGES)
BETWEEN = ("line_dedup", "near_dedup", "mix_sources")


def documents(spark):
    line = "a line that is long enough to count once"
    text = "some words of number {0} that make up a text of its own {0} with {0} more"
    rows = [(i, text.format(f"w{i}") + f"\n{line}", "en", f"s{i % 3}", 0) for i in range(12)]
    rows += [(20, rows[3][1], "en", "s0", 0), (20, rows[3][1], "en", "s0", 0), (None, None, None, None, None), (21, "", "de", "s1", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_clashing_names(spark):
    docs = documents(spark)
    wide = docs
    for name in NAMES:
        wide = wide.withColumn(name, F.concat(F.lit(name), F.coalesce(F.col("doc_id"), F.lit(-1)).cast("string")))
    assert free_prefix(docs) == "_" and free_prefix(wide) == "___"
    for name in BETWEEN:
        plain = STAGES[name](spark, docs, "")
        found = STAGES[name](spark, wide, "")
        assert found.columns == wide.columns
        assert sorted(map(repr, found.select(plain.columns).collect())) == sorted(map(repr, plain.collect())), name
        for r in found.collect():
            assert all(r[c] == f"{c}{-1 if r.doc_id is None else r.doc_id}" for c in NAMES), name


def test_empty_tables(spark):
    docs = documents(spark).limit(0)
    for name in BETWEEN:
        found = STAGES[name](spark, docs, "")
        assert found.columns == docs.columns and found.count() == 0
    assert STAGES["packing"](spark, docs, "").count() == 0


def test_line_and_near_stages_by_hand(spark):
    docs = documents(spark).filter("doc_id IS NOT NULL")
    kept = STAGES["line_dedup"](spark, docs, "")
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert [i for i, t in texts.items() if "\n" in t] == [0] and all(len(r.text) == r.n_chars or r.doc_id in (0, 21) for r in kept.collect())
    left = sorted(r.doc_id for r in STAGES["near_dedup"](spark, kept, "").collect())
    # 20 lost all its lines to 3, so it links with nothing.
    assert left == [*range(12), 20, 21] and texts[20] == ""
    assert sorted(r.doc_id for r in STAGES["near_dedup"](spark, docs, "").collect()) == [*range(12), 21]
