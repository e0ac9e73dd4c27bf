"""The schedule decides where documents come in the mix."""

from ledgerleaf.llm import mixing


def test_documents_come_in_the_order_of_their_places(spark):
    rows = [(i, " ".join(f"w{i}" for _ in range(3000)), "en", "ab"[i % 2], 0) for i in range(24)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    place = {r.doc_id: r.first_place for r in mixing.op7_mix_sources(docs).collect()}
    assert all(p is not None for p in place.values())
    seen = list(dict.fromkeys(r.doc_id for r in mixing.mixed_documents(docs).select("doc_id").collect()))
    assert [place[i] for i in seen] == sorted(place.values()) and len(seen) == 24
