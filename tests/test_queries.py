"""Search, metrics, mutation, models, and the named queries against SQL."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from ledgerleaf.operators import audit, evaluate, models, mutate, search, split, tfidf
from ledgerleaf.plans import queries as Q
from ledgerleaf.plans.corpus import TABLES
from ledgerleaf.plans.oracle import ORACLE
from ledgerleaf.plans.queries import QUERIES
from ledgerleaf.sources import tables

# SQL cannot minimise a loss: tests/test_linear.py holds what these queries train
# against exact slopes and a plain solver.
ITERATIVE = {"train_logreg", "train_svm", "train_evaluate_select"}


@pytest.fixture(scope="module")
def con(sf):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return db


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - ITERATIVE))
def test_query_equals_sql(spark, sf, con, name):
    df = contract.queries()[name](spark, sf)
    cur = con.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cur.fetchall())


def test_entry_and_keys(spark):
    assert contract.entry(spark).count() > 0
    assert set(QUERIES) == set(ORACLE) | ITERATIVE and set(QUERIES) <= set(contract.queries())


def test_sort_orders_are_reversed(spark, sf):
    docs = Q.stored(spark, sf)
    newest = [r.doc_id for r in search.search(docs, sort="newest").collect()]
    oldest = [r.doc_id for r in search.search(docs, sort="oldest").collect()]
    assert newest == oldest[::-1]


def test_key_pages_equal_offset_pages(spark, sf):
    docs = Q.stored(spark, sf)
    after = None
    for page in range(3):
        want = search.search(docs, limit=20, offset=20 * page).collect()
        got = search.page_after(docs, after).collect()
        assert [r.doc_id for r in got] == [r.doc_id for r in want]
        after = (got[-1].upload_ts, got[-1].doc_id)


def test_search_takes_words_literally(spark):
    df = spark.createDataFrame(
        [(1, "100%_a", None), (2, "1000 a", "x"), (3, "É", "ACME")], "doc_id long, a string, b string"
    )

    def hits(query):
        return [r.doc_id for r in df.filter(search.matches_words(query, ("a", "b"))).orderBy("doc_id").collect()]

    assert hits("%_A") == [1]
    assert hits("acme") == [3] and hits("é") == []
    assert hits("a x") == [2] and hits("") == [1, 2, 3]


def test_day_filter_reaches_the_scan(spark, sf, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    Q.stored(spark, sf).write.parquet(str(tmp_path / "d"))
    docs = search.filtered(spark.read.parquet(str(tmp_path / "d")), status="Failed", date_from="1996-01-01", date_to="1996-12-31")
    plan = docs.select("doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(upload_ts" in plan and "LessThan(upload_ts" in plan and "EqualTo(status,Failed)" in plan


def test_updates(spark):
    docs = spark.createDataFrame([(1, "a", "New"), (2, "b", "New")], "doc_id long, company string, status string")
    changes = spark.createDataFrame([(1, None)], "doc_id long, company string")
    got = {r.doc_id: (r.company, r.changed) for r in mutate.apply_updates(docs, changes).collect()}
    assert got == {1: (None, True), 2: ("b", False)}
    with pytest.raises(ValueError, match="Cannot update column"):
        mutate.apply_updates(docs, changes.withColumnRenamed("company", "file_hash"))
    kept, removed = mutate.apply_deletes(docs, spark.createDataFrame([(2,), (2,), (5,)], "doc_id long"))
    assert [r.doc_id for r in kept.collect()] == [1] and [r.doc_id for r in removed.collect()] == [2]


def test_latest_action_keeps_documents_without_history(spark):
    docs = spark.createDataFrame([(1,), (2,)], "doc_id long")
    log = spark.createDataFrame(
        [(1, 1, "a", "2026-01-02"), (2, 1, "b", "2026-01-01")], "id long, document_id long, action string, ts string"
    )
    got = {r.doc_id: r.latest_action for r in audit.with_latest_action(docs, log).collect()}
    assert got == {1: "b", 2: None}


def test_split_is_exact_and_stable(spark):
    df = spark.range(1000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 990, "a").otherwise("b").alias("label"))
    parts = split.stratified_split(df)
    counts = {(r.label, r.is_test): r["count"] for r in parts.groupBy("label", "is_test").count().collect()}
    assert counts == {("a", True): 297, ("a", False): 693, ("b", True): 3, ("b", False): 7}
    again = split.stratified_split(df.repartition(9))
    assert sorted(map(tuple, parts.collect())) == sorted(map(tuple, again.collect()))


TRAIN = [
    ("Invoice", "invoice number total amount due"), ("Invoice", "grand total invoice bill to"),
    ("Resume", "skills education experience python"), ("Resume", "curriculum vitae skills sql"),
    ("Other", "meeting notes monday agenda"), ("Other", "weather report sunny today"),
]


def test_tfidf_by_hand(spark):
    import math

    docs = spark.createDataFrame([(1, "red red fox"), (2, "red a"), (3, "")], "doc_id long, clean_text string")
    model = tfidf.TfIdf(docs)
    idf = {r.term: r.idf for r in model.frequency.collect()}
    assert set(idf) == {"red", "fox", "red red", "red fox"}
    assert idf["red"] == pytest.approx(math.log(4 / 3) + 1) and idf["fox"] == pytest.approx(math.log(4 / 2) + 1)
    raw = {"red": 2 * idf["red"], "fox": idf["fox"], "red red": idf["fox"], "red fox": idf["fox"]}
    norm = math.sqrt(sum(x * x for x in raw.values()))
    got = {r.term: r.weight for r in model.fit_weights().filter("doc_id = 1").collect()}
    assert got == {t: pytest.approx(x / norm) for t, x in raw.items()}


def test_models_agree_and_persist(spark, tmp_path):
    rows = [(i, *TRAIN[i % 6]) for i in range(24)]
    docs = spark.createDataFrame(rows, "doc_id long, label string, clean_text string")
    docs = docs.unionByName(spark.createDataFrame([(99, None, "a row without label")], docs.schema))
    fitted = models.train(docs)
    docs = docs.filter("label IS NOT NULL")
    name, best, metrics = models.select_best(fitted, docs)
    assert name == "LogisticRegression"
    assert {r.model: r.f1 for r in metrics.collect()} == dict.fromkeys(models.CANDIDATES, 1.0)
    confidence = {n: models.score(m, docs).filter("confidence IS NOT NULL").count() for n, m in fitted.items()}
    assert confidence == {"LogisticRegression": 24, "LinearSVM": 0, "NaiveBayes": 24}
    models.save_model(best, str(tmp_path / "m"))
    again = models.load_model(spark, str(tmp_path / "m"))
    assert models.score(again, docs).filter("predicted <> label").count() == 0
    assert models.load_model(spark, str(tmp_path / "absent")) is None
    without = models.classify(docs, None)
    assert without.filter("model_label IS NOT NULL OR classifier <> 'Rule-based'").count() == 0
    bayes = tfidf.NaiveBayes(docs)
    assert bayes.predict(docs).join(docs, "doc_id").filter("predicted <> label").count() == 0


def test_bayes_takes_its_classes_from_the_data(spark):
    rows = [(i, *TRAIN[i % 6]) for i in range(12)]
    rows += [(100 + i, "Contract", f"the parties agree clause {i} lease term") for i in range(4)] + [(200, None, "lease clause")]
    docs = spark.createDataFrame(rows, "doc_id long, label string, clean_text string")
    got = tfidf.NaiveBayes(docs).predict(docs).join(docs, "doc_id")
    assert got.count() == len(rows) and got.filter("predicted <> label").count() == 0
    assert got.filter("doc_id = 200 AND predicted = 'Contract'").count() == 1


def test_split_keeps_rows_without_label(spark):
    df = spark.range(20).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "a").alias("label"))
    parts = split.stratified_split(df)
    counts = {(r.label, r.is_test): r["count"] for r in parts.groupBy("label", "is_test").count().collect()}
    assert counts == {("a", True): 3, ("a", False): 7, (None, True): 3, (None, False): 7}


def test_repeated_updates_apply_in_order(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, company string")
    changes = spark.createDataFrame([(1, "x", 1), (1, None, 2), (3, "z", 1)], "doc_id long, company string, seq long")
    got = {r.doc_id: (r.company, r.changed) for r in mutate.apply_updates(docs, changes).collect()}
    assert got == {1: (None, True), 2: ("b", False)}
    gone = mutate.unknown_corrections(docs, changes.select("doc_id"))
    assert [(r.doc_id, r.message) for r in gone.collect()] == [(3, "That document no longer exists.")]


def test_report_names_the_chosen_model(spark, tmp_path):
    rows = [("m", "a", "a"), ("m", "b", "a"), ("n", "a", "a"), ("n", "b", "b")]
    preds = spark.createDataFrame(rows, "model string, label string, predicted string")
    metrics = evaluate.macro_metrics(preds, keys=("model",))
    tables.write_report(metrics, evaluate.confusion_cells(preds, keys=("model",)), "n", str(tmp_path / "r"))
    report = {r.model: r for r in spark.read.json(str(tmp_path / "r")).collect()}
    assert report["n"].chosen and not report["m"].chosen
    assert {(c.label, c.predicted): c.n for c in report["m"].confusion} == {("a", "a"): 1, ("b", "a"): 1}


def test_macro_metrics_zero_division(spark):
    rows = [("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")]
    got = evaluate.macro_metrics(spark.createDataFrame(rows, "label string, predicted string")).first()
    # precision a 1, b 1/3, c 0; recall a 1/2, b 1, c 0; f1 a 2/3, b 1/2, c 0
    assert (got.accuracy, got.precision, got.recall, got.f1) == (0.5, 0.444, 0.5, 0.389)


def test_class_sums_move_terms_and_not_rows(spark, monkeypatch):
    """The class sums of every term, over few documents and over too many to broadcast
    their norms; rows without an id are one document."""
    rows = [(i % 40 if i % 9 else None, "ab"[i % 2], f"cat dog w{i % 7} w{i % 5} bird{i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, label string, clean_text string")
    model = tfidf.TfIdf(docs, keep=("label",))
    weighed = model.fit_weights().join(model.frequency.select("term", "df"), "term")
    want = {}
    for r in weighed.collect():
        held = want.setdefault(r.term, [r.idf, 0, 0.0, 0.0])
        held[1] += 1
        held[2 + "ab".index(r.label)] += r.weight
    for most in (2_000_000, 0):
        monkeypatch.setattr(tfidf, "MOST_NORMS", most)
        sums = tfidf.class_sums(model.train_counts, model.frequency, "label", ["a", "b"], 60)
        got = {r.term: list(r)[1:] for r in sums.collect()}
        assert got.keys() == want.keys()
        assert all(got[t] == pytest.approx(want[t]) for t in want)
        plan = sums._jdf.queryExecution().toString()
        assert ("BroadcastHashJoin" in plan and "Window" not in plan) or not most


def test_frequencies_of_slices_are_those_of_the_rows(spark, monkeypatch):
    """Odd words, one-letter words, a pair that occurs twice, null and empty texts, and
    slices of a few rows; rows that repeat an id count on their own."""
    texts = ["cat dog cat dog", "Dog CAT_9 \u00e9l\u00e9phant \u0130x \u212aelvin", "a b c", "", None, "\u65e5\u672c go-to go\nto", "x1 x1 x1"]
    docs = spark.createDataFrame([(i % 5, texts[i % 7]) for i in range(50)], "doc_id long, clean_text string").repartition(3)
    want = {tuple(r) for r in tfidf.TfIdf(docs).frequency.collect()}
    for size in (tfidf.SLICE_BYTES, 40):
        monkeypatch.setattr(tfidf, "SLICE_BYTES", size)
        frequency = tfidf.frequency_of(docs)
        assert {tuple(r) for r in frequency.collect()} == want
    assert frequency.filter("term = 'cat dog'").first().df == 8
    assert "Generate" not in frequency._jdf.queryExecution().toString()


def test_hot_keys_do_not_move_the_rows(spark):
    """The rows are shuffled for the join itself, and not to look up which keys are hot."""
    docs = spark.createDataFrame([(i, f"cat dog w{i % 7}") for i in range(50)], "doc_id long, clean_text string")
    model = tfidf.TfIdf(docs)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = model.fit_sums()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("BroadcastHashJoin") == 2 and plan.count("SortMergeJoin") == 1


def test_slices_in_rounds_give_the_rows_of_one_slice(spark, monkeypatch):
    """Small slices and several rounds: frequencies, weights, class sums and scores are those
    of a single slice; ids repeat over slices, and one is null."""
    rows = [(i % 40 if i % 9 else None, "ab"[i % 2], f"cat dog w{i % 7} w{i % 5} bird{i} cat dog" if i % 11 else None) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, label string, clean_text string").repartition(3).cache()

    def results():
        model = tfidf.TfIdf(docs, keep=("label",))
        sums = tfidf.class_sums(model.train_counts, model.frequency, "label", ["a", "b"], 60)
        bayes = tfidf.NaiveBayes(docs)
        tables = {"sums": model.fit_sums(), "classes": sums, "scores": bayes.predict(docs), "weights": model.fit_weights()}
        found = {name: sorted(([*r] for r in t.collect()), key=lambda r: str(r)) for name, t in tables.items()}
        return model, {**found, "df": sorted(map(tuple, model.frequency.select("term", "df").collect()))}

    model, want = results()
    assert model.rounds == 1 and model.train_counts.count() <= 3
    monkeypatch.setattr(tfidf, "SLICE_BYTES", 60)
    monkeypatch.setattr(tfidf, "ROUND_WORDS", 60)
    model, got = results()
    assert model.rounds > 2 and model.train_counts.count() > 5
    assert got["df"] == want["df"]
    for name in ("sums", "classes", "scores", "weights"):
        assert len(got[name]) == len(want[name]), name
        for a, b in zip(got[name], want[name]):
            assert a == pytest.approx(b), name


def test_what_meets_are_terms_of_slices_and_not_rows(spark):
    """A term of a thousand rows is one row of the join with the frequencies."""
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("cat dog cat bird").alias("clean_text")).coalesce(1)
    model = tfidf.TfIdf(docs)
    assert model.frequency.count() == 6
    hot = tfidf.salts(model.frequency, "term", "df")
    assert tfidf._met(model.train_counts, model.frequency, hot, 0, 1).count() == 6
    sums = model.fit_sums().collect()
    assert len(sums) == 1000
    assert all(r.n_terms == 6 and r.sum_weight == pytest.approx((5 + 2) / (4 + 5) ** 0.5) for r in sums)
