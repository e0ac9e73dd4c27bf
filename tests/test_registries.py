"""One entry more in each registry: a check, a rule, an extraction step and a candidate."""

from pyspark.sql import functions as F

from ledgerleaf.functions import extract, fields, rules
from ledgerleaf.operators import models, workflow

GOOD = {"invoice_number": "7-C", "date": "7 June 2018", "company_name": "Kiln Row", "total_amount": "EUR 61"}


def test_a_check_of_ones_own(spark):
    rows = [(1, "invoice", {**GOOD, "vat_rate": "19 %"}), (2, "invoice", {**GOOD, "vat_rate": "many"}), (3, "invoice", GOOD), (4, "invoice", {**GOOD, "date": "never"})]
    docs = spark.createDataFrame(rows, "doc_id long, document_type string, fields map<string,string>")
    percent = {"vat_rate": lambda value: F.rlike(value, F.lit(r"^\d+ ?%$"))}
    out = fields.with_validation(docs, checks=percent, reasons={"vat_rate": "not a percentage"})
    got = {r.doc_id: r.validation for r in out.collect()}
    assert got[1].is_valid and "vat_rate" in got[1].checked
    assert got[2].invalid_fields == {"vat_rate": "not a percentage"} and not got[2].is_valid
    assert got[3].is_valid and "vat_rate" not in got[3].checked
    assert list(got[4].invalid_fields) == ["date"]
    assert all(r.validation.is_valid == (r.doc_id != 4) for r in fields.with_validation(docs).collect())


def test_a_rule_of_ones_own(spark):
    docs = spark.createDataFrame(
        [(1, "invoice", '{"invoice_number":"7-C","date":"7 June 2018","company_name":"Kiln Row","total_amount":"EUR 61"}', 0.9)],
        "doc_id long, document_type string, fields_json string, confidence double",
    )
    watched = lambda row: F.when(F.try_element_at(row["fields"], F.lit("company_name")) == "Kiln Row", "watched company")
    assert workflow.decide_documents(docs).first().next_state == "Completed"
    assert workflow.decide_documents(docs, rules=[*rules.RULES, watched]).first().reason == "watched company"


def test_an_extraction_step_of_ones_own(spark):
    docs = spark.createDataFrame([(1, "order ref <Q-77>")], "doc_id long, clean_text string")
    steps = [lambda text: F.regexp_extract(text, r"Ref: (\w+)", 1), lambda text: F.regexp_extract(text, r"<([^>]+)>", 1)]
    assert extract.with_captures(docs, {"ref": (steps, F.lit(True))}, "clean_text").first().ref == "Q-77"


def test_a_candidate_of_ones_own(spark):
    docs = spark.createDataFrame([(i, "ab"[i % 2], ["cats purr", "dogs bark"][i % 2]) for i in range(6)], "doc_id long, label string, clean_text string")
    candidates = {"Own": lambda data, name: models.CANDIDATES["NaiveBayes"](data, name), **{"NaiveBayes": models.CANDIDATES["NaiveBayes"]}}
    fitted = models.train(docs, candidates=candidates)
    assert list(fitted) == ["Own", "NaiveBayes"] and models.select_best(fitted, docs)[0] == "Own"
