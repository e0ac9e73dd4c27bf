"""Cleaning and extraction on hand-made texts."""

import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerleaf.functions import extract, text
from ledgerleaf.functions.classify import with_rule_label
from ledgerleaf.operators.pages import assemble
from ledgerleaf.plans import queries


def plain_clean(raw):
    """The meaning of cleaning, in a line-by-line form."""
    if not raw:
        return ""
    raw = re.sub(r"[ \t]+", " ", re.sub(r"[^\x20-\x7E\n\t]", " ", re.sub(r"\r\n?", "\n", raw)))
    return re.sub(r"\n{3,}", "\n\n", "\n".join(line.strip() for line in raw.split("\n"))).strip()


def test_clean_equals_plain_form_on_random_texts(spark):
    rng = random.Random(7)
    pieces = ["a", "Bc", " ", "  ", "\t", "\n", "\r", "\r\n", "é", "\x00", "\x0b", "😀", "€", ".", " "]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts + [None])], "i int, t string")
    for row in rows.select("t", text.clean_text(F.col("t")).alias("c")).collect():
        assert row.c == plain_clean(row.t), repr(row.t)


def test_clean_is_idempotent(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    once = docs.select(text.clean_text(F.col("text")).alias("a"))
    assert once.filter(F.col("a") != text.clean_text(F.col("a"))).count() == 0


def fields_of(spark, kind, body):
    df = spark.createDataFrame([(kind, body)], "document_type string, clean_text string")
    return extract.with_fields(df).first()["fields"]


def test_invoice_fields(spark):
    body = (
        "Bakery wholesale invoice\nInvoice Number: BK-7-2\nfor eleven trays of rolls\n"
        "Grand Total: EUR 317.40\nDate: 9/11/24\nCompany Name: Crumb and Crust Bakers\nleft at the back door"
    )
    assert fields_of(spark, "Invoice", body) == {
        "Invoice Number": "BK-7-2",
        "Date": "9/11/24",
        "Company Name": "Crumb and Crust Bakers",
        "Total Amount": "EUR 317.40",
    }


def test_invoice_fallbacks_and_quirks(spark):
    got = fields_of(spark, "Invoice", "Invoice notes\nTwo Bridges\nBox # 90210\nSubtotal, 3")
    assert got["Invoice Number"] == "tes"  # 'no' of 'notes' reads as a label
    assert got["Company Name"] == "Two Bridges"
    assert got["Total Amount"] == ","  # found inside 'Subtotal'
    assert got["Date"] is None
    assert fields_of(spark, "Invoice", "Box # 90210")["Invoice Number"] == "90210"


def test_resume_fields(spark):
    body = (
        "Glass blower for hire, name: Tove Lind\nreach me: 0044 20 7946 0958 or tl@glass.example\n"
        "Skills - lathe work,\ncold cutting, Experience: nine summers at a furnace"
    )
    assert fields_of(spark, "Resume", body) == {
        "Name": "Tove Lind",
        "Email": "tl@glass.example",
        "Phone": "0044 20 7946 0958",
        "Skills": "lathe work, cold cutting,",
    }
    assert fields_of(spark, "Resume", "Curriculum Vitae\nTove Lind")["Name"] == "Tove Lind"


def test_other_types_have_no_fields(spark):
    assert fields_of(spark, "Other", "Company: X\nEmail: a@b.co") == {}


def test_email_in_very_long_token(spark):
    body = "x" * 200_000 + " y@" + "z" * 10 + " real@mail.example.org"
    assert fields_of(spark, "Resume", body)["Email"] == "real@mail.example.org"


def test_labels(spark):
    cases = [
        ("Tax invoice, total due", "Invoice"),
        ("My skills and education", "Resume"),
        ("nothing here", "Other"),
        ("total skills", "Invoice"),  # a tie goes to the invoice
        ("the mcv value", "Resume"),  # substrings count
    ]
    df = spark.createDataFrame(cases, "clean_text string, want string")
    assert all(r.rule_label == r.want for r in with_rule_label(df).collect())


def test_pages_in_order_across_parts(spark):
    rows = [(1, p, f" page {p} ") for p in range(700)] + [(1, 900, "  "), (2, 0, "only"), (3, 5, " ")]
    df = spark.createDataFrame(rows, "doc_id long, page_no long, text string").repartition(7)
    got = {r.doc_id: r.text for r in assemble(df).collect()}
    assert got == {1: "\n".join(f"page {p}" for p in range(700)), 2: "only", 3: ""}


def test_cleaning_replaces_the_runs_it_always_did(spark):
    """The first pattern has one way to match at each place; the plain one has two."""
    rng = random.Random(4)
    texts = ["".join(rng.choices(" ab\n\t\x00\x7fé€", k=rng.randint(0, 14))) for _ in range(400)]

    def plain(raw):
        runs = re.sub(r"[^\x21-\x7E\n]{2,}|[^\x20-\x7E\n]", " ", raw)
        return re.sub(r"\n{3,}", "\n\n", re.sub(r" \n ?|\n ", "\n", runs)).strip(" \n")

    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    got = frame.select("text", text.clean_text(F.col("text")).alias("clean")).collect()
    assert all(r["clean"] == plain(r["text"]) for r in got)


def test_scores_of_a_null_text_are_null(spark):
    frame = spark.createDataFrame([(None,), ("",), ("Tax Invoice No 7, total; CV",)], "clean_text string")
    got = [(r["invoice_score"], r["resume_score"], r["rule_label"]) for r in with_rule_label(frame).collect()]
    assert got == [(None, None, "Resume"), (0, 0, "Other"), (4, 1, "Invoice")]


@pytest.mark.parametrize("name", ["process_corpus", "ingest_status", "extract_fields", "missing_important"])
def test_generated_methods_are_small_enough_to_compile(spark, sf, name):
    """The JVM interprets methods above 8,000 bytes; Spark's own limit is 65,535."""
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    code = debug.codegenString(getattr(queries, name)(spark, sf)._jdf.queryExecution().executedPlan())
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < 8000
