"""Upload checks, duplicates and the outcome of a batch."""

from pyspark.sql import functions as F

from ledgerleaf import constants as C
from ledgerleaf.functions import upload
from ledgerleaf.operators import dedup, ingest, skew
from ledgerleaf.sources import landed, tables

PDF = b"%PDF-1.4 "
INVOICE = "Ferry fares invoice\nInvoice Number: FF-31\nsailed on 2/7/2019\nCompany: Sound Crossing\nTotal: 88.20"
FILES = "doc_id long, filename string, upload_ts timestamp, text string, size long, content binary"


def files(spark, rows):
    import datetime as dt

    day = dt.datetime(2026, 1, 1)
    full = [
        (i, name, day + dt.timedelta(hours=i), body, size if size is not None else len(content or b""), content)
        for i, (name, body, content, size) in enumerate(rows)
    ]
    return spark.createDataFrame(full, FILES)


def test_extension_and_safe_name(spark):
    cases = [
        ("a.PDF", "pdf", "a"),
        ("dir/My résumé (1).final.jpeg", "jpeg", "My_r_sum_1_final"),
        (".pdf", "", "pdf"),
        ("noext", "", "noext"),
        ("é.png", "png", "document"),
        ("x" * 60 + ".pdf", "pdf", "x" * 40),
    ]
    df = spark.createDataFrame(cases, "f string, ext string, stem string")
    out = df.select("*", upload.file_extension(F.col("f")).alias("e"), upload.safe_stem(F.col("f")).alias("s"))
    for r in out.collect():
        assert (r.e, r.s) == (r.ext, r.stem), r.f


def test_checks_in_order(spark):
    rows = [
        ("notes.txt", "x", b"plain", None),
        ("empty.pdf", "x", None, 0),
        ("big.pdf", "x", PDF, 11 * 1024 * 1024),
        ("fake.pdf", "x", b"not a pdf", None),
        ("good.png", "x", b"\x89PNG\r\n\x1a\nrest", None),
        ("good.jpg", "x", b"\xff\xd8\xff\xe0", None),
    ]
    out = {r.filename: r.upload_error for r in ingest.validated(files(spark, rows)).collect()}
    assert "not a supported file type" in out["notes.txt"]
    assert out["empty.pdf"] == "'empty.pdf' is empty."
    assert out["big.pdf"] == "'big.pdf' is 11.0 MB. The upload limit is 10 MB."
    assert "real PDF file" in out["fake.pdf"]
    assert out["good.png"] is None and out["good.jpg"] is None


def test_outcome_of_a_batch(spark):
    rows = [
        ("first.pdf", INVOICE, PDF + b"one", None),
        ("again.pdf", INVOICE, PDF + b"one", None),
        ("stored.pdf", INVOICE, PDF + b"two", None),
        ("notes.txt", "x", b"x", None),
        ("short.pdf", "hi", PDF + b"three", None),
        ("partial.pdf", INVOICE.replace("Total: 88.20", ""), PDF + b"four", None),
    ]
    batch = files(spark, rows)
    stored = batch.filter("filename = 'stored.pdf'").select(
        F.lit(99).cast("long").alias("doc_id"),
        F.sha2("content", 256).alias("file_hash"),
        F.lit("old name.pdf").alias("original_filename"),
    )
    out = {r.filename: r for r in ingest.trace(ingest.outcome(batch, stored)).collect()}
    assert {k: v.kind for k, v in out.items()} == {
        "first.pdf": "new", "again.pdf": "duplicate", "stored.pdf": "duplicate",
        "notes.txt": "rejected", "short.pdf": "new", "partial.pdf": "new",
    }
    assert out["stored.pdf"].message == "This file is already in the library as 'old name.pdf'."
    assert out["again.pdf"].message == "This file is already in the library as 'first.pdf'."
    assert out["again.pdf"].existing_id == 0
    assert out["first.pdf"].message == "Saved and processed."
    assert out["partial.pdf"].status_reason == "Missing: Total Amount."
    assert out["short.pdf"].status == "Failed"
    assert [s.state for s in out["short.pdf"].trace] == ["ok", "ok", "ok", "ok", "fail", "skip", "skip", "ok", "ok"]
    assert [s.state for s in out["again.pdf"].trace] == ["ok", "ok", "stop"]
    assert [s.state for s in out["notes.txt"].trace] == ["fail"]


def test_first_wins_with_a_hot_group(spark):
    rows = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        (F.timestamp_seconds(F.lit(1_000_000) - F.col("id") % 7)).alias("upload_ts"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 500).cast("string")).alias("file_hash"),
    )
    kept = dedup.keep_first(rows).collect()
    best = {}
    for r in rows.collect():
        key = (r.upload_ts, r.doc_id)
        best[r.file_hash] = min(best.get(r.file_hash, key), key)
    assert {r.file_hash: (r.upload_ts, r.doc_id) for r in kept} == best
    flagged = dedup.flag_repeats(rows)
    assert flagged.filter("NOT is_duplicate").count() == len(best)
    assert flagged.count() == 3000


def test_salted_join_equals_plain_join(spark):
    left = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 50).cast("string")).alias("k"),
        F.col("id").alias("row"),
    )
    left = left.unionByName(spark.createDataFrame([(None, -1)], "k string, row long"))
    right = spark.createDataFrame([("hot", 1), ("7", 2), ("8", 3), ("8", 4)], "k string, v int")
    counts = left.groupBy("k").agg(F.count("*").alias("n"))
    hot = skew.salts(counts, "k", "n", rows_per_salt=500)
    assert [tuple(r) for r in hot.collect()] == [("hot", 4)]
    for how in ("inner", "left", "left_semi", "left_anti"):
        got = skew.salted_join(left, right, "k", "row", hot, how)
        want = left.join(right, "k", how)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect())), how


def test_every_hot_key_is_salted(spark):
    left = spark.range(9000).select((F.col("id") % 1500).alias("k"), F.col("id").alias("row"))
    right = spark.range(1500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    hot = skew.salts(left.groupBy("k").agg(F.count("*").alias("n")), "k", "n", rows_per_salt=4)
    assert hot.count() == 1500 and hot.filter("_salts <> 2").count() == 0
    got = skew.salted_join(left, right, "k", "row", hot)
    assert got.count() == 9000 and got.filter("v <> k * 2").count() == 0


def test_landed_files_and_manifest(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.pdf").write_bytes(PDF)
    (tmp_path / "in" / "empty.pdf").write_bytes(b"")
    scanned = landed.scan_landed(spark, str(tmp_path / "in"))
    assert [r.filename for r in scanned.collect()] == ["a.pdf"]
    manifest = spark.createDataFrame([("a.pdf", len(PDF)), ("empty.pdf", 0)], "filename string, size long")
    listed = landed.with_manifest(manifest, scanned)
    out = {r.filename: r.upload_error for r in ingest.validated(listed).collect()}
    assert out == {"a.pdf": None, "empty.pdf": "'empty.pdf' is empty."}


def test_manifest_is_matched_by_path_and_the_bytes_decide_the_size(spark, tmp_path):
    for day in ("mon", "tue"):
        (tmp_path / day).mkdir()
        (tmp_path / day / "scan.pdf").write_bytes(PDF + day.encode())
    (tmp_path / "tue" / "large.pdf").write_bytes(PDF + b"x" * C.MAX_UPLOAD_BYTES)
    names = [("mon/scan.pdf", 3), ("tue/scan.pdf", 3), ("tue/large.pdf", 5), ("tue/lost.pdf", 9)]
    manifest = spark.createDataFrame(names, "path string, size long")
    listed = landed.with_manifest(manifest, landed.scan_landed(spark, str(tmp_path)))
    assert listed.count() == 4 and listed.select("doc_id").distinct().count() == 4
    out = {r.path.rsplit("/", 2)[-2] + "/" + r.filename: (r["size"], r.upload_error) for r in ingest.validated(listed).collect()}
    assert out["mon/scan.pdf"] == (len(PDF) + 3, None) and out["tue/scan.pdf"] == (len(PDF) + 3, None)
    assert "The upload limit is 10 MB" in out["tue/large.pdf"][1]
    assert out["tue/lost.pdf"] == (None, C.MSG_NOT_FOUND_IN_SCAN % "lost.pdf")


def test_from_landed_files_to_the_library(spark, tmp_path):
    """The way of the README: scan, pages, outcome, library, and the same files again."""
    (tmp_path / "in").mkdir()
    for name, body in (("a.pdf", PDF + b"a"), ("b.pdf", PDF + b"b"), ("c.pdf", PDF + b"a")):
        (tmp_path / "in" / name).write_bytes(body)
    files = landed.scan_landed(spark, str(tmp_path / "in"))
    ids = {r.filename: r.doc_id for r in files.collect()}
    read = spark.createDataFrame([(ids["a.pdf"], 2, "Total: 88.20"), (ids["a.pdf"], 1, INVOICE.replace("\nTotal: 88.20", ""))], "doc_id long, page_no int, text string")
    texted = landed.with_pages(files, read)
    library = str(tmp_path / "library")
    nothing = spark.createDataFrame([], "doc_id long, file_hash string, original_filename string")
    out = ingest.outcome(texted, nothing)
    kinds = {r.filename: r.kind for r in out.collect()}
    assert sorted(kinds.values()) == ["duplicate", "new", "new"] and kinds["b.pdf"] == "new"
    tables.write_documents(ingest.stored_rows(out.filter("kind = 'new'")), library)
    stored = tables.scan_documents(spark, library)
    assert stored.count() == 2 and stored.filter("doc_id = %d AND status = 'Processed'" % min(ids["a.pdf"], ids["c.pdf"])).count() <= 1
    again = ingest.outcome(texted, stored)
    assert again.filter("kind <> 'duplicate'").count() == 0


def test_an_upload_that_fails_inside_is_an_error(spark):
    batch = files(spark, [("a.pdf", INVOICE, PDF + b"1", None), ("b.pdf", INVOICE, PDF + b"2", None)])
    batch = batch.withColumn("store_error", F.when(F.col("filename") == "b.pdf", "disk full"))
    nothing = spark.createDataFrame([], "doc_id long, file_hash string, original_filename string")
    out = {r.filename: r for r in ingest.trace(ingest.outcome(batch, nothing)).collect()}
    assert (out["a.pdf"].kind, out["b.pdf"].kind, out["b.pdf"].message) == ("new", "error", "disk full")
    assert (out["b.pdf"].trace[-1].label, out["b.pdf"].trace[-1].state) == (C.STEP_STORE_FILE, "fail")


def test_documents_round_trip_by_folder(spark, tmp_path):
    rows = [("a.pdf", INVOICE, PDF + b"1", None), ("b.pdf", "just some ordinary words", PDF + b"2", None)]
    results = ingest.processed(ingest.validated(files(spark, rows)))
    path = str(tmp_path / "library")
    tables.write_documents(ingest.stored_rows(results), path)
    back = tables.scan_documents(spark, path)
    got = {r.original_filename: r for r in back.collect()}
    assert got["a.pdf"].folder == "invoices" and got["b.pdf"].folder == "other"
    assert got["a.pdf"].fields["Invoice Number"] == "FF-31"
    assert got["a.pdf"].file_path.startswith("storage/invoices/20260101_000000_")
    once = tables.migrate(back)
    assert tables.migrate(once).columns == once.columns
    assert {r.workflow_status for r in once.collect()} == {"New"}
