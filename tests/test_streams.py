"""Streams of landed files and of review requests, retries among them."""

from pyspark.sql import functions as F

from ledgerleaf.operators import ingest
from ledgerleaf.operators.workflow import change_status
from ledgerleaf.sources import landed, tables
from ledgerleaf.streaming import ingest_stream, workflow_stream

PDF = b"%PDF-1.4 "


def test_files_are_ingested_as_they_land(spark, tmp_path):
    inbox, out = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()

    def land(**files):
        for name, data in files.items():
            (inbox / f"{name}.pdf").write_bytes(data)
        feed = landed.stream_landed(spark, str(inbox), files_per_batch=2)
        ingest_stream.start_ingest(feed, out, str(tmp_path / "check")).awaitTermination()
        return {r.filename: r.kind for r in spark.read.parquet(f"{out}/outcomes").collect()}

    assert land(a=PDF + b"one", b=b"no magic") == {"a.pdf": "new", "b.pdf": "rejected"}
    got = land(c=PDF + b"one", d=PDF + b"two", e=PDF + b"three")
    assert got == {"a.pdf": "new", "b.pdf": "rejected", "c.pdf": "duplicate", "d.pdf": "new", "e.pdf": "new"}
    stored = spark.read.parquet(f"{out}/documents")
    assert stored.count() == 3 and stored.select("file_hash").distinct().count() == 3


def test_a_batch_that_runs_again_gives_the_same(spark, tmp_path):
    path = str(tmp_path / "out")
    files = spark.createDataFrame(
        [(1, "a.pdf", 5, PDF + b"x", "a long enough text"), (2, "b.pdf", 5, PDF + b"x", "a long enough text")],
        "doc_id long, filename string, size long, content binary, text string",
    ).withColumn("upload_ts", F.lit("2026-01-01").cast("timestamp_ntz"))
    spark.createDataFrame([], ingest_stream.LIBRARY).withColumn("prefix", F.lit("00")).write.partitionBy("prefix").parquet(f"{path}/library/batch_id=-1")
    for _ in range(2):
        ingest_stream.ingest_batch(files, 0, path)
        assert sorted((r.doc_id, r.kind) for r in spark.read.parquet(f"{path}/outcomes").collect()) == [(1, "new"), (2, "duplicate")]
        assert spark.read.parquet(f"{path}/library/batch_id=0").count() == 1


def test_extraction_errors_are_reviewed(spark):
    docs = spark.createDataFrame(
        [(1, "Invoice Number: INV-1 amount due total invoice", None, "no fields"), (2, "x", None, "no fields"), (3, "a long enough plain text", "broken", "no fields")],
        "doc_id long, text string, read_error string, extract_error string",
    ).withColumns({c: F.lit(None).cast("string") for c in ("store_error", "metadata_error")}).withColumn("kind", F.lit("new"))
    rows = {r.doc_id: r for r in ingest.trace(ingest.processed(docs)).withColumn("shown", ingest.trace_text(F.col("trace"))).collect()}
    assert (rows[1].status, rows[1].status_reason) == ("Needs Review", "Fields could not be extracted automatically.")
    assert "Extract=fail" in rows[1].shown and "Extract=skip" in rows[2].shown and "Extract=skip" in rows[3].shown
    assert rows[2].status == rows[3].status == "Failed"


def test_review_stream_equals_one_change(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workflow_stream, "SNAPSHOT_EVERY", 2)
    documents = spark.createDataFrame([(i, ["New", "Processing", "Needs Review"][i % 3]) for i in range(9)], "doc_id long, workflow_status string")
    states = ["Processing", "Needs Review", "Approved", "Completed", "New", "Nonsense"]
    asked = [(i * 7 % 10, i, states[i * 5 % 6], "changed", None) for i in range(60)]
    columns = "document_id long, seq long, new_state string, action string, reason string"
    whole = change_status(documents, spark.createDataFrame(asked, columns))
    path = str(tmp_path / "review")
    feed = str(tmp_path / "feed")
    for part in range(5):
        spark.createDataFrame(asked[part * 12 : part * 12 + 12], columns).coalesce(1).write.mode("append").parquet(feed)
    stream = spark.readStream.schema(columns).option("maxFilesPerTrigger", 1).parquet(feed)
    workflow_stream.start_review(stream, documents, path, str(tmp_path / "check"), first_id=5).awaitTermination()
    # The last batch again, as after a lost driver: nothing changes.
    last = spark.createDataFrame(asked[48:], columns)
    for again in (False, True):
        if again:
            workflow_stream.apply_batch(last, 4, path)
        rows = workflow_stream.reviewed(spark, path, "audit").collect()
        assert sorted(r.id for r in rows) == list(range(5, 5 + len(rows)))
        want = whole.audit.select("document_id", "previous_status", "new_status").collect()
        assert sorted((r.document_id, r.previous_status, r.new_status) for r in rows) == sorted(tuple(r) for r in want)
        refused = workflow_stream.reviewed(spark, path, "refused").collect()
        assert sorted((r.document_id, r.seq) for r in refused) == sorted((r.document_id, r.seq) for r in whole.refused.collect())
        got = {tuple(r) for r in workflow_stream.reviewed_states(spark, path).collect()}
        assert got == {(r.doc_id, r.workflow_status) for r in whole.documents.collect()}


def test_append_reads_marks_not_the_log(spark, tmp_path):
    path = str(tmp_path / "log")
    row = spark.createDataFrame([(1, 0, 0, "a", "New", "Processing", "")], "document_id long, pos long, step int, action string, previous_status string, new_status string, reason string")
    for _ in range(3):
        tables.append_audit(row, path)
    assert sorted(r.id for r in tables.scan_audit(spark, path).collect()) == [1, 2, 3]
    assert tables.last_audit_id(spark, path) == 3
    # Ids that a failed append had reserved are not given out again.
    spark.createDataFrame([(9,)], "last_id long").write.mode("append").parquet(path + "_marks")
    tables.append_audit(row, path)
    assert tables.last_audit_id(spark, path) == 10


def test_manifest_of_many_depths_and_repeated_names(spark):
    deep = ["s3://in/" + "/".join(f"d{k}" for k in range(n)) + "/doc.pdf" for n in range(1, 90)]
    files = spark.createDataFrame([(i, p, "doc.pdf", 5, PDF) for i, p in enumerate([*deep, "s3://in/d0/other/doc.pdf"])], "doc_id long, path string, filename string, size long, content binary")
    files = files.withColumn("upload_ts", F.lit("2026-01-01").cast("timestamp_ntz"))
    asked = [(p.removeprefix("s3://"), 5) for p in deep] + [("other/doc.pdf", 5), ("doc.pdf", 5), ("gone/doc.pdf", 5), ("empty.pdf", 0)]
    rows = landed.with_manifest(spark.createDataFrame(asked, "path string, size long"), files).collect()
    assert len(rows) == len(asked)
    found = {r.path: r for r in rows}
    assert all(not found[p].lost and found[p].content for p in deep[1:]) and not found["s3://in/d0/other/doc.pdf"].ambiguous
    assert [r.path for r in rows if r.ambiguous] == [min([*deep, "s3://in/d0/other/doc.pdf"])]
    assert found["gone/doc.pdf"].lost and not found["empty.pdf"].lost and found["empty.pdf"].size == 0


def test_slices_come_one_per_batch_in_many_files(spark):
    """Each slice is written by the tasks that hold it, and is one micro-batch."""
    from ledgerleaf.plans.queries import _in_slices
    from ledgerleaf.session import scratch_dir

    rows = spark.range(4000).selectExpr("id AS seq", "repeat('x', 50) AS text").repartition(8)
    checkpoint, seen = scratch_dir(spark, "checkpoint"), []

    def note(batch, batch_id):
        seen.append((batch_id, batch.agg({"seq": "min"}).first()[0], batch.count(), batch.selectExpr("input_file_name() AS f").distinct().count()))

    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        for feed in _in_slices(spark, rows, "seq", [1000, 1500], "parts"):
            feed.writeStream.foreachBatch(note).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [s[:3] for s in seen] == [(0, 0, 1000), (1, 1000, 500), (2, 1500, 2500)]
    assert all(s[3] > 1 for s in seen)


def test_a_batch_keeps_no_second_copy_of_its_bytes(spark, tmp_path, monkeypatch):
    """What a batch writes beside its results has neither bytes nor whole texts, and previews stay as they were."""
    from ledgerleaf.session import written

    path, tables_ = str(tmp_path / "out"), []
    text = "word " * 200
    files = spark.createDataFrame([(1, "a.pdf", 5, PDF + b"x", text)], "doc_id long, filename string, size long, content binary, text string")
    files = files.withColumn("upload_ts", F.lit("2026-01-01").cast("timestamp_ntz"))
    spark.createDataFrame([], ingest_stream.LIBRARY).withColumn("prefix", F.lit("00")).write.partitionBy("prefix").parquet(f"{path}/library/batch_id=-1")
    monkeypatch.setattr(ingest_stream, "written_freed", lambda df, purpose: tables_.append(written(df, purpose)) or tables_[-1])
    ingest_stream.ingest_batch(files, 0, path)
    assert len(tables_) == 1 and not {"content", "text"} & set(tables_[0].columns)
    preview = spark.read.parquet(f"{path}/documents/batch_id=0").first().text_preview
    assert preview == tables_[0].first().clean_text == ingest.stored_rows(ingest.processed(files).withColumn("ext", F.lit("pdf")).withColumn("file_hash", F.lit("0"))).first().text_preview


def test_slices_of_a_table_are_not_written_first(spark, monkeypatch):
    from ledgerleaf.plans import queries

    monkeypatch.setattr(queries, "written", None)
    rows = spark.range(9).withColumnRenamed("id", "seq")
    feeds = [f.isStreaming for f in queries._in_slices(spark, rows, "seq", [3, 6], "slices")]
    assert feeds == [True] * 3
