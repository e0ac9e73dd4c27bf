"""Replay, batch runs, reviews and failures against plain sequential code."""

import datetime as dt
import json
import random

from pyspark.sql import functions as F

from ledgerleaf import constants as C
from ledgerleaf.operators import audit, replay, workflow
from ledgerleaf.session import scratch_dir
from ledgerleaf.sources import tables
from ledgerleaf.streaming import ingest_stream, workflow_stream

REQUESTS = "document_id long, seq long, requested_state string"


def random_requests(n, docs, seed=1):
    rng = random.Random(seed)
    states = [*C.STATES[:-1], *C.STATES[:-1], C.COMPLETED, "Unknown"]
    # document 0 holds a third of all requests
    return [(0 if i % 3 == 0 else rng.randrange(docs), i * 5, rng.choice(states)) for i in range(n)]


def sequential(requests, initial=None):
    state, out = dict(initial or {}), {}
    for doc, seq, wanted in sorted(requests, key=lambda r: r[1]):
        now = state.get(doc, C.NEW)
        ok = wanted in C.TRANSITIONS[now]
        state[doc] = wanted if ok else now
        out[doc, seq] = (now, state[doc], ok)
    return state, out


def test_replay_in_small_chunks(spark):
    requests = random_requests(4000, 40)
    initial = {1: C.REJECTED, 2: C.COMPLETED, 3: C.NEEDS_REVIEW}
    start = spark.createDataFrame(list(initial.items()), "document_id long, workflow_status string")
    df = spark.createDataFrame(requests, REQUESTS).repartition(5)
    judged = replay.replay(df, start, chunk=16).collect()
    _, want = sequential(requests, initial)
    assert {(r.document_id, r.seq): (r.previous_status, r.new_status, r.applied) for r in judged} == want


def test_stream_equals_replay(spark, tmp_path):
    requests = random_requests(3000, 30, seed=2)
    inbox, out = str(tmp_path / "in"), str(tmp_path / "states")
    for k in range(3):
        part = requests[k * 1000 : (k + 1) * 1000]
        spark.createDataFrame(part, REQUESTS).repartition(2).write.mode("append").parquet(inbox)
    feed = spark.readStream.schema(REQUESTS).option("maxFilesPerTrigger", 2).parquet(inbox)
    workflow_stream.start_workflow(feed, out, str(tmp_path / "ck")).awaitTermination()
    want, _ = sequential(requests)

    def got(path):
        rows = workflow_stream.current_states(spark, path).collect()
        return {r.document_id: r.workflow_status for r in rows}, sum(r.requests for r in rows)

    assert got(out) == (want, 3000)
    smaller = str(tmp_path / "compacted")
    workflow_stream.compact(spark, out, smaller, upto=1)
    assert got(smaller) == (want, 3000)


def test_stream_dedup_keeps_first_and_survives_a_rerun(spark, tmp_path):
    schema = "doc_id long, upload_ts timestamp, file_hash string"
    rows = spark.range(600).select(
        F.col("id").alias("doc_id"),
        F.timestamp_seconds(F.col("id")).alias("upload_ts"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 100).cast("string")).alias("file_hash"),
    )
    inbox, library = str(tmp_path / "in"), str(tmp_path / "library")
    for k in range(3):
        rows.filter(f"doc_id DIV 200 = {k}").repartition(2).write.mode("append").parquet(inbox)
    feed = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(inbox)
    ingest_stream.start_dedup(feed, library, str(tmp_path / "ck")).awaitTermination()
    first = {}
    for r in rows.orderBy("doc_id").collect():
        first.setdefault(r.file_hash, r.doc_id)

    def stored():
        return {r.file_hash: r.doc_id for r in spark.read.schema(schema).parquet(library).collect()}

    assert stored() == first
    ingest_stream.store_batch(rows.filter("doc_id DIV 200 = 1"), 1, library)
    assert stored() == first


def documents(spark, rows):
    data = [
        (i, kind, json.dumps(f) if f is not None else None, None, state)
        for i, (kind, f, state) in enumerate(rows)
    ]
    return spark.createDataFrame(
        data, "doc_id long, document_type string, fields_json string, confidence double, workflow_status string"
    )


GOOD = {"invoice_number": "T-9", "date": "2017/8/3", "company_name": "Tin Roof Repairs", "total_amount": "430"}


def batch(spark, ids):
    return spark.createDataFrame(
        [(i, d, None) for i, d in enumerate(ids)], "pos long, document_id long, given_confidence double"
    )


def test_mixed_batch(spark):
    docs = documents(spark, [("invoice", GOOD, None), ("invoice", {}, "New"), ("invoice", GOOD, "Approved")])
    run = workflow.run_batch(docs, batch(spark, [0, 4711, 1, 0, 2]), processing_ms=1.5)
    assert workflow.batch_counts(run.results).first().asDict() == {"processed": 1, "review": 1, "failed": 3}
    reasons = {r.pos: r.reason for r in run.results.collect()}
    assert reasons[1] == "Document 4711 not found"
    assert reasons[3] == "Invalid transition: Completed -> Processing"
    assert reasons[4] == "Invalid transition: Approved -> Processing"
    actions = [(r.document_id, r.action) for r in run.audit.orderBy("pos", "step").collect()]
    assert actions == [
        (0, "processing_started"), (0, "auto_completed"), (1, "processing_started"),
        (1, "sent_to_review"), (0, "transition_blocked"), (2, "transition_blocked"),
    ]
    after = {r.doc_id: r for r in run.documents.collect()}
    assert [after[i].workflow_status for i in range(3)] == ["Completed", "Needs Review", "Approved"]
    assert after[0].review_reason is None and "unreadable" in after[1].review_reason
    assert after[0].processing_ms == 1.5 and after[2].processing_ms is None
    assert json.loads(after[0].validation_json)["is_valid"] is True
    assert after[0].confidence is None


def test_review_actions(spark):
    docs = documents(spark, [("invoice", {}, "Needs Review")] * 3)
    decisions = spark.createDataFrame(
        [
            (1, 0, "approve", "Checked"), (2, 0, "complete", None), (3, 1, "reject", "  "),
            (4, 1, "reject", " Illegible "), (5, 2, "complete", None), (6, 7, "approve", None),
        ],
        "seq long, document_id long, decision string, note string",
    )
    change = workflow.review(docs, decisions)
    assert [r.workflow_status for r in change.documents.orderBy("doc_id").collect()] == ["Completed", "Rejected", "Needs Review"]
    audit = [(r.document_id, r.action, r.reason) for r in change.audit.orderBy("pos").collect()]
    assert audit == [
        (0, "reviewer_approved", "Checked"),
        (0, "workflow_completed", "Approved document completed"),
        (1, "reviewer_rejected", "Illegible"),
    ]
    errors = {r.seq: r.error for r in change.refused.collect()}
    assert errors == {
        3: C.REJECT_NEEDS_REASON, 5: "Invalid transition: Needs Review -> Completed", 6: "Document 7 not found",
    }


def test_no_request_is_lost_or_multiplied(spark):
    docs = documents(spark, [("invoice", GOOD, None), ("invoice", GOOD, None)])
    asked = spark.createDataFrame(
        [(0, None, "Processing"), (0, 1, "Completed"), (0, 1, "Needs Review"), (1, 3, "Nowhere"), (1, 4, None), (8, 1, "Processing"), (None, 2, "New")],
        "document_id long, seq long, new_state string",
    ).withColumns({"action": F.lit("asked"), "reason": F.concat(F.lit("to "), "new_state"), "review_reason": F.concat(F.lit("because "), "new_state")})
    change = workflow.change_status(docs, asked, extra=("review_reason",))
    assert change.audit.count() + change.refused.count() == 7
    assert change.audit.filter("document_id = 0").count() == 2
    after = {r.doc_id: (r.workflow_status, r.review_reason) for r in change.documents.collect()}
    assert after == {0: ("Completed", "because Completed"), 1: (None, None)}
    judged = workflow.judge_requests(docs, asked.withColumnRenamed("new_state", "requested_state"))
    assert judged.count() == 7 and judged.filter("allowed").count() == 1
    assert {r.error for r in judged.filter("document_id = 8 OR document_id IS NULL").collect()} == {"Document 8 not found", "Document None not found"}


def test_replay_keeps_requests_without_and_with_equal_numbers(spark):
    rows = [(1, None, "Processing"), (1, 0, "Completed"), (1, 5000, "New"), (1, 5000, "Needs Review"), (2, None, "Completed")]
    judged = replay.replay(spark.createDataFrame(rows, REQUESTS), chunk=4)
    assert judged.count() == 5
    assert {(r.document_id, r.seq, r.applied) for r in judged.collect()} == {
        (1, None, True), (1, 0, True), (1, 5000, False), (2, None, False),
    }


def test_decisions_that_are_none_are_refused(spark):
    docs = documents(spark, [("invoice", {}, "Needs Review")])
    decisions = spark.createDataFrame(
        [(1, 0, None, " "), (2, 0, "postpone", None), (3, 0, "approve", None)], "seq long, document_id long, decision string, note string"
    )
    change = workflow.review(docs, decisions)
    assert {r.seq: r.error for r in change.refused.collect()} == {1: "Unknown decision: None", 2: "Unknown decision: postpone"}
    assert change.audit.count() == 1


def test_repeated_changes_leave_one_document(spark):
    docs = documents(spark, [("invoice", GOOD, "Processing"), ("invoice", GOOD, "New")])
    failures = spark.createDataFrame([(0, 1, "boom"), (0, 2, "again")], "document_id long, pos long, error string")
    after = workflow.record_failures(docs, failures).documents.collect()
    assert sorted((r.doc_id, r.last_error) for r in after) == [(0, "again"), (1, None)]


def test_a_second_copy_goes_to_review(spark):
    rows = [(i, "invoice", json.dumps(GOOD), None, None, "h", dt.datetime(2020, 1, 1 + i)) for i in range(2)]
    docs = spark.createDataFrame(
        rows, "doc_id long, document_type string, fields_json string, confidence double, workflow_status string, file_hash string, upload_ts timestamp"
    )
    run = workflow.run_batch(docs, batch(spark, [0, 1]))
    assert {r.document_id: r.reason for r in run.results.collect()} == {0: C.NOTE_PASSED, 1: C.MSG_POSSIBLE_DUPLICATE}


def test_reported_rows_come_back_from_the_log(spark, tmp_path):
    docs = documents(spark, [("invoice", GOOD, None), ("invoice", {}, "New")])
    run = workflow.run_batch(docs, batch(spark, [0, 1]))
    path = str(tmp_path / "log")
    tables.append_audit(run.audit, path)
    decisions = spark.createDataFrame([(9, 1, "approve", None)], "seq long, document_id long, decision string, note string")
    change = workflow.review(run.documents, decisions)
    tables.append_audit(change.audit, path)
    log = tables.scan_audit(spark, path)
    assert sorted(r.id for r in log.collect()) == [1, 2, 3, 4, 5] and log.filter("ts IS NULL").count() == 0
    last = {r.doc_id: r.latest_action for r in audit.with_latest_action(docs, log).collect()}
    assert last == {0: "auto_completed", 1: "reviewer_approved"}
    assert [r.action for r in audit.history(log, document_id=1).collect()] == ["processing_started", "sent_to_review", "reviewer_approved"]


def test_failures(spark):
    docs = documents(spark, [("invoice", GOOD, "Processing"), ("invoice", GOOD, "New")])
    failures = spark.createDataFrame([(0, 1, "boom"), (1, 2, "bad"), (9, 3, "x")], "document_id long, pos long, error string")
    change = workflow.record_failures(docs, failures)
    after = {r.doc_id: (r.workflow_status, r.failed, r.last_error) for r in change.documents.collect()}
    assert after == {0: ("New", True, "boom"), 1: ("New", True, "bad")}
    audit = [(r.previous_status, r.new_status) for r in change.audit.orderBy("pos").collect()]
    assert audit == [("Processing", "New"), (None, None)]
    assert [r.document_id for r in change.refused.collect()] == [9]


def test_scratch_is_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    one, two = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert one != two and (not shared or one.startswith(shared))
