"""Bulk workflow: status changes, batch runs, review decisions, failures.

Plain files have no in-place update, so every operator returns new DataFrames:
the next snapshot of the documents and the audit rows to append.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerleaf import constants as C
from ledgerleaf.functions import states
from ledgerleaf.functions.fields import load_fields, with_validation
from ledgerleaf.functions.rules import with_decision
from ledgerleaf.functions.text import blank_to_null, strip_all
from ledgerleaf.operators.dedup import ORDER, keys_of, repeats
from ledgerleaf.operators.mutate import last_change
from ledgerleaf.operators.replay import replay
from ledgerleaf.session import written

AUDIT_COLUMNS = (
    "document_id", "pos", "step", "action", "previous_status", "new_status", "reason",
)


@dataclass
class Change:
    """The next snapshot, audit rows to append, and requests that were refused."""

    documents: DataFrame
    audit: DataFrame
    refused: DataFrame


def change_status(documents: DataFrame, requests: DataFrame, extra: tuple[str, ...] = ()) -> Change:
    """Apply ordered requests (document_id, seq, new_state, action, reason).

    Each is judged against the state its predecessors left.  Refused requests
    (unknown document or forbidden transition) change nothing and write no
    audit row.  ``extra`` names columns of the requests that a change sets in the
    document along with its state.
    """
    known = documents.select(F.col("doc_id").alias("document_id"), "workflow_status")
    ids = known.select("document_id")
    valid = requests.join(ids, "document_id", "left_semi")
    judged = replay(valid, known, requested="new_state", keep=("new_state", "action", "reason", *extra))
    # Written, because snapshot, audit rows and refusals all come from it.
    history = written(judged, "history")
    audit = history.filter("applied").select(
        "document_id",
        F.col("seq").alias("pos"),
        F.lit(0).alias("step"),
        "action",
        "previous_status",
        F.col("new_state").alias("new_status"),
        F.coalesce("reason", F.lit("")).alias("reason"),
    )
    blocked = history.filter(~F.col("applied")).select(
        "document_id", "seq", transition_message(F.col("previous_status"), F.col("new_state")).alias("error")
    )
    unknown = requests.join(ids, "document_id", "left_anti").select(
        "document_id", "seq", not_found_message(F.col("document_id")).alias("error")
    )
    last = last_applied(history, extra)
    return Change(_overlaid(documents, last), audit, blocked.unionByName(unknown))


def last_applied(history: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, _new): what the last applied request of each document leaves."""
    new = F.struct(F.col("new_status").alias("workflow_status"), *extra)
    place = F.struct(F.coalesce(F.col("seq").cast("long"), F.lit(-1)), F.col("turn"))
    return history.filter("applied").groupBy(F.col("document_id").alias("doc_id")).agg(F.max_by(new, place).alias("_new"))


def judge_requests(documents: DataFrame, requests: DataFrame) -> DataFrame:
    """Requests (document_id, seq, requested_state) against the stored state:
    adds ``allowed`` and, where it is not, ``error``.  Nothing is changed.  A request
    on a document that is not stored is not allowed, and says so."""
    stored = documents.select(
        F.col("doc_id").alias("document_id"),
        states.current_state(F.col("workflow_status")).alias("_state"),
    )
    joined = requests.join(stored, "document_id", "left")
    known = F.col("_state").isNotNull()
    return joined.withColumns(
        {
            "allowed": known & states.can_transition(F.col("_state"), F.col("requested_state")),
            "error": F.when(~known, not_found_message(F.col("document_id"))).otherwise(
                states.transition_error(F.col("_state"), F.col("requested_state"))
            ),
        }
    ).drop("_state")


def transition_message(current: Column, new: Column) -> Column:
    return F.format_string(C.MSG_TRANSITION, current, F.coalesce(new, F.lit("None")))


def not_found_message(document_id: Column) -> Column:
    return F.format_string(C.MSG_DOC_NOT_FOUND, F.coalesce(document_id.cast("string"), F.lit("None")))


@dataclass
class BatchRun:
    """Results of a workflow batch, next snapshot and audit rows."""

    results: DataFrame
    documents: DataFrame
    audit: DataFrame


def decide_documents(
    documents: DataFrame,
    rules=None,
    sentinel_is_blank: bool = True,
    is_duplicate: str | None = None,
) -> DataFrame:
    """Every document with its validation and the rules' decision."""
    loaded = documents.withColumn("fields", load_fields(F.col("fields_json"), sentinel_is_blank))
    return with_decision(with_validation(loaded), rules, is_duplicate)


def run_batch(
    documents: DataFrame,
    batch: DataFrame,
    rules=None,
    sentinel_is_blank: bool = True,
    processing_ms: float | None = None,
    is_duplicate: str | None = None,
) -> BatchRun:
    """Run the workflow for ``batch`` (pos, document_id, given_confidence).

    Documents with a content hash are flagged as duplicates if an earlier one has the
    same; ``is_duplicate`` names a column with flags of the caller's instead.

    The first request of a document runs when the document is new.  A later
    request of the same document finds the state the first one left, and is
    blocked.  The text work is done once per document, whatever the repeats;
    requests are then matched to their outcome.
    """
    first = batch.groupBy("document_id").agg(
        F.min_by(F.struct("pos", "given_confidence"), "pos").alias("_first")
    ).select(
        F.col("document_id").alias("doc_id"),
        F.col("_first.pos").alias("_first_pos"),
        F.col("_first.given_confidence").alias("_given"),
    )
    requested = documents.join(first, "doc_id").withColumns(
        {
            "_before": states.current_state(F.col("workflow_status")),
            "confidence": F.coalesce("_given", "confidence"),
        }
    )
    startable = states.can_transition(F.col("_before"), F.lit(C.PROCESSING))
    if is_duplicate is None and {"file_hash", *ORDER} <= set(documents.columns):
        later = repeats(written(keys_of(documents), "keys")).withColumn("_later", F.lit(True))
        requested = requested.join(later, "doc_id", "left").withColumn("_is_copy", F.col("_later").isNotNull())
        is_duplicate = "_is_copy"
    decided = decide_documents(requested.filter(startable), rules, sentinel_is_blank, is_duplicate).select(
        "doc_id",
        "_first_pos",
        "_before",
        "next_state",
        "action",
        "reason",
        "document_type",
        "confidence",
        F.to_json("validation").alias("validation_json"),
    )
    # Written, because results, audit rows and snapshot all come from it.
    decided = written(decided, "decided")
    outcomes = decided.select(
        F.col("doc_id").alias("document_id"),
        "_first_pos",
        "_before",
        F.col("next_state").alias("_after"),
        F.col("action").alias("_action"),
        F.col("reason").alias("_reason"),
    ).unionByName(
        requested.filter(~startable).select(
            F.col("doc_id").alias("document_id"),
            F.lit(None).cast("long").alias("_first_pos"),
            "_before",
            F.col("_before").alias("_after"),
            F.lit(None).cast("string").alias("_action"),
            F.lit(None).cast("string").alias("_reason"),
        )
    )
    matched = batch.join(outcomes, "document_id", "left")
    ran = F.coalesce(F.col("pos") == F.col("_first_pos"), F.lit(False))
    results = matched.select(
        "pos",
        "document_id",
        ran.alias("ok"),
        F.when(ran, F.col("_after")).alias("state"),
        F.when(F.col("_before").isNull(), not_found_message(F.col("document_id")))
        .when(ran, F.col("_reason"))
        .otherwise(transition_message(F.col("_after"), F.lit(C.PROCESSING)))
        .alias("reason"),
        F.col("_before").isNotNull().alias("found"),
        F.col("_before").alias("before"),
        F.col("_after").alias("after"),
        F.col("_action").alias("action"),
    )
    return BatchRun(results, _batch_snapshot(documents, decided, processing_ms), batch_audit(results))


def batch_audit(results: DataFrame) -> DataFrame:
    """Two audit rows per document that ran, one per blocked request, none for
    an unknown document."""

    def row(step, action, previous, new, reason):
        return F.struct(
            F.lit(step).alias("step"),
            action.alias("action"),
            previous.alias("previous_status"),
            new.alias("new_status"),
            reason.alias("reason"),
        )

    started = row(
        0, F.lit(C.ACTION_STARTED), F.col("before"), F.lit(C.PROCESSING), F.lit(C.NOTE_STARTED)
    )
    ended = row(1, F.col("action"), F.lit(C.PROCESSING), F.col("after"), F.col("reason"))
    blocked = row(0, F.lit(C.ACTION_BLOCKED), F.col("after"), F.col("after"), F.col("reason"))
    return (
        results.filter("found")
        .withColumn("_rows", F.when(F.col("ok"), F.array(started, ended)).otherwise(F.array(blocked)))
        .select(
            "document_id", "pos", F.inline("_rows")
        )
        .select(*AUDIT_COLUMNS)
    )


def _batch_snapshot(documents: DataFrame, decided: DataFrame, processing_ms: float | None) -> DataFrame:
    """Documents with the workflow columns of those that ran replaced."""
    ran = decided.select(
        "doc_id",
        F.struct(
            F.col("next_state").alias("workflow_status"),
            F.when(F.col("next_state") == C.NEEDS_REVIEW, F.col("reason")).alias("review_reason"),
            F.col("validation_json"),
            blank_to_null(F.lower("document_type")).alias("predicted_type"),
            F.col("confidence").alias("confidence"),
            F.lit(False).alias("failed"),
            F.lit(None).cast("string").alias("last_error"),
            F.lit(processing_ms).cast("double").alias("processing_ms"),
        ).alias("_new"),
    )
    return _overlaid(documents, ran)


def _overlaid(documents: DataFrame, changes: DataFrame) -> DataFrame:
    """``documents`` with the fields of struct ``_new`` in the rows that have one."""
    types = {f.name: f.dataType for f in changes.schema["_new"].dataType.fields}
    joined = documents.join(changes, "doc_id", "left")
    changed = F.col("_new").isNotNull()
    old = {
        c: F.col(c) if c in documents.columns else F.lit(None).cast(types[c])
        for c in [*documents.columns, *(n for n in types if n not in documents.columns)]
    }
    return joined.select(
        *(
            F.when(changed, F.col(f"_new.{c}")).otherwise(value).alias(c) if c in types else value
            for c, value in old.items()
        )
    )


def batch_counts(results: DataFrame) -> DataFrame:
    ok, state = F.col("ok"), F.col("state")
    return results.agg(
        F.count_if(ok & (state == C.COMPLETED)).alias("processed"),
        F.count_if(ok & (state == C.NEEDS_REVIEW)).alias("review"),
        F.count_if(~ok).alias("failed"),
    )


def record_failures(documents: DataFrame, failures: DataFrame) -> Change:
    """Mark documents whose processing failed, by rows (document_id, pos, error); of
    several rows of a document the last stands.

    A document caught in the middle goes back to new.  Any other keeps its
    state.  Both are marked failed and get an audit row; unknown ids do not.
    """
    failed = failures.select(F.col("document_id").alias("doc_id"), "pos", "error")
    failed = last_change(failed.withColumn("seq", F.col("pos")))
    hit = documents.select("doc_id", "workflow_status").join(failed, "doc_id")
    stuck = F.col("workflow_status") == C.PROCESSING
    changes = hit.select(
        "doc_id",
        F.struct(
            F.when(stuck, C.NEW).otherwise(F.col("workflow_status")).alias("workflow_status"),
            F.lit(True).alias("failed"),
            F.col("error").alias("last_error"),
        ).alias("_new"),
    )
    audit = hit.select(
        F.col("doc_id").alias("document_id"),
        "pos",
        F.lit(0).alias("step"),
        F.lit(C.ACTION_FAILED).alias("action"),
        F.when(stuck, C.PROCESSING).alias("previous_status"),
        F.when(stuck, C.NEW).alias("new_status"),
        F.coalesce("error", F.lit("")).alias("reason"),
    )
    refused = failed.join(documents.select("doc_id"), "doc_id", "left_anti").select(
        F.col("doc_id").alias("document_id"), F.col("pos").alias("seq"), "error"
    )
    return Change(_overlaid(documents, changes), audit, refused)


def review_requests(decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Decisions (document_id, seq, decision, note) as status requests, and those
    refused: rejections that give no reason, and decisions that are none."""
    table = {
        name: F.struct(
            F.lit(action).alias("action"), F.lit(state).alias("new_state"), F.lit(note).alias("note")
        )
        for name, (action, state, note) in C.REVIEW_ACTIONS.items()
    }
    pairs = (x for name, row in table.items() for x in (F.lit(name), row))
    looked_up = decisions.withColumn(
        "_act", F.try_element_at(F.create_map(*pairs), F.col("decision"))
    )
    note = F.coalesce("note", F.lit(""))
    unreasoned = F.coalesce((F.col("decision") == "reject") & (strip_all(note) == ""), F.lit(False))
    unknown = F.col("_act").isNull()
    reason = (
        F.when(F.col("decision") == "approve", F.coalesce(blank_to_null(note), F.col("_act.note")))
        .when(F.col("decision") == "reject", strip_all(note))
        .otherwise(F.col("_act.note"))
    )
    requests = looked_up.filter(~unreasoned & ~unknown).select(
        "document_id",
        "seq",
        F.col("_act.new_state").alias("new_state"),
        F.col("_act.action").alias("action"),
        reason.alias("reason"),
    )
    said = F.format_string(C.MSG_DECISION, F.coalesce("decision", F.lit("None")))
    refused = looked_up.filter(unreasoned | unknown).select(
        "document_id", "seq", F.when(unreasoned, C.REJECT_NEEDS_REASON).otherwise(said).alias("error")
    )
    return requests, refused


def review(documents: DataFrame, decisions: DataFrame) -> Change:
    requests, unreasoned = review_requests(decisions)
    change = change_status(documents, requests)
    return Change(change.documents, change.audit, change.refused.unionByName(unreasoned))
