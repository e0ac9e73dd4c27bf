"""Audit log queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerleaf.session import written

# The order in which the rows of one run were made.
MADE = ("pos", "document_id", "step")


def audit_rows(events: DataFrame, stamped_at=None) -> DataFrame:
    """Rows ready to append: time filled in where absent, NULL reason as ''."""
    at = stamped_at if stamped_at is not None else F.current_timestamp()
    ts = F.coalesce("ts", at) if "ts" in events.columns else at
    return events.withColumns({"ts": ts, "reason": F.coalesce("reason", F.lit(""))})


def numbered(rows: DataFrame, first_id: int = 1, stamped_at=None, order=MADE) -> DataFrame:
    """Rows of an operator as rows of the log: ``id`` counts on from ``first_id`` in
    ``order``, without a gap, and ``ts`` is filled in.

    The rows are range-partitioned; a row's id is the number of rows in the ranges
    before its own and its place there, so no task meets them all.
    """
    ranged = written(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "audit")
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    starts = starts.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    placed = ranged.join(starts, "_part").withColumn("id", F.col("_start") + place + (first_id - 1))
    return audit_rows(placed, stamped_at).select(
        "id", "document_id", "action", "previous_status", "new_status", "ts", "reason"
    )


def history(audit: DataFrame, documents: DataFrame | None = None, document_id=None) -> DataFrame:
    """Audit rows of one document, of a table of ids, or of all, oldest first.

    The order is a range partitioning over (document, id), so a document with
    very many rows is spread over several tasks.
    """
    if document_id is not None:
        audit = audit.filter(F.col("document_id") == document_id)
    if documents is not None:
        ids = documents.select(F.col("doc_id").alias("document_id"))
        audit = audit.join(ids, "document_id", "left_semi")
    return audit.orderBy("document_id", "id").select(
        "document_id", "action", "previous_status", "new_status", "ts", "reason"
    )


def latest_actions(audit: DataFrame) -> DataFrame:
    """Last action and time per document: one partial and one final aggregate."""
    return (
        audit.groupBy("document_id")
        .agg(F.max_by(F.struct("action", "ts"), "id").alias("_last"))
        .select(
            "document_id",
            F.col("_last.action").alias("latest_action"),
            F.col("_last.ts").alias("latest_timestamp"),
        )
    )


def with_latest_action(documents: DataFrame, audit: DataFrame) -> DataFrame:
    last = latest_actions(audit).withColumnRenamed("document_id", "doc_id")
    return documents.join(last, "doc_id", "left")
