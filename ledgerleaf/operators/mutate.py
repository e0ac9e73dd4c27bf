"""Bulk updates, deletes and corrections: new snapshots from change tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerleaf import constants as C
from ledgerleaf.functions.extract import found, render_fields
from ledgerleaf.functions.fields import load_fields
from ledgerleaf.functions.status import with_status
from ledgerleaf.functions.text import blank_to_null, strip_all
from ledgerleaf.functions.upload import folder_for, stored_path


def last_change(changes: DataFrame, key: str = "doc_id", order: str = "seq") -> DataFrame:
    """One row per key: the last in ``order``, where the table has that column.

    Changes of one document follow each other and the last one stands.  Rows that
    share an order, or have none, are compared by their values.
    """
    values = [c for c in changes.columns if c not in (key, order)]
    if not values:
        return changes.select(key).distinct()
    simple = [c for c in values if not dict(changes.dtypes)[c].startswith("map")]
    shown = [F.to_json(F.struct(c)) for c in values if c not in simple]
    rank = F.struct(*([order] if order in changes.columns else []), *simple, *shown)
    last = changes.groupBy(key).agg(F.max_by(F.struct(*values), rank).alias("_last"))
    return last.select(key, "_last.*")


def apply_updates(documents: DataFrame, changes: DataFrame, order: str = "seq") -> DataFrame:
    """Replace the columns that ``changes`` has, in the rows it names.

    ``changes`` has ``doc_id``, updatable columns and, if ids repeat, ``order``.  A
    NULL there is a value like any other.  Adds ``changed``.
    """
    changes = last_change(changes, order=order)
    columns = [c for c in changes.columns if c != "doc_id"]
    unknown = sorted(set(columns) - set(C.UPDATABLE_COLUMNS))
    if unknown:
        raise ValueError(f"Cannot update column(s): {', '.join(unknown)}")
    if not columns:
        return documents.withColumn("changed", F.lit(False))
    new = changes.select("doc_id", F.struct(*columns).alias("_new"))
    hit = F.col("_new").isNotNull()
    return documents.join(new, "doc_id", "left").select(
        *(
            F.when(hit, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
            for c in documents.columns
        ),
        hit.alias("changed"),
    )


def apply_deletes(documents: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(survivors, removed rows).  Ids that are not stored remove nothing."""
    doomed = ids.select("doc_id").distinct()
    return (
        documents.join(doomed, "doc_id", "left_anti"),
        documents.join(doomed, "doc_id", "left_semi"),
    )


def delete_report(documents: DataFrame, ids: DataFrame) -> DataFrame:
    """Each requested id with the stored name and path, or NULL, and the message."""
    path = F.col("file_path") if "file_path" in documents.columns else stored_path(
        folder_for(F.col("document_type")), F.col("stored_filename")
    )
    stored = documents.select("doc_id", F.col("stored_filename").alias("removed_file"), path.alias("removed_path"))
    return ids.select("doc_id").distinct().join(stored, "doc_id", "left").withColumn(
        "message", F.when(F.col("removed_file").isNull(), C.MSG_GONE).otherwise(C.MSG_DELETED)
    )


def unknown_corrections(documents: DataFrame, corrections: DataFrame) -> DataFrame:
    """(doc_id, message) of the corrections whose document is not stored."""
    gone = corrections.select("doc_id").distinct().join(documents.select("doc_id"), "doc_id", "left_anti")
    return gone.withColumn("message", F.lit(C.MSG_GONE))


def apply_corrections(documents: DataFrame, corrections: DataFrame, order: str = "seq") -> DataFrame:
    """A person's corrected fields (doc_id, new_fields MAP) replace the stored.

    Values are trimmed; a blank one counts as not found.  Status and search
    columns follow from the new fields; the classifier's confidence does not
    matter any more.  Of several corrections of a document the last in ``order``
    stands; those of unknown documents are in ``unknown_corrections``.
    """
    corrections = last_change(corrections, order=order).select("doc_id", "new_fields")
    tidy = F.transform_values("new_fields", lambda _, v: blank_to_null(strip_all(v)))
    joined = documents.join(corrections.withColumn("_fields", tidy), "doc_id", "left")
    hit = F.col("new_fields").isNotNull()
    checked = with_status(
        joined.withColumns({"_status": F.col("status"), "_reason": F.col("status_reason")})
        if "status_reason" in documents.columns
        else joined.withColumns(
            {"_status": F.col("status"), "_reason": F.lit(None).cast("string")}
        ),
        fields="_fields",
        confidence=None,
    )
    new = {
        "status": F.col("status"),
        "status_reason": F.col("status_reason"),
        "fields_json": render_fields(F.col("_fields")),
        **{column: found(F.col("_fields"), name) for column, name in C.SEARCH_FIELDS.items()},
    }
    old = {"status": F.col("_status"), "status_reason": F.col("_reason")}
    kept = [c for c in documents.columns if c not in new]
    return checked.select(
        *kept,
        *(F.when(hit, v).otherwise(old.get(c, F.col(c))).alias(c) for c, v in new.items()),
        F.when(hit, F.format_string(C.MSG_CHANGES_SAVED, F.col("status"))).alias("message"),
    )


def stored_fields(documents: DataFrame) -> DataFrame:
    return documents.withColumn("fields", load_fields(F.col("fields_json")))
