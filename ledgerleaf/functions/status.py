"""Ingest status of a processed document."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerleaf import constants as C
from ledgerleaf.functions.common import by_value
from ledgerleaf.functions.extract import found
from ledgerleaf.functions.text import failed_reason


def missing_important(document_type: Column, fields: Column) -> Column:
    """Important fields without a value, in declared order: 'a, b', or ''."""
    choices = {
        kind: F.concat_ws(", ", *(F.when(found(fields, n).isNull(), F.lit(n)) for n in names))
        for kind, names in C.IMPORTANT_FIELDS.items()
    }
    return by_value(document_type, choices, F.lit(""))


def review_reason(missing: Column, confidence: Column) -> Column:
    """NULL when nothing has to be reviewed.  Confidence is a fraction."""
    percent = F.round(confidence * 100, 1)
    return F.when(missing != "", F.concat(F.lit("Missing: "), missing, F.lit("."))).when(
        percent < C.INGEST_CONFIDENCE * 100,
        F.format_string(C.MSG_UNSURE, F.bround(percent, 0).cast("int")),
    )


def with_status(df, document_type="document_type", fields="fields", confidence="confidence"):
    """Adds ``status`` and ``status_reason`` for documents whose text was read."""
    conf = F.col(confidence) if confidence else F.lit(None).cast("double")
    return (
        df.withColumn("_missing", missing_important(F.col(document_type), F.col(fields)))
        .withColumn("_review", review_reason(F.col("_missing"), conf))
        .withColumns(
            {
                "status": F.when(F.col("_review").isNull(), C.PROCESSED).otherwise(C.NEEDS_REVIEW),
                "status_reason": F.coalesce("_review", F.lit(C.MSG_ALL_FOUND)),
            }
        )
        .drop("_missing", "_review")
    )


def ingest_status(
    too_short: Column,
    extraction_failed: Column,
    review: Column,
    notes: Column,
    unreadable: Column,
) -> tuple[Column, Column]:
    """Status and reason over every outcome, the first that applies."""
    status = (
        F.when(unreadable.isNotNull() | too_short, C.FAILED)
        .when(extraction_failed | review.isNotNull(), C.NEEDS_REVIEW)
        .otherwise(C.PROCESSED)
    )
    reason = (
        F.when(unreadable.isNotNull(), unreadable)
        .when(too_short, failed_reason(notes))
        .when(extraction_failed, C.MSG_NOT_EXTRACTED)
        .otherwise(F.coalesce(review, F.lit(C.MSG_ALL_FOUND)))
    )
    return status, reason
