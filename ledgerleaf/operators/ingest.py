"""Batch ingest: validate, hash, check for duplicates, process, report."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerleaf import constants as C
from ledgerleaf.functions import extract, status, upload
from ledgerleaf.functions.classify import with_rule_label
from ledgerleaf.functions.common import literal_map, no_strings
from ledgerleaf.functions.text import clean_text, is_too_short, text_preview
from ledgerleaf.operators.dedup import ORDER, verdicts
from ledgerleaf.session import written


def validated(files: DataFrame) -> DataFrame:
    """Adds ``ext``, ``upload_error`` and, for accepted files, ``file_hash``."""
    name, ext = F.col("filename"), F.col("ext")
    lost = F.col("lost") if "lost" in files.columns else None
    return (
        files.withColumn("ext", upload.file_extension(name))
        .withColumn("upload_error", upload.upload_error(name, ext, F.col("size"), F.col("content"), lost))
        .withColumn(
            "file_hash",
            F.when(F.col("upload_error").isNull(), upload.content_hash(F.col("content"))),
        )
    )


def accepted(files: DataFrame) -> DataFrame:
    return files.filter(F.col("upload_error").isNull())


def quarantined(files: DataFrame) -> DataFrame:
    """Rejected files with their reason and one-step trace."""
    return files.filter(F.col("upload_error").isNotNull()).select(
        "doc_id",
        "filename",
        F.col("upload_error").alias("reason"),
        trace_text(F.array(_step(C.STEP_VALIDATE, F.lit("fail")))).alias("trace"),
    )


def processed(docs: DataFrame, text: str = "text", model_label: str | None = None) -> DataFrame:
    """Clean, classify, extract and decide the status of every document.

    One narrow plan without a shuffle.  Each stage is its own projection, so
    the cleaned text and the label are computed once and then referred to.
    ``model_label`` names a column with a trained model's label; where it is
    NULL the keyword rule decides.  Optional columns ``notes`` (ARRAY),
    ``read_error``, ``extract_error``, ``used_ocr`` and ``confidence`` are honoured: a
    document whose extraction failed keeps its type, has no fields and is reviewed.
    """
    defaults = {
        "notes": no_strings(),
        "read_error": F.lit(None).cast("string"),
        "extract_error": F.lit(None).cast("string"),
        "used_ocr": F.lit(False),
        "confidence": F.lit(None).cast("double"),
        "classifier": F.lit(C.RULE_CLASSIFIER),
    }
    df = docs.withColumns({k: v for k, v in defaults.items() if k not in docs.columns})
    df = df.withColumn("clean_text", clean_text(F.col(text))).withColumn(
        "_failed", F.col("read_error").isNotNull() | is_too_short(F.col("clean_text"))
    )
    df = with_rule_label(df)
    chosen = F.coalesce(F.col(model_label), F.col("rule_label")) if model_label else F.col("rule_label")
    df = df.withColumn("document_type", F.when(F.col("_failed"), C.OTHER).otherwise(chosen))
    not_extracted = ~F.col("_failed") & F.col("extract_error").isNotNull()
    df = extract.with_fields(df, condition=~F.col("_failed") & F.col("extract_error").isNull())
    df = df.withColumn(
        "_missing", status.missing_important(F.col("document_type"), F.col("fields"))
    ).withColumn("_review", status.review_reason(F.col("_missing"), F.col("confidence")))
    state, reason = status.ingest_status(
        F.col("_failed"), not_extracted, F.col("_review"), F.col("notes"), F.col("read_error")
    )
    return df.withColumns(
        {
            "status": state,
            "status_reason": reason,
            **extract.search_columns(F.col("fields")),
        }
    ).drop("_missing", "_review", "_failed", "invoice_score", "resume_score", "rule_label")


def outcome(files: DataFrame, library: DataFrame | Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Kind of outcome and message of every uploaded file.

    A file repeats another when its hash is in the library, or when an earlier
    file of the same batch has it, as if the files came one after another; the
    message names the stored file.  ``library`` may be a function of the files' hashes
    that returns the part of the library to compare them with.  Optional columns ``store_error`` and
    ``metadata_error`` hold what went wrong when a new file was stored.
    """
    checked = validated(files)
    for column in ("store_error", "metadata_error"):
        if column not in checked.columns:
            checked = checked.withColumn(column, F.lit(None).cast("string"))
    # The bytes are hashed once into a narrow table that finds the duplicates.
    keys = written(checked.select("file_hash", *ORDER, "filename").filter("file_hash IS NOT NULL"), "keys")
    stored = library(keys) if callable(library) else library
    checked = checked.join(verdicts(keys, stored), "doc_id", "left")
    kind = (
        F.when(F.col("upload_error").isNotNull(), "rejected")
        .when(F.col("repeated").isNotNull(), "duplicate")
        .when(F.col("store_error").isNotNull() | F.col("metadata_error").isNotNull(), "error")
        .otherwise("new")
    )
    # Only files to store carry their text on: the others cost no text work.
    judged = checked.withColumn("kind", kind).withColumn(
        "text", F.when(F.col("kind").isin("new", "error"), F.col("text"))
    )
    results = processed(judged)
    message = (
        F.when(F.col("upload_error").isNotNull(), F.col("upload_error"))
        .when(F.col("existing_filename").isNotNull(), F.format_string(C.MSG_DUPLICATE, F.col("existing_filename")))
        .when(F.col("repeated").isNotNull(), C.MSG_DUPLICATE_RACE)
        .when(F.col("kind") == "error", F.coalesce("store_error", "metadata_error"))
        .otherwise(F.try_element_at(literal_map(C.MSG_SAVED), F.col("status")))
    )
    return results.withColumn("message", message)


def _step(label: str, state: Column) -> Column:
    return F.struct(F.lit(label).alias("label"), state.alias("state"))


def trace(outcomes: DataFrame) -> DataFrame:
    """Adds ``trace``: the (label, state) steps of every upload in order.

    A stop ends the list; steps after a failed one inside processing stay skip.
    """
    kind, error = F.col("kind"), F.col("read_error")
    short = is_too_short(F.col("clean_text"))
    ok = F.lit("ok")
    after_read = F.when(error.isNotNull(), "skip")
    after_clean = after_read.when(short, "skip").otherwise("ok")
    read = F.when(
        error.isNull() & F.col("used_ocr"), _step(C.STEP_READ_SCANNED, ok)
    ).otherwise(_step(C.STEP_READ, F.when(error.isNotNull(), "fail").otherwise("ok")))
    opening = F.array(_step(C.STEP_VALIDATE, ok), _step(C.STEP_HASH, ok))
    not_stored = F.col("store_error").isNotNull()
    last = F.array(_step(C.STEP_STORE_META, F.when(F.col("metadata_error").isNotNull(), "fail").otherwise("ok")))
    steps = (
        F.when(kind == "rejected", F.array(_step(C.STEP_VALIDATE, F.lit("fail"))))
        .when(
            kind == "duplicate", F.concat(opening, F.array(_step(C.STEP_DUPLICATE, F.lit("stop"))))
        )
        .otherwise(
            F.concat(
                opening,
                F.array(
                    _step(C.STEP_DUPLICATE, ok),
                    read,
                    _step(C.STEP_CLEAN, after_read.when(short, "fail").otherwise("ok")),
                    _step(C.STEP_CLASSIFY, after_clean),
                    _step(C.STEP_EXTRACT, F.when(after_clean == "skip", "skip").when(F.col("extract_error").isNotNull(), "fail").otherwise("ok")),
                    _step(C.STEP_STORE_FILE, F.when(not_stored, "fail").otherwise("ok")),
                ),
                F.when(not_stored, F.slice(last, 1, 0)).otherwise(last),
            )
        )
    )
    return outcomes.withColumn("trace", steps)


def trace_text(steps: Column) -> Column:
    return F.array_join(
        F.transform(steps, lambda s: F.concat(s["label"], F.lit("="), s["state"])), " > "
    )


def stored_rows(results: DataFrame, stored_at: Column | None = None) -> DataFrame:
    """Rows for the documents table with their defaults filled in."""
    at = stored_at if stored_at is not None else F.current_timestamp()
    if "upload_ts" in results.columns:
        at = F.coalesce(F.col("upload_ts"), at)
    return (
        results.withColumn("upload_ts", at)
        .withColumn("folder", upload.folder_for(F.col("document_type")))
        .withColumn(
            "stored_filename",
            upload.stored_filename(
                F.col("filename"), F.col("ext"), F.col("upload_ts"), F.col("file_hash")
            ),
        )
        .select(
            "doc_id",
            F.col("filename").alias("original_filename"),
            "stored_filename",
            "folder",
            upload.stored_path(F.col("folder"), F.col("stored_filename")).alias("file_path"),
            "document_type",
            "upload_ts",
            "company",
            "invoice_number",
            "total_amount",
            text_preview(F.col("clean_text")).alias("text_preview"),
            "file_hash",
            F.col("size").alias("file_size"),
            F.coalesce("used_ocr", F.lit(False)).alias("used_ocr"),
            "status",
            "status_reason",
            extract.render_fields(F.col("fields")).alias("fields_json"),
            "confidence",
        )
    )
