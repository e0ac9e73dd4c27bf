"""Named queries over the test tables: each wires inputs to an operator."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerleaf import constants as C
from ledgerleaf.functions import extract, fields, rules, status, text, upload
from ledgerleaf.functions.classify import with_rule_label
from ledgerleaf.functions.common import literal_array, no_strings
from ledgerleaf.operators import (
    audit,
    dedup,
    evaluate,
    ingest,
    metrics,
    models,
    mutate,
    pages,
    replay,
    search,
    split,
    tfidf,
    workflow,
)
from ledgerleaf.plans.corpus import corpus, table
from ledgerleaf.session import scratch_dir, written
from ledgerleaf.sources import landed as landed_source
from ledgerleaf.sources import tables
from ledgerleaf.sources.layout import spread
from ledgerleaf.streaming import ingest_stream, workflow_stream

LIBRARY_BEFORE = "2000-01-01"


# --- inputs -------------------------------------------------------------------
def clean_docs(spark: SparkSession, sf: str) -> DataFrame:
    docs = corpus(spark, sf, "docs_raw")
    return docs.withColumn("clean_text", text.clean_text(F.col("text")))


def labelled_docs(spark: SparkSession, sf: str) -> DataFrame:
    return clean_docs(spark, sf).select("doc_id", F.col("kind").alias("label"), "clean_text")


def loosely_labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Some labels are missing, and some are of a type that no rule knows."""
    label = F.when(F.col("doc_id") % 19 == 3, "Contract").otherwise(F.col("label"))
    return labelled_docs(spark, sf).withColumn("label", F.when(F.col("doc_id") % 17 != 5, label))


def extracted_docs(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.processed(corpus(spark, sf, "docs_raw"))


def stored(spark: SparkSession, sf: str) -> DataFrame:
    return corpus(spark, sf, "stored_docs")


def checked_docs(spark: SparkSession, sf: str) -> DataFrame:
    docs = stored(spark, sf)
    docs = docs.withColumn("fields", fields.load_fields(F.col("fields_json"), True))
    return fields.with_validation(docs)


def library_and_batch(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Uploads before the cut form the library, the later ones the batch."""
    files = corpus(spark, sf, "landed")
    early = F.col("upload_ts") < F.lit(LIBRARY_BEFORE).cast("timestamp_ntz")
    old = ingest.accepted(ingest.validated(files.filter(early)))
    old = dedup.keep_first(written(old.select("doc_id", "upload_ts", "file_hash", "filename"), "hashed"))
    library = old.select("doc_id", "file_hash", F.col("filename").alias("original_filename"))
    return written(library, "library"), files.filter(~early)


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Labels with the answers of three length rules standing in for models."""
    docs = table(spark, sf, "documents").select("doc_id", "n_chars")
    truth = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").otherwise("bad")
    long = F.col("n_chars")
    guesses = {
        "LogisticRegression": F.when(long > 900, "good").otherwise("bad"),
        "LinearSVM": F.when(long > 400, "good").when(long > 200, "toxic").otherwise("bad"),
        "NaiveBayes": F.lit("good"),
    }
    rows = F.explode(
        F.array(*(F.struct(F.lit(m).alias("model"), g.alias("predicted")) for m, g in guesses.items()))
    )
    return (
        table(spark, sf, "labels")
        .join(docs, "doc_id")
        .select("doc_id", truth.alias("label"), rows.alias("_r"))
        .select("doc_id", "label", "_r.model", "_r.predicted")
    )


def shown_time(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def entries_text(entries: Column) -> Column:
    """(key, value) pairs sorted by key as 'k=v; k=v'."""
    pairs = F.transform(
        F.array_sort(entries),
        lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("<null>"))),
    )
    return F.array_join(pairs, "; ")


# --- scans, sources, sinks ------------------------------------------------------
def scan_labelled(spark, sf):
    path = scratch_dir(spark, "labelled")
    docs = corpus(spark, sf, "docs_raw").select(F.col("kind").alias("label"), "text")
    (
        docs.write.option("header", "true").option("escape", '"').option("quoteAll", "true")
        .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
        .csv(path)
    )
    return landed_source.scan_labelled(spark, path).select("label", "clean_text")


def scan_landed(spark, sf):
    path = scratch_dir(spark, "landed")
    name = F.concat(F.lit("page "), F.col("page_id").cast("string"), F.lit(".pdf"))
    # A file per page costs far more than its bytes: every core writes some.
    landed = spread(table(spark, sf, "pages").select(name.alias("filename"), "html"))
    landed.write.partitionBy("filename").text(path)
    return landed_source.scan_landed(spark, path).select(
        "filename", "size", upload.content_hash(F.col("content")).alias("file_hash")
    )


def scan_manifest(spark, sf):
    """A list of whole paths, of their ends and of bare names, against files up to 80
    folders deep whose names repeat."""
    page = F.col("page_id")
    name = F.concat(F.lit("f"), page.cast("string"), F.lit("/p"), (page % 50).cast("string"), F.lit(".pdf"))
    path = F.concat(F.lit("s3://in/"), F.repeat(F.lit("d/"), (page % 80).cast("int")), name)
    pages_ = table(spark, sf, "pages").select(page, path.alias("path"), name.alias("name"), F.octet_length("html").cast("long").alias("size"))
    files = pages_.filter(page % 11 != 0).select(
        page.alias("doc_id"), "path", F.substring_index("path", "/", -1).alias("filename"),
        F.lit(None).cast("timestamp_ntz").alias("upload_ts"), "size", F.lit(None).cast("binary").alias("content"),
    )
    listed = F.when(page % 3 == 0, F.col("name")).when(page % 3 == 1, F.col("path")).otherwise(F.substring_index("name", "/", -1))
    found = landed_source.with_manifest(pages_.select(listed.alias("path"), "size"), files)
    return found.select("path", "filename", "size", "lost", "ambiguous")


def scan_documents(spark, sf):
    docs = tables.with_decoded_fields(stored(spark, sf))
    return docs.select("doc_id", entries_text(F.map_entries("fields")).alias("fields"))


def route_folder(spark, sf):
    return stored(spark, sf).select(
        "doc_id", "document_type", upload.folder_for(F.col("document_type")).alias("folder")
    )


def safe_filename(spark, sf):
    docs = corpus(spark, sf, "docs_raw")
    name = upload.stored_filename(
        F.col("filename"),
        upload.file_extension(F.col("filename")),
        F.col("upload_ts"),
        F.sha2("text", 256),
    )
    return docs.select("doc_id", name.alias("stored_filename"))


def append_documents(spark, sf):
    files = ingest.accepted(ingest.validated(corpus(spark, sf, "landed")))
    rows = ingest.stored_rows(ingest.processed(dedup.keep_first(files)))
    return rows.withColumn("upload_ts", shown_time("upload_ts"))


def audit_append(spark, sf):
    rows = audit.audit_rows(corpus(spark, sf, "audit_rows"))
    return rows.withColumn("ts", shown_time("ts"))


def migrate_documents(spark, sf):
    old = stored(spark, sf).select("doc_id", "original_filename", "confidence", "workflow_status")
    return tables.migrate(old)


# --- upload checks ---------------------------------------------------------------
def file_extension(spark, sf):
    return corpus(spark, sf, "docs_raw").select(
        "doc_id", "filename", upload.file_extension(F.col("filename")).alias("ext")
    )


def validate_upload(spark, sf):
    return ingest.validated(corpus(spark, sf, "landed")).select("doc_id", "ext", "upload_error")


def content_hash(spark, sf):
    return corpus(spark, sf, "landed").select(
        "doc_id", upload.content_hash(F.col("content")).alias("file_hash")
    )


def quarantine(spark, sf):
    return ingest.quarantined(ingest.validated(corpus(spark, sf, "landed")))


# --- duplicates --------------------------------------------------------------------
def dup_vs_library(spark, sf):
    library, batch = library_and_batch(spark, sf)
    matched = dedup.match_library(ingest.accepted(ingest.validated(batch)), library)
    return matched.select(
        "doc_id",
        "existing_id",
        F.when(
            F.col("existing_id").isNotNull(),
            F.format_string(C.MSG_DUPLICATE, F.col("existing_filename")),
        ).alias("message"),
    )


def hashed_docs(spark, sf):
    docs = corpus(spark, sf, "docs_raw")
    return docs.select("doc_id", "upload_ts", F.sha2("text", 256).alias("file_hash"))


def dedup_keep_first(spark, sf):
    return dedup.keep_first(hashed_docs(spark, sf)).select("doc_id", "file_hash")


def stream_dedup(spark, sf):
    """Arrivals land in three slices of time; each is one micro-batch."""
    inbox, library = scratch_dir(spark, "inbox"), scratch_dir(spark, "library")
    docs = hashed_docs(spark, sf)
    bounds = [None, "1997-01-01", "2000-01-01", None]
    for low, high in zip(bounds, bounds[1:]):
        part = docs
        if low:
            part = part.filter(F.col("upload_ts") >= F.lit(low).cast("timestamp_ntz"))
        if high:
            part = part.filter(F.col("upload_ts") < F.lit(high).cast("timestamp_ntz"))
        part.repartition(4).write.mode("append").parquet(inbox)
    feed = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 4).parquet(inbox)
    ingest_stream.start_dedup(feed, library, scratch_dir(spark, "checkpoint")).awaitTermination()
    return spark.read.schema(docs.schema).parquet(library).select("doc_id", "file_hash")


def outcomes(spark, sf):
    library, batch = library_and_batch(spark, sf)
    return ingest.outcome(batch, library)


def ingest_outcome(spark, sf):
    return outcomes(spark, sf).select("doc_id", "kind", "message")


def ingest_trace(spark, sf):
    traced = ingest.trace(outcomes(spark, sf))
    return traced.select("doc_id", ingest.trace_text(F.col("trace")).alias("trace"))


def _in_slices(spark, rows: DataFrame, by: str, bounds: list, purpose: str) -> Iterator[DataFrame]:
    """A feed of ``rows`` for each slice of ``by``, in order; a stream that takes up each
    where it ended the one before gets one slice per micro-batch, in as many files as it
    takes tasks to write them.  ``rows`` is read once for each, so it should be a table."""
    inbox = scratch_dir(spark, purpose)
    for low, high in zip([None, *bounds], [*bounds, None]):
        part = rows
        if low is not None:
            part = part.filter(F.col(by) >= low)
        if high is not None:
            part = part.filter(F.col(by) < high)
        part.write.mode("append").option("compression", "zstd").parquet(inbox)
        yield spark.readStream.schema(rows.schema).parquet(inbox)


def stream_ingest(spark, sf):
    """The files of ``ingest_outcome`` as they land, in three micro-batches."""
    library, batch = library_and_batch(spark, sf)
    cuts = [F.lit(day).cast("timestamp_ntz") for day in ("2000-09-01", "2001-02-01")]
    path, checkpoint = scratch_dir(spark, "ingested"), scratch_dir(spark, "checkpoint")
    for feed in _in_slices(spark, batch, "upload_ts", cuts, "landing"):
        ingest_stream.start_ingest(feed, path, checkpoint, library).awaitTermination()
    return ingest_stream.outcomes(spark, path).select("doc_id", "kind", "message")


def missing_ids(spark, sf):
    requested = corpus(spark, sf, "batch_ids").select(F.col("document_id").alias("doc_id"))
    return search.missing_ids(requested, stored(spark, sf))


# --- text ------------------------------------------------------------------------
def clean_text(spark, sf):
    return clean_docs(spark, sf).select("doc_id", "clean_text")


def too_short(spark, sf):
    return clean_docs(spark, sf).select(
        "doc_id", text.is_too_short(F.col("clean_text")).alias("too_short")
    )


def text_preview(spark, sf):
    return clean_docs(spark, sf).select(
        "doc_id", text.text_preview(F.col("clean_text")).alias("text_preview")
    )


def reader_notes() -> Column:
    both = [C.NOTE_NO_OCR, C.NOTE_OCR_FAILED]
    return (
        F.when(F.col("filename").endswith(".png"), literal_array(both[:1]))
        .when(F.lower("filename").endswith(".png"), literal_array(both))
        .otherwise(no_strings())
    )


def failed_reason(spark, sf):
    docs = clean_docs(spark, sf).withColumn("notes", reader_notes())
    return docs.filter(text.is_too_short(F.col("clean_text"))).select(
        "doc_id", text.failed_reason(F.col("notes")).alias("reason")
    )


def assemble_pages(spark, sf):
    return pages.assemble(table(spark, sf, "conversations"), doc="conv_id", page="turn")


# --- classification -----------------------------------------------------------------
def keyword_scores(spark, sf):
    scored = with_rule_label(clean_docs(spark, sf))
    return scored.select("doc_id", "invoice_score", "resume_score")


def rule_classify(spark, sf):
    return with_rule_label(clean_docs(spark, sf)).select("doc_id", "rule_label")


def tfidf_terms(spark, sf):
    frequency = tfidf.frequency_of(labelled_docs(spark, sf))
    return frequency.select("term", "df", F.round("idf", 6).alias("idf"))


def tfidf_weights(spark, sf):
    model = tfidf.TfIdf(labelled_docs(spark, sf))
    return model.fit_sums().select(
        "doc_id",
        "n_terms",
        F.round("sum_weight", 4).alias("sum_weight"),
        F.round("max_weight", 6).alias("max_weight"),
    )


def split_docs(spark, sf):
    return split.stratified_split(labelled_docs(spark, sf))


def stratified_split(spark, sf):
    return split.stratified_split(loosely_labelled(spark, sf)).select("doc_id", "label", "is_test")


def nb_relational(spark, sf):
    docs = written(split.stratified_split(loosely_labelled(spark, sf)), "split")
    model = tfidf.NaiveBayes(docs.filter(~F.col("is_test")))
    scored = model.predict(docs.filter("is_test"))
    return scored.select("doc_id", "predicted", F.round("score", 4).alias("score"))


def _trained(spark, sf, names):
    """Candidates on the whole vocabulary, and the documents that test them.
    The split is written first: training reads it several times."""
    docs = written(split_docs(spark, sf), "split")
    only = {name: models.CANDIDATES[name] for name in names}
    return models.train(docs.filter(~F.col("is_test")), candidates=only), docs.filter("is_test")


def train_logreg(spark, sf):
    return models.evaluate_all(*_trained(spark, sf, ["LogisticRegression"]))


def train_svm(spark, sf):
    return models.evaluate_all(*_trained(spark, sf, ["LinearSVM"]))


def train_evaluate_select(spark, sf):
    """All candidates, their evaluation and the choice among them."""
    fitted, test = _trained(spark, sf, C.CANDIDATES)
    name, _, metrics = models.select_best(fitted, test)
    return metrics.withColumn("chosen", F.col("model") == name)


def _bayes(spark, sf):
    """Naive Bayes of the training part, and the documents that test it."""
    docs = written(split.stratified_split(loosely_labelled(spark, sf)), "split")
    only = {"NaiveBayes": models.CANDIDATES["NaiveBayes"]}
    return models.train(docs.filter(~F.col("is_test")), candidates=only)["NaiveBayes"], docs.filter("is_test")


def ml_score(spark, sf):
    return models.score(*_bayes(spark, sf)).select("doc_id", "predicted", "confidence")


def process_with_model(spark, sf):
    """A saved and loaded model labels the test documents on their way through the
    whole pipeline; a model that cannot be loaded leaves them to the rules."""
    fitted, test = _bayes(spark, sf)
    path = scratch_dir(spark, "model")
    models.save_model(fitted, path)
    docs = test.select("doc_id", "clean_text").withColumn("text", F.col("clean_text"))
    done = [
        ingest.processed(models.classify(docs, models.load_model(spark, where), "NaiveBayes").drop("clean_text"), model_label="model_label")
        .select(F.lit(name).alias("model"), "doc_id", "document_type", "confidence", "classifier")
        for name, where in (("saved", path), ("absent", path + "-absent"))
    ]
    return done[0].unionByName(done[1])


def classify_with_fallback(spark, sf):
    docs = with_rule_label(clean_docs(spark, sf)).withColumns(
        {
            "model_label": F.when(F.col("filename").endswith(".pdf"), F.col("kind")),
            "confidence": F.lit(0.875),
            "classifier": F.lit("NaiveBayes"),
        }
    )
    return models.with_fallback(docs).select("doc_id", "document_type", "confidence", "classifier")


def eval_macro(spark, sf):
    return evaluate.macro_metrics(predictions(spark, sf), keys=("model",))


def confusion_matrix(spark, sf):
    rows = predictions(spark, sf).filter(F.col("model") == "LinearSVM")
    return evaluate.confusion_matrix(rows, ["bad", "good", "toxic"])


def best_model(spark, sf):
    return evaluate.best_model(eval_macro(spark, sf))


def evaluation_report(spark, sf):
    """The report of all models, written as JSON lines and read back."""
    path, rows = scratch_dir(spark, "report"), written(predictions(spark, sf), "predictions")
    metrics = written(evaluate.macro_metrics(rows, keys=("model",)), "metrics")
    best = evaluate.best_model(metrics).first()["best_model"]
    tables.write_report(metrics, evaluate.confusion_cells(rows, keys=("model",)), best, path)
    cell = F.transform("confusion", lambda c: F.concat(c["label"], F.lit(">"), c["predicted"], F.lit("="), c["n"].cast("string")))
    report = spark.read.schema("model STRING, accuracy DOUBLE, f1 DOUBLE, chosen BOOLEAN, confusion ARRAY<STRUCT<label: STRING, predicted: STRING, n: LONG>>").json(path)
    return report.select("model", "accuracy", "f1", "chosen", F.array_join(cell, "; ").alias("cells"))


def distinct_labels(spark, sf):
    return split.distinct_labels(labelled_docs(spark, sf))


# --- extraction -----------------------------------------------------------------------
def extraction(field: str, kind: str, column: str):
    def query(spark, sf):
        chain = extract.EXTRACTORS[kind][field]
        docs = extract.with_captures(
            clean_docs(spark, sf), {column: (chain, F.lit(True))}, "clean_text"
        )
        return docs.select("doc_id", column)

    return query


FIELD_COLUMNS = {
    "invoice_number": "Invoice Number",
    "date": "Date",
    "company": "Company Name",
    "total": "Total Amount",
    "name": "Name",
    "email": "Email",
    "phone": "Phone",
    "skills": "Skills",
}


def flat_fields() -> list[Column]:
    return [
        F.try_element_at("fields", F.lit(name)).alias(column)
        for column, name in FIELD_COLUMNS.items()
    ]


def extract_fields(spark, sf):
    return extracted_docs(spark, sf).select("doc_id", "document_type", *flat_fields())


def columns_from_fields(spark, sf):
    return extracted_docs(spark, sf).select("doc_id", "company", "invoice_number", "total_amount")


# --- ingest status ----------------------------------------------------------------------
def missing_important(spark, sf):
    docs = extracted_docs(spark, sf)
    return docs.select(
        "doc_id",
        status.missing_important(F.col("document_type"), F.col("fields")).alias("missing"),
    )


def determine_status(spark, sf):
    docs = clean_docs(spark, sf).withColumn("confidence", scored_confidence())
    docs = with_rule_label(docs, label="document_type")
    docs = status.with_status(extract.with_fields(docs))
    return docs.select("doc_id", "status", "status_reason")


def scored_confidence() -> Column:
    return F.when(F.col("doc_id") % 5 != 0, (F.col("doc_id") * 37 % 101).cast("double") / 100)


def ingest_status(spark, sf):
    unreadable = F.when(F.lower("filename").endswith(".jpeg"), C.MSG_UNREADABLE)
    docs = corpus(spark, sf, "docs_raw").withColumns(
        {"confidence": scored_confidence(), "notes": reader_notes(), "read_error": unreadable}
    )
    return ingest.processed(docs).select("doc_id", "document_type", "status", "status_reason")


def ingest_errors(spark, sf):
    """Reading fails for some files and extraction for others."""
    docs = corpus(spark, sf, "docs_raw").withColumns(
        {
            "read_error": F.when(F.col("doc_id") % 11 == 4, C.MSG_UNREADABLE),
            "extract_error": F.when(F.col("doc_id") % 7 == 3, F.concat(F.lit("no fields in "), "filename")),
        }
    )
    return ingest.processed(docs).select("doc_id", "document_type", "status", "status_reason", "company")


def process_corpus(spark, sf):
    return extracted_docs(spark, sf).select(
        "doc_id", "document_type", "status", "status_reason", "classifier", *flat_fields()
    )


def corpus_summary(spark, sf):
    return (
        extracted_docs(spark, sf)
        .groupBy("kind", "document_type", "status")
        .agg(F.count("*").alias("n"), F.count("total_amount").alias("with_total"))
    )


def apply_corrections(spark, sf):
    orders = table(spark, sf, "orders").select(
        (F.col("o_orderkey") * 3).alias("doc_id"),
        F.create_map(
            F.lit("Invoice Number"), F.concat(F.lit(" FIX-"), F.col("o_orderkey").cast("string")),
            F.lit("Date"), F.lit(""),
            F.lit("Company Name"), F.when(F.col("o_orderstatus") == "F", "  ").otherwise(" Fixed Ltd "),
            F.lit("Total Amount"), F.when(F.col("o_orderstatus") != "O", "12.00"),
        ).alias("new_fields"),
        F.lit(2).alias("seq"),
    )
    earlier = orders.filter(F.col("doc_id") % 4 == 0).select(
        "doc_id", F.create_map(F.lit("Company Name"), F.lit("Overruled Ltd")).alias("new_fields"), F.lit(1).alias("seq")
    )
    orders = orders.union(earlier)
    return mutate.apply_corrections(stored(spark, sf), orders).select(
        "doc_id", "status", "status_reason", "company", "invoice_number", "total_amount",
        "fields_json", "message",
    )


# --- field checks ---------------------------------------------------------------------------
def load_fields(spark, sf):
    docs = stored(spark, sf).withColumn("fields", fields.load_fields(F.col("fields_json")))
    return docs.select("doc_id", F.size("fields").alias("n_fields"))


def normalize_fields(spark, sf):
    return checked_docs(spark, sf).select(
        "doc_id", entries_text(F.map_entries("canonical")).alias("canonical")
    )


def field_value(name: str) -> Column:
    return F.try_element_at("canonical", F.lit(name))


def blank_fields(spark, sf):
    blank = F.map_filter("canonical", lambda _, v: fields.is_blank(v))
    return checked_docs(spark, sf).select(
        "doc_id", F.array_join(F.array_sort(F.map_keys(blank)), ", ").alias("blank")
    )


def missing_required(spark, sf):
    return checked_docs(spark, sf).select("doc_id", F.array_join("missing", ", ").alias("missing"))


def field_check(name: str, check, column: str):
    def query(spark, sf):
        value = field_value(name)
        return (
            checked_docs(spark, sf)
            .filter(value.isNotNull())
            .select("doc_id", value.alias("value"), check(value).alias(column))
        )

    return query


def validate_documents(spark, sf):
    v = F.col("validation")
    return checked_docs(spark, sf).select(
        "doc_id",
        v["is_valid"].alias("is_valid"),
        F.array_join(v["missing_fields"], ", ").alias("missing"),
        entries_text(F.map_entries(v["invalid_fields"])).alias("invalid"),
        F.array_join(v["failed_fields"], ", ").alias("failed_fields"),
        F.array_join(v["checked"], ", ").alias("checked"),
    )


# --- rules -------------------------------------------------------------------------------------
def rule_query(rule):
    def query(spark, sf):
        docs = checked_docs(spark, sf)
        row = {c: F.col(c) for c in ("document_type", "fields", "confidence", "missing", "invalid")}
        return docs.select("doc_id", rule(row).alias("reason"))

    return query


def rule_duplicate(spark, sf):
    docs = dedup.flag_repeats(stored(spark, sf))
    return docs.select(
        "doc_id", rules.rule_duplicate({"is_duplicate": F.col("is_duplicate")}).alias("reason")
    )


def decide(spark, sf):
    docs = dedup.flag_repeats(stored(spark, sf))
    decided = workflow.decide_documents(docs, is_duplicate="is_duplicate")
    return decided.select("doc_id", "next_state", "action", "reason")


# --- workflow -------------------------------------------------------------------------------------
def transition_valid(spark, sf):
    judged = workflow.judge_requests(stored(spark, sf), corpus(spark, sf, "wf_events"))
    return judged.select("document_id", "seq", "allowed")


def transition_blocked(spark, sf):
    judged = workflow.judge_requests(stored(spark, sf), corpus(spark, sf, "wf_events"))
    return judged.filter(~F.col("allowed")).select("document_id", "seq", "error")


def status_requests(spark, sf):
    return corpus(spark, sf, "wf_events").select(
        "document_id",
        "seq",
        F.col("requested_state").alias("new_state"),
        F.lit("changed").alias("action"),
        F.concat(F.lit("request "), F.col("seq").cast("string")).alias("reason"),
    )


def change_status(spark, sf):
    change = workflow.change_status(stored(spark, sf), status_requests(spark, sf))
    return change.documents.select("doc_id", "workflow_status")


def change_status_audit(spark, sf):
    change = workflow.change_status(stored(spark, sf), status_requests(spark, sf))
    return change.audit.select(
        "document_id", "pos", "action", "previous_status", "new_status", "reason"
    )


def batch_run(spark, sf):
    return workflow.run_batch(stored(spark, sf), corpus(spark, sf, "batch_ids"))


def workflow_batch(spark, sf):
    return batch_run(spark, sf).documents.select(
        "doc_id", "workflow_status", "review_reason", "predicted_type", "confidence", "failed",
        "last_error",
    )


def workflow_batch_audit(spark, sf):
    return batch_run(spark, sf).audit


def workflow_failures(spark, sf):
    results = batch_run(spark, sf).results
    return results.filter(~F.col("ok")).select("pos", "document_id", "reason")


def failure_records(spark, sf):
    """Processing errors reported for every document an order names."""
    orders = table(spark, sf, "orders")
    failures = orders.select(
        (F.col("o_orderkey") * 3).alias("document_id"),
        F.col("o_orderkey").alias("pos"),
        F.concat(F.lit("worker lost: "), F.col("o_orderpriority")).alias("error"),
    )
    again = failures.filter(F.col("pos") % 4 == 0)
    failures = failures.union(
        again.select("document_id", F.col("pos") + 1, F.concat(F.lit("again "), "error"))
    )
    change = workflow.record_failures(stored(spark, sf), failures)
    return change.audit.select("document_id", "action", "previous_status", "new_status", "reason")


def workflow_then_history(spark, sf):
    """What a batch reports, appended to a log in two parts and read back."""
    path = scratch_dir(spark, "log")
    rows = written(batch_run(spark, sf).audit, "audit")
    half = F.col("pos") % 2 == 0
    tables.append_audit(rows.filter(half), path)
    tables.append_audit(rows.filter(~half), path)
    log = tables.scan_audit(spark, path)
    return audit.history(log, stored(spark, sf)).drop("ts")


def batch_validation_json(spark, sf):
    """The stored validation of the documents that ran."""
    docs = batch_run(spark, sf).documents.filter("validation_json IS NOT NULL")
    seen = F.get_json_object("validation_json", "$.is_valid")
    return docs.select("doc_id", seen.cast("boolean").alias("is_valid"))


def batch_counts(spark, sf):
    return workflow.batch_counts(batch_run(spark, sf).results)


def review_actions(spark, sf):
    change = workflow.review(stored(spark, sf), corpus(spark, sf, "decisions"))
    return change.audit.select(
        "document_id", "pos", "action", "previous_status", "new_status", "reason"
    )


def review_refused(spark, sf):
    change = workflow.review(stored(spark, sf), corpus(spark, sf, "decisions"))
    return change.refused


def replay_workflow(spark, sf):
    judged = replay.replay(corpus(spark, sf, "wf_events"))
    return replay.final_states(judged)


def stream_workflow(spark, sf):
    inbox, out = scratch_dir(spark, "requests"), scratch_dir(spark, "states")
    events = corpus(spark, sf, "wf_events")
    top = events.agg(F.max("seq")).first()[0] + 1
    for low, high in ((0, top // 3), (top // 3, 2 * top // 3), (2 * top // 3, top)):
        part = events.filter((F.col("seq") >= low) & (F.col("seq") < high))
        part.repartition(4).write.mode("append").parquet(inbox)
    feed = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 4).parquet(inbox)
    workflow_stream.start_workflow(feed, out, scratch_dir(spark, "checkpoint")).awaitTermination()
    return workflow_stream.current_states(spark, out)


def _reviewed(spark, sf) -> str:
    requests = status_requests(spark, sf)
    top = requests.agg(F.max("seq")).first()[0] + 1
    path, checkpoint = scratch_dir(spark, "reviewed"), scratch_dir(spark, "checkpoint")
    for feed in _in_slices(spark, written(requests, "asked"), "seq", [top // 3, 2 * top // 3], "asked"):
        workflow_stream.start_review(feed, stored(spark, sf), path, checkpoint).awaitTermination()
    return path


def stream_workflow_audit(spark, sf):
    """The requests of ``change_status_audit`` as they arrive, in three micro-batches."""
    rows = workflow_stream.reviewed(spark, _reviewed(spark, sf), "audit")
    return rows.select("document_id", "action", "previous_status", "new_status", "reason")


def stream_workflow_states(spark, sf):
    return workflow_stream.reviewed_states(spark, _reviewed(spark, sf))


# --- audit ---------------------------------------------------------------------------------------------
def audit_history(spark, sf):
    rows = audit.history(corpus(spark, sf, "audit_rows"), stored(spark, sf))
    return rows.withColumn("ts", shown_time("ts"))


def latest_action(spark, sf):
    rows = audit.with_latest_action(
        table(spark, sf, "documents").select("doc_id"), corpus(spark, sf, "audit_rows")
    )
    return rows.withColumn("latest_timestamp", shown_time("latest_timestamp"))


# --- search ----------------------------------------------------------------------------------------------
def search_words(spark, sf):
    return search.filtered(stored(spark, sf), query="client 50% Urgent").select(
        "doc_id", "original_filename"
    )


def filter_type_status(spark, sf):
    return search.filtered(
        stored(spark, sf), document_type="Invoice", status="Needs Review"
    ).select("doc_id", "document_type", "status")


def filter_date_range(spark, sf):
    docs = search.filtered(stored(spark, sf), date_from="1996-03-01", date_to="2000-06-30")
    return docs.select("doc_id", shown_time("upload_ts").alias("upload_ts"))


def sort_documents(spark, sf):
    docs = search.search(stored(spark, sf), sort="oldest")
    return docs.select("doc_id", shown_time("upload_ts").alias("upload_ts"))


def page_documents(spark, sf):
    """The third page of the invoices, newest first."""
    docs = search.search(
        stored(spark, sf), document_type="Invoice", limit=C.PAGE_SIZE, offset=2 * C.PAGE_SIZE
    )
    return docs.select("doc_id", shown_time("upload_ts").alias("upload_ts"))


def count_filtered(spark, sf):
    return search.count(stored(spark, sf), query="client trading", status="Processed")


def workflow_search(spark, sf):
    rows = search.workflow_search(
        stored(spark, sf), corpus(spark, sf, "audit_rows"), status="New", query="inv_%5"
    )
    return rows.withColumn("latest_timestamp", shown_time("latest_timestamp"))


def lookup_ids(spark, sf):
    ids = corpus(spark, sf, "batch_ids").select(F.col("document_id").alias("doc_id"))
    return search.by_ids(stored(spark, sf), ids).select("doc_id", "original_filename", "status")


def review_queue(spark, sf):
    rows = search.workflow_search(
        stored(spark, sf), corpus(spark, sf, "audit_rows"), status=C.NEEDS_REVIEW
    )
    return rows.select("doc_id", "original_filename", "latest_action")


def document_cards(spark, sf):
    return search.cards(stored(spark, sf))


# --- aggregates --------------------------------------------------------------------------------------------
def library_stats(spark, sf):
    return metrics.library_stats(stored(spark, sf))


def dashboard_tiles(spark, sf):
    return metrics.dashboard_tiles(stored(spark, sf))


def workflow_metrics(spark, sf):
    return metrics.workflow_metrics(stored(spark, sf)).withColumn(
        "avg_processing_ms", F.round("avg_processing_ms", 6)
    )


def metrics_by_type(spark, sf):
    return metrics.metrics_by_type(stored(spark, sf))


def metrics_by_status(spark, sf):
    return metrics.metrics_by_status(stored(spark, sf))


def avg_processing(spark, sf):
    return metrics.average_processing(stored(spark, sf)).select(
        F.round("avg_processing_ms", 6).alias("avg_processing_ms")
    )


# --- mutation ------------------------------------------------------------------------------------------------
def apply_updates(spark, sf):
    changes = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F").select(
        (F.col("o_orderkey") * 3).alias("doc_id"),
        F.when(F.col("o_totalprice") > 200000, "Large Ltd").alias("company"),
        F.lit("Needs Review").alias("status"),
        F.lit(2).alias("seq"),
    )
    earlier = changes.withColumns({"company": F.lit("Overruled Ltd"), "seq": F.lit(1)})
    changes = changes.union(earlier.filter(F.col("doc_id") % 4 == 0))
    return mutate.apply_updates(stored(spark, sf), changes).select(
        "doc_id", "company", "status", "changed"
    )


def delete_requests(spark, sf):
    return corpus(spark, sf, "batch_ids").select(F.col("document_id").alias("doc_id"))


def apply_deletes(spark, sf):
    survivors, _ = mutate.apply_deletes(stored(spark, sf), delete_requests(spark, sf))
    return survivors.select("doc_id", "stored_filename")


def delete_report(spark, sf):
    return mutate.delete_report(stored(spark, sf), delete_requests(spark, sf))


QUERIES = {
    "scan_labelled": scan_labelled,
    "scan_landed": scan_landed,
    "scan_manifest": scan_manifest,
    "scan_documents": scan_documents,
    "route_folder": route_folder,
    "safe_filename": safe_filename,
    "append_documents": append_documents,
    "audit_append": audit_append,
    "migrate_documents": migrate_documents,
    "file_extension": file_extension,
    "validate_upload": validate_upload,
    "content_hash": content_hash,
    "quarantine": quarantine,
    "dup_vs_library": dup_vs_library,
    "dedup_keep_first": dedup_keep_first,
    "stream_dedup": stream_dedup,
    "ingest_outcome": ingest_outcome,
    "ingest_trace": ingest_trace,
    "missing_ids": missing_ids,
    "stream_ingest": stream_ingest,
    "clean_text": clean_text,
    "too_short": too_short,
    "text_preview": text_preview,
    "failed_reason": failed_reason,
    "assemble_pages": assemble_pages,
    "keyword_scores": keyword_scores,
    "rule_classify": rule_classify,
    "tfidf_terms": tfidf_terms,
    "tfidf_weights": tfidf_weights,
    "stratified_split": stratified_split,
    "train_logreg": train_logreg,
    "train_svm": train_svm,
    "train_evaluate_select": train_evaluate_select,
    "process_with_model": process_with_model,
    "nb_relational": nb_relational,
    "ml_score": ml_score,
    "classify_with_fallback": classify_with_fallback,
    "eval_macro": eval_macro,
    "confusion_matrix": confusion_matrix,
    "best_model": best_model,
    "evaluation_report": evaluation_report,
    "distinct_labels": distinct_labels,
    "extract_invoice_number": extraction("Invoice Number", C.INVOICE, "invoice_number"),
    "extract_date": extraction("Date", C.INVOICE, "date"),
    "extract_total": extraction("Total Amount", C.INVOICE, "total"),
    "extract_company": extraction("Company Name", C.INVOICE, "company"),
    "extract_email": extraction("Email", C.RESUME, "email"),
    "extract_phone": extraction("Phone", C.RESUME, "phone"),
    "extract_skills": extraction("Skills", C.RESUME, "skills"),
    "extract_name": extraction("Name", C.RESUME, "name"),
    "extract_fields": extract_fields,
    "columns_from_fields": columns_from_fields,
    "missing_important": missing_important,
    "determine_status": determine_status,
    "ingest_status": ingest_status,
    "ingest_errors": ingest_errors,
    "process_corpus": process_corpus,
    "corpus_summary": corpus_summary,
    "apply_corrections": apply_corrections,
    "load_fields": load_fields,
    "normalize_fields": normalize_fields,
    "blank_fields": blank_fields,
    "missing_required": missing_required,
    "valid_email": field_check("email", fields.valid_email, "valid"),
    "valid_phone": field_check("phone", fields.valid_phone, "valid"),
    "valid_date": field_check("date", fields.valid_date, "valid"),
    "parse_amount": field_check("total_amount", fields.parse_amount, "amount"),
    "valid_amount": field_check("total_amount", fields.valid_amount, "valid"),
    "validate_documents": validate_documents,
    "rule_unreadable": rule_query(rules.rule_unreadable),
    "rule_unsupported": rule_query(rules.rule_unsupported_type),
    "rule_low_confidence": rule_query(rules.rule_low_confidence),
    "rule_validation": rule_query(rules.rule_validation),
    "rule_duplicate": rule_duplicate,
    "decide": decide,
    "transition_valid": transition_valid,
    "transition_blocked": transition_blocked,
    "change_status": change_status,
    "change_status_audit": change_status_audit,
    "workflow_batch": workflow_batch,
    "workflow_batch_audit": workflow_batch_audit,
    "workflow_failures": workflow_failures,
    "failure_records": failure_records,
    "batch_counts": batch_counts,
    "workflow_then_history": workflow_then_history,
    "batch_validation_json": batch_validation_json,
    "review_actions": review_actions,
    "review_refused": review_refused,
    "replay_workflow": replay_workflow,
    "stream_workflow": stream_workflow,
    "stream_workflow_audit": stream_workflow_audit,
    "stream_workflow_states": stream_workflow_states,
    "audit_history": audit_history,
    "latest_action": latest_action,
    "search_words": search_words,
    "filter_type_status": filter_type_status,
    "filter_date_range": filter_date_range,
    "sort_documents": sort_documents,
    "page_documents": page_documents,
    "count_filtered": count_filtered,
    "workflow_search": workflow_search,
    "lookup_ids": lookup_ids,
    "review_queue": review_queue,
    "document_cards": document_cards,
    "library_stats": library_stats,
    "dashboard_tiles": dashboard_tiles,
    "workflow_metrics": workflow_metrics,
    "metrics_by_type": metrics_by_type,
    "metrics_by_status": metrics_by_status,
    "avg_processing": avg_processing,
    "apply_updates": apply_updates,
    "apply_deletes": apply_deletes,
    "delete_report": delete_report,
}
