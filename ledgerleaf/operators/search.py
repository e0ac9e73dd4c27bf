"""Search, filters, sorting and paging over the documents table."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerleaf import constants as C
from ledgerleaf.functions.text import ascii_lower
from ledgerleaf.operators.audit import with_latest_action


def _ascii_lower(text: str) -> str:
    return "".join(c.lower() if c.isascii() else c for c in text)


def matches_words(query: str, columns=C.SEARCH_COLUMNS) -> Column:
    """Every word occurs in at least one column, ASCII case folded.

    ``contains`` takes the word literally: nothing has to be escaped.
    """
    words = (query or "").split()
    if not words:
        return F.lit(True)

    def anywhere(word: str) -> Column:
        hits = (
            F.coalesce(F.contains(ascii_lower(F.col(c)), F.lit(_ascii_lower(word))), F.lit(False))
            for c in columns
        )
        return reduce(or_, hits)

    return reduce(and_, (anywhere(word) for word in words))


def in_days(column: str, date_from=None, date_to=None) -> Column:
    """Inclusive range of days, as a plain range of the bare column so that
    Parquet statistics can skip row groups."""
    condition = F.lit(True)
    if date_from:
        condition = condition & (F.col(column) >= F.lit(str(date_from)).cast("date"))
    if date_to:
        condition = condition & (F.col(column) < F.date_add(F.lit(str(date_to)).cast("date"), 1))
    return condition


def filtered(
    documents: DataFrame,
    query: str = "",
    document_type: str | None = None,
    status: str | None = None,
    date_from=None,
    date_to=None,
) -> DataFrame:
    """The cheap filters that reach the scan first, then the word search."""
    if document_type:
        documents = documents.filter(F.col("document_type") == document_type)
    if status:
        documents = documents.filter(F.col("status") == status)
    if date_from or date_to:
        documents = documents.filter(in_days("upload_ts", date_from, date_to))
    if (query or "").split():
        documents = documents.filter(matches_words(query))
    return documents


def ordered(documents: DataFrame, sort: str = "newest") -> DataFrame:
    direction = F.asc if sort == "oldest" else F.desc
    return documents.orderBy(direction("upload_ts"), direction("doc_id"))


def search(
    documents: DataFrame,
    query: str = "",
    document_type: str | None = None,
    status: str | None = None,
    date_from=None,
    date_to=None,
    sort: str = "newest",
    limit: int | None = None,
    offset: int = 0,
) -> DataFrame:
    """One page (or all) of the matching documents, in order."""
    result = ordered(
        filtered(documents, query, document_type, status, date_from, date_to), sort
    )
    if limit is not None:
        result = result.offset(offset).limit(limit) if offset else result.limit(limit)
    return result


def page_after(documents: DataFrame, after=None, sort: str = "newest", size: int = C.PAGE_SIZE):
    """The page following the row ``after`` = (upload_ts, doc_id).

    A key filter instead of an offset: deep pages cost what the first one does.
    """
    if after is not None:
        ts, doc_id = F.lit(after[0]), F.lit(after[1])
        earlier = F.col("upload_ts") > ts if sort == "oldest" else F.col("upload_ts") < ts
        tie = F.col("doc_id") > doc_id if sort == "oldest" else F.col("doc_id") < doc_id
        documents = documents.filter(earlier | ((F.col("upload_ts") == ts) & tie))
    return ordered(documents, sort).limit(size)


def count(documents: DataFrame, size: int = C.PAGE_SIZE, **filters) -> DataFrame:
    """Number of matches and the index of the last page."""
    return (
        filtered(documents, **filters)
        .agg(F.count("*").alias("n"))
        .withColumn(
            "last_page",
            F.greatest(F.lit(0), F.floor((F.col("n") - 1) / F.lit(size))).cast("long"),
        )
    )


def workflow_search(
    documents: DataFrame, audit: DataFrame, status: str | None = None, query: str = ""
) -> DataFrame:
    """Status filter and LIKE search of name, type and fields text, newest id
    first, with the latest audit action.  The query's % and _ are wildcards."""
    if status and status != "All":
        documents = documents.filter(F.col("workflow_status") == status)
    if query:
        pattern = "%" + _ascii_lower(query).replace("\\", "\\\\") + "%"
        hits = (
            F.coalesce(F.like(ascii_lower(F.col(c)), F.lit(pattern)), F.lit(False))
            for c in ("original_filename", "document_type", "fields_json")
        )
        documents = documents.filter(reduce(or_, hits))
    return (
        with_latest_action(documents, audit)
        .orderBy(F.desc("doc_id"))
        .select(
            "doc_id",
            "original_filename",
            "document_type",
            "workflow_status",
            *(c for c in ("review_reason",) if c in documents.columns),
            "confidence",
            "failed",
            "latest_action",
            "latest_timestamp",
        )
    )


def by_ids(documents: DataFrame, ids: DataFrame) -> DataFrame:
    """Documents named in ``ids``, which is reduced to distinct ids first."""
    return documents.join(ids.select("doc_id").distinct(), "doc_id", "left_semi")


def missing_ids(requested: DataFrame, documents: DataFrame) -> DataFrame:
    """Requested ids that are not stored, once each."""
    return requested.select("doc_id").distinct().join(
        documents.select("doc_id"), "doc_id", "left_anti"
    )


def cards(documents: DataFrame) -> DataFrame:
    """Display projections of a document."""
    return documents.select(
        "doc_id",
        F.coalesce(
            F.nullif("company", F.lit("")), F.nullif("invoice_number", F.lit("")), "document_type"
        ).alias("subtitle"),
        F.format_string(
            "%.1f KB", F.bround(F.coalesce("file_size", F.lit(0)) / F.lit(1024), 1)
        ).alias("size_label"),
        F.left("file_hash", F.lit(16)).alias("hash_prefix"),
        F.concat(
            F.lit("#"),
            F.col("doc_id").cast("string"),
            F.lit(" - "),
            F.col("original_filename"),
            F.lit(" ("),
            F.coalesce(F.nullif("document_type", F.lit("")), F.lit("unknown")),
            F.lit(") ["),
            F.coalesce("workflow_status", F.lit("None")),
            F.lit("]"),
        ).alias("label"),
    )
