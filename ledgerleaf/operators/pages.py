"""Documents assembled from page rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerleaf.functions.text import strip_all

PAGES_PER_PART = 256


def assemble(pages: DataFrame, doc: str = "doc_id", page: str = "page_no", text: str = "text"):
    """One text per document: trimmed, non-empty pages in order, LF between.

    Pages are first joined to parts of ``PAGES_PER_PART`` page numbers, so the
    pages of a very long document are sorted and joined by many tasks; the last
    step only appends the parts.
    """
    parts = (
        pages.withColumn("_text", strip_all(F.col(text)))
        .withColumn("_part", F.floor(F.col(page) / F.lit(PAGES_PER_PART)))
        .groupBy(doc, "_part")
        .agg(_in_order(page, "_text").alias("_text"))
    )
    return parts.groupBy(doc).agg(strip_all(_in_order("_part", "_text")).alias(text))


def _in_order(position: str, text: str):
    """Texts joined by position.  '' stands for nothing and is left out."""
    rows = F.array_sort(F.collect_list(F.struct(position, text)))
    texts = F.transform(rows, lambda r: r[text])
    return F.array_join(F.filter(texts, lambda t: t != ""), "\n")
