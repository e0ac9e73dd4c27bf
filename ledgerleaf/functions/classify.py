"""Keyword classifier."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerleaf import constants as C
from ledgerleaf.functions.common import literal_array


def keyword_score(lowered: Column, keywords) -> Column:
    """How many of the keywords occur as substrings.

    A filter over the list is one expression and no generated code for each keyword, and
    it parts the generated code of the chain: the JVM does not compile methods above 8,000
    bytes, and sessions with Spark's own limit (65,535) keep such methods whole.
    """
    occurring = F.filter(literal_array(keywords), lambda word: F.contains(lowered, word))
    return F.when(lowered.isNotNull(), F.size(occurring))


def label_from_scores(invoice_score: Column, resume_score: Column) -> Column:
    return (
        F.when((invoice_score == 0) & (resume_score == 0), C.OTHER)
        .when(invoice_score >= resume_score, C.INVOICE)
        .otherwise(C.RESUME)
    )


def with_rule_label(df, text: str = "clean_text", label: str = "rule_label"):
    """Adds both scores and the label.

    The lower-cased text and the scores sit in their own projections so that
    the optimizer computes each once.
    """
    return (
        df.withColumn("_lowered", F.lower(text))
        .withColumns(
            {
                "invoice_score": keyword_score(F.col("_lowered"), C.INVOICE_KEYWORDS),
                "resume_score": keyword_score(F.col("_lowered"), C.RESUME_KEYWORDS),
            }
        )
        .drop("_lowered")
        .withColumn(label, label_from_scores(F.col("invoice_score"), F.col("resume_score")))
    )
