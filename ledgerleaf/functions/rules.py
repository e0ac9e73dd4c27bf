"""Review rules: each gives a reason, or NULL when the document passes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerleaf import constants as C
from ledgerleaf.functions.text import blank_to_null, strip_all


def rule_unreadable(row: dict[str, Column]) -> Column:
    readable = F.exists(
        F.map_values(row["fields"]), lambda v: F.coalesce(strip_all(v) != "", F.lit(False))
    )
    return F.when(~F.coalesce(readable, F.lit(False)), C.MSG_NO_FIELDS)


def rule_unsupported_type(row: dict[str, Column]) -> Column:
    kind = F.coalesce(F.lower(row["document_type"]), F.lit(""))
    shown = F.coalesce(blank_to_null(kind), F.lit("none"))
    return F.when(~kind.isin(*C.SUPPORTED_TYPES), F.format_string(C.MSG_UNKNOWN_TYPE, shown))


def rule_low_confidence(row: dict[str, Column]) -> Column:
    shown = F.format_string("%.2f", F.bround(row["confidence"], 2))
    return F.when(
        row["confidence"] < C.WORKFLOW_CONFIDENCE, F.format_string(C.MSG_LOW_CONFIDENCE, shown)
    )


def rule_validation(row: dict[str, Column]) -> Column:
    details = F.transform(
        row["invalid"], lambda e: F.concat(e["key"], F.lit(" ("), e["value"], F.lit(")"))
    )
    return F.when(
        F.size(row["missing"]) > 0,
        F.format_string(C.MSG_MISSING, F.array_join(row["missing"], ", ")),
    ).when(
        F.size(row["invalid"]) > 0, F.format_string(C.MSG_INVALID, F.array_join(details, ", "))
    )


def rule_duplicate(row: dict[str, Column]) -> Column:
    return F.when(row["is_duplicate"], C.MSG_POSSIBLE_DUPLICATE)


# In order; the first reason wins.  Extend the list to add a rule.
RULES = [
    rule_unreadable,
    rule_unsupported_type,
    rule_low_confidence,
    rule_validation,
    rule_duplicate,
]


def with_decision(df, rules=None, is_duplicate: str | None = None):
    """Adds ``next_state``, ``action`` and ``reason``.

    Needs document_type, fields, confidence, missing and invalid.
    """
    row = {name: F.col(name) for name in ("document_type", "fields", "confidence", "missing", "invalid")}
    row["is_duplicate"] = F.col(is_duplicate) if is_duplicate else F.lit(False)
    hit = F.coalesce(*(rule(row) for rule in (rules or RULES)))
    failed = F.col("_hit").isNotNull()
    return (
        df.withColumn("_hit", hit)
        .withColumns(
            {
                "next_state": F.when(failed, C.NEEDS_REVIEW).otherwise(C.COMPLETED),
                "action": F.when(failed, C.ACTION_REVIEW).otherwise(C.ACTION_COMPLETED),
                "reason": F.coalesce("_hit", F.lit(C.NOTE_PASSED)),
            }
        )
        .drop("_hit")
    )
