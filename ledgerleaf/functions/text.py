"""Text cleaning and small text projections, all as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerleaf import constants as C

BLANKS = " \n"


def strip(col: Column) -> Column:
    """Trim blanks and line feeds at both ends (``trim`` drops blanks only)."""
    return F.btrim(col, F.lit(BLANKS))


def strip_all(col: Column) -> Column:
    """Trim every white space character, of ASCII and beyond, at both ends."""
    return F.btrim(col, F.lit(C.WHITE_SPACE))


def blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def clean_text(raw: Column) -> Column:
    """Printable ASCII and line feeds only, one blank between words, trimmed
    lines, at most one empty line in a row.  NULL gives ''.

    The patterns match only what has to change: a single blank between two
    words is left alone, so ordinary prose is copied rather than rewritten.
    """
    text = F.replace(raw, F.lit("\r\n"), F.lit("\n"))
    text = F.replace(text, F.lit("\r"), F.lit("\n"))
    text = F.regexp_replace(text, r"[^\x20-\x7E\n][^\x21-\x7E\n]*+| [^\x21-\x7E\n]++", " ")
    text = F.regexp_replace(text, r" \n ?|\n ", "\n")
    text = F.regexp_replace(text, r"\n{3,}", "\n\n")
    return F.coalesce(strip(text), F.lit(""))


def is_too_short(clean: Column) -> Column:
    return F.length(strip(clean)) < C.MIN_USEFUL_CHARS


def text_preview(clean: Column) -> Column:
    return F.substring(clean, 1, C.TEXT_PREVIEW_CHARS)


def failed_reason(notes: Column) -> Column:
    """Why no text was found: the reader's notes, or a hint without notes."""
    return F.when(
        F.coalesce(F.size(notes), F.lit(0)) > 0,
        F.concat_ws(" ", F.lit(C.MSG_NO_TEXT), F.array_join(notes, " ")),
    ).otherwise(F.lit(f"{C.MSG_NO_TEXT} {C.MSG_NO_TEXT_HINT}"))


def ascii_lower(col: Column) -> Column:
    """Fold A-Z only, as a case-insensitive LIKE on ASCII does."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
