"""Field extraction: regular expressions over cleaned text.

Every field is a chain of captures; a capture gives '' when it finds nothing,
and the next one is tried only then.  The chain steps are separate projections,
so no expression runs twice for a row.  A field that is not found is NULL in
the end; the sentinel text appears at output only.

``EXTRACTORS`` maps a document type to its fields: add an entry to extract more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerleaf import constants as C
from ledgerleaf.functions.common import by_value
from ledgerleaf.functions.text import blank_to_null, strip


def _capture(text: Column, pattern: str, flags: str = "", group: int = 1) -> Column:
    prefix = f"(?{flags})" if flags else ""
    return strip(F.regexp_extract(text, prefix + pattern, group))


def labelled_number(text: Column) -> Column:
    return _capture(text, C.INVOICE_NUMBER_PATTERN, "i")


def bare_number(text: Column) -> Column:
    return _capture(text, C.BARE_NUMBER_PATTERN)


def document_date(text: Column) -> Column:
    return _capture(text, C.DATE_PATTERN)


def total_amount(text: Column) -> Column:
    return _capture(text, C.TOTAL_PATTERN, "i")


def labelled_company(text: Column) -> Column:
    return F.substring(_capture(text, C.COMPANY_PATTERN, "i"), 1, C.COMPANY_CHARS)


def short_first_line(text: Column) -> Column:
    """The first line below the length limit that does not say 'invoice'."""
    return _capture(text, rf"^(?!.*invoice)(.{{1,{C.COMPANY_LINE_CHARS - 1}}})$", "im")


def email(text: Column) -> Column:
    """The address pattern, tried only at the start of a run of address
    characters so that one very long token costs linear time."""
    at_token_start = r"(?<![\w\.-])" + C.EMAIL_PATTERN.replace("]+@", "]++@", 1)
    return F.when(F.contains(text, F.lit("@")), _capture(text, at_token_start, group=0)).otherwise("")


def phone(text: Column) -> Column:
    return _capture(text, C.PHONE_PATTERN)


def skills(text: Column) -> Column:
    section = F.replace(_capture(text, C.SKILLS_PATTERN, "is"), F.lit("\n"), F.lit(" "))
    return F.substring(section, 1, C.SKILLS_CHARS)


def labelled_name(text: Column) -> Column:
    return F.substring(_capture(text, C.NAME_PATTERN, "i"), 1, C.NAME_CHARS)


def first_untitled_line(text: Column) -> Column:
    """The first line that is not the title of a resume."""
    titles = "|".join(C.RESUME_TITLES)
    return F.substring(_capture(text, rf"^(?!(?:{titles})$)(.+)$", "im"), 1, C.NAME_CHARS)


EXTRACTORS = {
    C.INVOICE: {
        "Invoice Number": [labelled_number, bare_number],
        "Date": [document_date],
        "Company Name": [labelled_company, short_first_line],
        "Total Amount": [total_amount],
    },
    C.RESUME: {
        "Name": [labelled_name, first_untitled_line],
        "Email": [email],
        "Phone": [phone],
        "Skills": [skills],
    },
}


def with_captures(df: DataFrame, wanted: dict[str, tuple[list, Column]], text: str) -> DataFrame:
    """Adds a column per entry of ``wanted``: name -> (captures, condition).

    The value is NULL where the condition does not hold or nothing is found.
    """
    for step in range(max(len(chain) for chain, _ in wanted.values())):
        columns = {}
        for name, (chain, condition) in wanted.items():
            if step == 0:
                columns[name] = F.when(condition, chain[0](F.col(text)))
            elif step < len(chain):
                columns[name] = F.when(F.col(name) == "", chain[step](F.col(text))).otherwise(
                    F.col(name)
                )
        df = df.withColumns(columns)
    return df.withColumns({name: blank_to_null(F.col(name)) for name in wanted})


def with_fields(
    df: DataFrame,
    document_type: str = "document_type",
    text: str = "clean_text",
    condition: Column | None = None,
    extractors=None,
) -> DataFrame:
    """Adds ``fields``: a MAP of the fields of the row's own type.

    The patterns of other types do not run, and none runs where ``condition``
    is false.
    """
    extractors = extractors or EXTRACTORS
    kind = F.col(document_type)
    names = {(t, n): f"_{t}_{n}" for t, fields in extractors.items() for n in fields}
    allowed = condition if condition is not None else F.lit(True)
    wanted = {
        column: (extractors[t][n], allowed & (kind == t)) for (t, n), column in names.items()
    }
    df = with_captures(df, wanted, text)
    maps = {
        t: F.create_map(*(x for n in fields for x in (F.lit(n), F.col(names[t, n]))))
        for t, fields in extractors.items()
    }
    value = F.when(~allowed, empty_fields()).otherwise(by_value(kind, maps, empty_fields()))
    return df.withColumn("fields", value).drop(*names.values())


def empty_fields() -> Column:
    return F.expr("CAST(map() AS MAP<STRING,STRING>)")


def found(fields: Column, name: str) -> Column:
    """The field's value, NULL for an absent, empty or sentinel value."""
    value = F.try_element_at(fields, F.lit(name))
    return F.when(value.isin("", C.NOT_FOUND), None).otherwise(value)


def search_columns(fields: Column) -> dict[str, Column]:
    """Company, invoice number and total as columns of their own."""
    return {column: found(fields, name) for column, name in C.SEARCH_FIELDS.items()}


def render_fields(fields: Column) -> Column:
    """JSON text of the fields with the sentinel for what was not found."""
    shown = F.transform_values(fields, lambda _, v: F.coalesce(v, F.lit(C.NOT_FOUND)))
    return F.to_json(shown)
