"""Field checks on the stored fields map."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerleaf import constants as C
from ledgerleaf.functions.common import by_value, literal_array, literal_map, no_strings
from ledgerleaf.functions.extract import empty_fields
from ledgerleaf.functions.text import blank_to_null, strip_all

STRING_ARRAY = "array<string>"


def load_fields(fields_json: Column, sentinel_is_blank: bool = False) -> Column:
    """JSON object to MAP; NULL, '', broken JSON and other JSON give {}.

    With ``sentinel_is_blank`` a value that says 'not found' becomes NULL.
    """
    fields = F.coalesce(F.from_json(fields_json, "map<string,string>"), empty_fields())
    if not sentinel_is_blank:
        return fields
    return F.transform_values(fields, lambda _, v: F.nullif(v, F.lit(C.NOT_FOUND)))


def canonical_key(key: Column) -> Column:
    """Lower-case, trimmed, alias resolved with blanks and then underscores."""
    spaced = F.replace(F.lower(strip_all(key)), F.lit("_"), F.lit(" "))
    joined = F.replace(spaced, F.lit(" "), F.lit("_"))
    aliases = literal_map(C.FIELD_ALIASES)
    return F.coalesce(
        F.try_element_at(aliases, spaced), F.try_element_at(aliases, joined), joined
    )


def normalize_fields(fields: Column) -> Column:
    """MAP with canonical keys; the later of two keys that meet wins.

    A row has a handful of keys, so this stays inside the row: no shuffle.
    """
    renamed = F.transform(
        F.map_entries(fields),
        lambda e: F.struct(canonical_key(e["key"]).alias("key"), e["value"].alias("value")),
    )
    return renamed_map(renamed)


def renamed_map(entries: Column) -> Column:
    """MAP of the last entry of each key.

    Folded from the right end so that the first entry seen for a key is kept.
    """
    return F.map_from_entries(
        F.aggregate(
            F.reverse(entries),
            F.expr("CAST(array() AS ARRAY<STRUCT<key:STRING,value:STRING>>)"),
            lambda kept, e: F.when(
                F.exists(kept, lambda k: k["key"] == e["key"]), kept
            ).otherwise(F.array_append(kept, e)),
        )
    )


def is_blank(value: Column) -> Column:
    """NULL, only whitespace, or a JSON list whose items are all blank."""
    items = F.from_json(value, STRING_ARRAY)
    blank_list = F.startswith(value, F.lit("[")) & F.coalesce(
        F.forall(items, lambda v: F.coalesce(strip_all(v) == "", F.lit(False))), F.lit(False)
    )
    return value.isNull() | (strip_all(value) == "") | blank_list


def valid_email(value: Column) -> Column:
    return F.rlike(strip_all(value), F.lit(C.VALID_EMAIL_PATTERN))


def valid_phone(value: Column) -> Column:
    text = strip_all(value)
    digits = F.length(F.regexp_replace(text, r"\D", ""))
    return F.rlike(text, F.lit(C.VALID_PHONE_PATTERN)) & digits.between(*C.PHONE_DIGITS)


def valid_date(value: Column) -> Column:
    """One of the accepted shapes and a day that exists in the calendar.

    Month names are folded to title case, which is how Spark spells them; the
    digit-count guard refuses shapes that Spark alone would read leniently, and
    there is no year 0000.
    """
    text = strip_all(value)
    titled = F.regexp_replace(F.initcap(F.lower(text)), r"\s+", " ")
    hits = [
        F.rlike(text, F.lit(shape)) & F.try_to_timestamp(titled, F.lit(fmt)).isNotNull()
        for shape, fmt in C.DATE_FORMATS
    ]
    result = hits[0]
    for hit in hits[1:]:
        result = result | hit
    return F.coalesce(result & ~F.rlike(text, F.lit(C.YEAR_ZERO)), F.lit(False))


def parse_amount(value: Column) -> Column:
    """Digits, point, comma and minus kept, commas dropped, read as a number."""
    kept = F.regexp_replace(value, r"[^\d.,-]", "")
    return blank_to_null(F.replace(kept, F.lit(","), F.lit(""))).try_cast("double")


def valid_amount(value: Column) -> Column:
    return F.coalesce(parse_amount(value) > 0, F.lit(False))


# Checks on any present field: name -> function of the value giving a Boolean.
CHECKS = {
    "email": valid_email,
    "phone": valid_phone,
    "date": valid_date,
    "total_amount": valid_amount,
}


def required_fields(document_type: Column) -> Column:
    kind = strip_all(F.lower(document_type))
    choices = {name: literal_array(fields) for name, fields in C.REQUIRED_FIELDS.items()}
    return by_value(kind, choices, no_strings())


def missing_required(document_type: Column, canonical: Column) -> Column:
    return F.filter(
        required_fields(document_type),
        lambda name: is_blank(F.try_element_at(canonical, name)),
    )


def invalid_fields(canonical: Column, checks=CHECKS, reasons=C.INVALID_REASONS) -> Column:
    """ARRAY of (key, value): the field and why it is invalid, in check order."""
    tested = []
    for name, check in checks.items():
        value = F.try_element_at(canonical, F.lit(name))
        bad = ~is_blank(value) & ~F.coalesce(check(value), F.lit(False))
        tested.append(
            F.when(bad, F.struct(F.lit(name).alias("key"), F.lit(reasons[name]).alias("value")))
        )
    return F.array_compact(F.array(*tested))


def validation(document_type: Column, canonical: Column, missing: Column, invalid: Column, checks=CHECKS):
    """The full result as one STRUCT."""
    checked_names = literal_array(checks)
    present = F.filter(checked_names, lambda n: F.map_contains_key(canonical, n))
    failed = F.array_distinct(F.concat(missing, F.transform(invalid, lambda e: e["key"])))
    return F.struct(
        (F.size(failed) == 0).alias("is_valid"),
        missing.alias("missing_fields"),
        F.map_from_entries(invalid).alias("invalid_fields"),
        failed.alias("failed_fields"),
        F.array_sort(F.array_union(required_fields(document_type), present)).alias("checked"),
    )


def with_validation(df, document_type: str = "document_type", fields: str = "fields", checks=None, reasons=None):
    """Adds ``canonical``, ``missing``, ``invalid`` and ``validation``.

    ``checks`` (field -> function of its value) and ``reasons`` (field -> why it is
    invalid) add to the registered ones, or replace those of the same field.
    """
    checks, reasons = {**CHECKS, **(checks or {})}, {**C.INVALID_REASONS, **(reasons or {})}
    kind = F.col(document_type)
    return (
        df.withColumn("canonical", normalize_fields(F.col(fields)))
        .withColumns(
            {
                "missing": missing_required(kind, F.col("canonical")),
                "invalid": invalid_fields(F.col("canonical"), checks, reasons),
            }
        )
        .withColumn(
            "validation",
            validation(kind, F.col("canonical"), F.col("missing"), F.col("invalid"), checks),
        )
    )
