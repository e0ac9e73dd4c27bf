"""Small helpers shared by the Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def by_value(col: Column, choices: dict[str, Column], default: Column) -> Column:
    """The choice for the value of ``col``; the others are not evaluated."""
    chain = F
    for value, result in choices.items():
        chain = chain.when(col == value, result)
    return chain.otherwise(default)


def literal_map(pairs: dict) -> Column:
    return F.create_map(*(F.lit(part) for pair in pairs.items() for part in pair))


def literal_array(values) -> Column:
    return F.array(*(F.lit(v) for v in values)).cast("array<string>")


def no_strings() -> Column:
    return literal_array(())
