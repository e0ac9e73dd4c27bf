"""Exact duplicates by content hash.

Documents are large, their keys (hash, time, id) are not.  Every operator finds
the duplicates on the keys alone, writes their ids to a table, and then drops
or marks them by id.  Spark knows the size of that table when it plans the last
join: the documents move only if the duplicates are too many to broadcast.

A group of identical files may be huge.  Its first row comes from a partial
aggregate, and rows meet it in plain joins, whose skewed partitions adaptive
execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerleaf.session import written

ORDER = ("upload_ts", "doc_id")
HASH, ID = "file_hash", "doc_id"


def keys_of(df: DataFrame, order=ORDER) -> DataFrame:
    """(hash, order columns) of the rows that have a hash."""
    return df.select(HASH, *order).filter(F.col(HASH).isNotNull())


def repeats(keys: DataFrame, order=ORDER) -> DataFrame:
    """Ids of all rows but the first of their hash, in ``order``."""
    firsts = keys.groupBy(HASH).agg(F.min(F.struct(*order)).alias("_first"), F.count("*").alias("_rows"))
    firsts = firsts.filter(F.col("_rows") > 1).select(HASH, F.col(f"_first.{ID}").alias("_first_id"))
    return written(keys.join(firsts, HASH).filter(F.col(ID) != F.col("_first_id")).select(ID), "repeats")


def keep_first(df: DataFrame, order=ORDER) -> DataFrame:
    """One row per hash, the earliest.  Rows without a hash stay.

    The keys are written first, so a hash that has to be computed is computed once
    for them and once for the rows that are kept.
    """
    return df.join(repeats(written(keys_of(df, order), "keys"), order), ID, "left_anti")


def flag_repeats(df: DataFrame, flag: str = "is_duplicate", order=ORDER) -> DataFrame:
    """Adds ``flag``: true for every row of a hash but the earliest."""
    later = repeats(written(keys_of(df, order), "keys"), order).withColumn("_later", F.lit(True))
    return df.join(later, ID, "left").select(*df.columns, F.col("_later").isNotNull().alias(flag))


def match_library(batch: DataFrame, library: DataFrame) -> DataFrame:
    """The batch with ``existing_id`` and ``existing_filename`` (NULL if new).

    ``library`` has one row per hash, with ``doc_id`` and ``original_filename``.
    """
    keys = written(keys_of(batch), "keys")
    stored = library.select(
        HASH, F.col("doc_id").alias("existing_id"), F.col("original_filename").alias("existing_filename")
    )
    matches = written(keys.select(HASH, ID).join(stored, HASH).drop(HASH), "matches")
    return batch.join(matches, ID, "left")


def verdicts(keys: DataFrame, library: DataFrame) -> DataFrame:
    """The duplicates of a batch: (id, existing_id, existing_filename, repeated).

    A row is here if the library holds its hash, or if an earlier row of the batch
    has it (``repeated``); the existing row is the library's, or else that first row
    with the name it came with.  One aggregate on the hash gives the first row; the
    library is joined to it, not to the batch.  ``keys`` is read twice.
    """
    named = keys if "filename" in keys.columns else keys.withColumn("filename", F.lit(None).cast("string"))
    firsts = named.groupBy(HASH).agg(F.min(F.struct(*ORDER, "filename")).alias("_first"))
    stored = library.select(HASH, F.col("doc_id").alias("_stored_id"), F.col("original_filename").alias("_stored_name"))
    owners = firsts.join(stored, HASH, "left").select(
        HASH,
        F.col(f"_first.{ID}").alias("_first_id"),
        F.col("_first.filename").alias("_first_name"),
        "_stored_id",
        "_stored_name",
    )
    in_library, repeated = F.col("_stored_id").isNotNull(), F.col(ID) != F.col("_first_id")
    found = keys.select(HASH, ID).join(owners, HASH).filter(in_library | repeated).select(
        ID,
        F.coalesce("_stored_id", "_first_id").alias("existing_id"),
        F.when(in_library, F.col("_stored_name")).otherwise(F.col("_first_name")).alias("existing_filename"),
        repeated.alias("repeated"),
    )
    return written(found, "verdicts")


def new_rows(batch: DataFrame, library: DataFrame) -> DataFrame:
    """Rows to store: first of their hash in the batch and not in the library."""
    return batch.join(verdicts(keys_of(batch), library), ID, "left_anti")
