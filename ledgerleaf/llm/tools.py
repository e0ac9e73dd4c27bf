"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math
import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

NO_ID = -1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_rows(docs: DataFrame, *columns: str) -> DataFrame:
    """``doc_id`` and the named columns alone, so that extra columns cannot clash.

    A null doc_id is read as -1.
    """
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), *columns)


def free_prefix(docs: DataFrame) -> str:
    """A prefix that no column of ``docs`` begins with, for columns added beside them."""
    prefix = "_"
    while any(c.startswith(prefix) for c in docs.columns):
        prefix += "_"
    return prefix


def text_bytes() -> Column:
    """The text as UTF-8 bytes, a null as none."""
    return F.coalesce(F.col("text"), F.lit("")).cast("binary")


def root_of(n: int) -> int:
    """About the square root: as many buckets as rows in each of them."""
    return max(1, math.isqrt(max(0, n)))


def running(df: DataFrame, group: str, key: list[str], amount: str, into: str, bucket: Column) -> DataFrame:
    """Add ``into``: the sum of ``amount`` over the rows of the group before this one.

    Rows of a group come in the order of ``bucket``, then ``key``.  Neither step meets
    a whole group: bucket totals are summed over the buckets, rows inside their bucket.
    ``group`` must not be null; ``df`` is read twice, so it should be a written table.
    """
    rows = df.withColumn("_bucket", bucket)
    span = (Window.unboundedPreceding, -1)
    across = Window.partitionBy(group).orderBy("_bucket").rowsBetween(*span)
    inside = Window.partitionBy(group, "_bucket").orderBy(*key).rowsBetween(*span)
    totals = rows.groupBy(group, "_bucket").agg(F.sum(amount).alias("_sum"))
    bases = totals.select(group, "_bucket", F.coalesce(F.sum("_sum").over(across), F.lit(0)).alias("_base"))
    return (
        rows.join(bases, [group, "_bucket"])
        .withColumn(into, F.col("_base") + F.coalesce(F.sum(amount).over(inside), F.lit(0)))
        .drop("_bucket", "_base")
    )


def hash_bucket(n_rows: int, *key: str) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(root_of(n_rows)))


def words(data: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; bytes know ASCII alone."""
    return data.lower().split()


def kept_by_worker(key: tuple, make: Callable[[], Any]) -> Any:
    """What ``make`` returns, made once in a Python worker and kept for its later tasks.

    Functions travel by value, so their own globals are new in every task; a module of
    the worker is not.
    """
    holder = sys.modules.setdefault("_ledgerleaf_worker", types.ModuleType("_ledgerleaf_worker"))
    found = holder.__dict__.setdefault("kept", {})
    if key not in found:
        found[key] = make()
    return found[key]


def batches(stream: Iterator[pa.RecordBatch], most_bytes: int) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``most_bytes``, one row at least."""
    for batch in stream:
        n = batch.num_rows
        if not n:
            continue
        step = max(1, int(n * most_bytes / max(1, batch.nbytes)))
        for at in range(0, n, step):
            yield batch.slice(at, step)


def text_slices(stream: Iterator[pa.RecordBatch], most_bytes: int) -> Iterator[pa.Table]:
    """The same rows gathered into tables of about ``most_bytes``; a longer row is alone."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches(stream, most_bytes):
        if held and size + batch.nbytes > most_bytes:
            yield pa.Table.from_batches(held)
            held, size = [], 0
        held.append(batch)
        size += batch.nbytes
    if held:
        yield pa.Table.from_batches(held)


def tree_sum(parts: DataFrame, kind: type, fan_in: int = 64) -> np.ndarray | None:
    """The sum of equally long arrays, which ``data`` of (part, data) holds zstd-packed;
    ``fan_in`` of them meet in a task.  None without rows.  The arrays' length must be
    fixed: one of them reaches the driver."""

    def add(key: tuple, rows: pa.Table) -> pa.Table:
        total = None
        for data in rows.column("data").to_pylist():
            values = np.frombuffer(zstandard.decompress(data), kind)
            total = values.copy() if total is None else total + values
        return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "data": pa.array([zstandard.compress(total.tobytes(), 1)], pa.binary())})

    n = parts.count()
    if not n:
        return None
    bucket = F.xxhash64("part")
    while True:
        n = -(-n // fan_in)
        parts = parts.withColumn("part", F.pmod(bucket, F.lit(n))).groupBy("part").applyInArrow(add, "part long, data binary")
        if n == 1:
            return np.frombuffer(zstandard.decompress(parts.first()["data"]), kind)
        bucket = F.col("part")


def with_texts(pairs: DataFrame, texts: DataFrame, member: str, hub: str) -> DataFrame:
    """Add ``text_<member>`` and ``text_<hub>`` to pairs of doc_ids.

    Texts move once by doc_id, and the pairs once more with the member's text, at every
    size alike.  A hub that is paired with very many is a skewed key of a plain join.
    ``pairs`` is read twice.
    """
    texts = texts.hint("merge")
    hubs = texts.join(pairs.select(F.col(hub).alias("doc_id")).distinct(), "doc_id", "left_semi").hint("merge")
    mine = texts.select(F.col("doc_id").alias(member), F.col("text_utf8").alias(f"text_{member}"))
    theirs = hubs.select(F.col("doc_id").alias(hub), F.col("text_utf8").alias(f"text_{hub}"))
    return pairs.join(mine, member).join(theirs, hub)
