"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app_name: str = "ledgerleaf", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings results depend on (UTC, ANSI) and AQE."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Text stages generate long methods.  The JVM does not compile methods
        # above 8,000 bytes; below the limit Spark splits them instead.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="ledgerleaf-")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which every executor sees.

    Only a local session without that setting gets a folder of its own machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/ledgerleaf/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` as a table in the scratch folder and scan it from there.

    Used where a wide intermediate feeds several branches of one plan: it is
    computed once and survives the loss of executors.
    """
    path = scratch_dir(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_parts(parts: Iterable[DataFrame], purpose: str) -> DataFrame:
    """``written_freed`` of tables with the same columns, one after another, as one table."""
    for i, df in enumerate(parts):
        if not i:
            path = scratch_dir(df.sparkSession, purpose)
        with _freeing(df.sparkSession):
            df.write.mode("append").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def _freeing(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


def written_freed(df: DataFrame, purpose: str) -> DataFrame:
    """``written``; the files that its shuffles leave go when the table is complete, and not
    only when the driver happens to collect its garbage."""
    with _freeing(df.sparkSession):
        return written(df, purpose)
