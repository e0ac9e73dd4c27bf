"""Continuous ingest: exact first-wins deduplication of an unbounded feed.

Every micro-batch keeps the first row of each hash (a partial aggregate over
narrow columns, so a flood of copies does not meet in one task), drops what the
library already holds, and writes the survivors to the library folder of its
batch id.  A batch that is run again replaces its own folder and never looks at
it, so retries give the same library.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerleaf.functions.text import text_preview
from ledgerleaf.operators import ingest
from ledgerleaf.operators.dedup import keys_of, verdicts
from ledgerleaf.session import written_freed

BATCH = "batch_id"
# The first hex digits of a hash name the folder of the library that holds it.
PREFIX, PREFIX_DIGITS = "prefix", 1
LIBRARY = "file_hash STRING, doc_id LONG, original_filename STRING"


def store_batch(batch: DataFrame, batch_id: int, library_path: str) -> None:
    """Append the new rows of one micro-batch.  Of the library only hash and id
    are read, by a semi join that Spark can prune with the batch's hashes.
    Without a hash a row cannot be compared; it is stored."""
    schema = T.StructType([*batch.schema.fields, T.StructField(BATCH, T.LongType())])
    library = batch.sparkSession.read.schema(schema).parquet(library_path)
    earlier = library.filter(F.col(BATCH) != batch_id)
    keys = keys_of(batch).persist()
    stored = earlier.select(
        "file_hash", "doc_id", F.lit(None).cast("string").alias("original_filename")
    )
    try:
        new = batch.join(verdicts(keys, stored), "doc_id", "left_anti")
        new.select(*batch.columns).write.mode("overwrite").parquet(f"{library_path}/{BATCH}={batch_id}")
    finally:
        keys.unpersist()


def seed_library(rows: DataFrame, library_path: str) -> None:
    """Rows stored before the stream began, as batch -1.  Written once."""
    rows.write.mode("ignore").parquet(f"{library_path}/{BATCH}=-1")


def start_dedup(feed: DataFrame, library_path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Start the stream.  ``feed`` needs file_hash, upload_ts and doc_id."""
    seed_library(feed.sparkSession.createDataFrame([], feed.schema), library_path)
    return (
        feed.writeStream.foreachBatch(
            lambda batch, batch_id: store_batch(batch, batch_id, library_path)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _by_prefix(library: DataFrame) -> DataFrame:
    return library.withColumn(PREFIX, F.substring("file_hash", 1, PREFIX_DIGITS))


def library_rows(spark: SparkSession, path: str, keys: DataFrame, before: int) -> DataFrame:
    """What batches before ``before`` stored, of the prefixes that ``keys`` holds: at most
    16 of them, so their join prunes the folders that Spark reads."""
    schema = f"{LIBRARY}, {BATCH} LONG, {PREFIX} STRING"
    rows = spark.read.schema(schema).parquet(f"{path}/library").filter(F.col(BATCH) < before)
    wanted = _by_prefix(keys.select("file_hash")).select(PREFIX).distinct()
    return rows.join(F.broadcast(wanted), PREFIX, "left_semi").select("file_hash", "doc_id", "original_filename")


def ingest_batch(files: DataFrame, batch_id: int, path: str) -> None:
    """Validate, hash, compare, process and store one micro-batch of landed files.

    Below ``path``: ``outcomes`` (every file with kind, message and trace), ``documents``
    (rows of the new files) and ``library`` (their hashes by prefix), each with a folder
    per batch.  A batch that runs again replaces its folders and looks at earlier ones
    only, so retries give the same tables.
    """
    spark = files.sparkSession
    done = ingest.outcome(files, lambda keys: library_rows(spark, path, keys, batch_id))
    # What is read of it has neither bytes nor whole texts; the texts' previews stay previews.
    done = ingest.trace(done).drop("content", "text").withColumn("clean_text", text_preview(F.col("clean_text")))
    done = written_freed(done, "ingested")
    here = f"{BATCH}={batch_id}"
    shown = done.select("doc_id", "filename", "kind", "message", ingest.trace_text(F.col("trace")).alias("trace"))
    shown.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/outcomes/{here}")
    new = done.filter(F.col("kind") == "new")
    ingest.stored_rows(new).write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/documents/{here}")
    hashes = _by_prefix(new.select("file_hash", "doc_id", F.col("filename").alias("original_filename")))
    hashes.repartition(PREFIX).write.mode("overwrite").option("compression", "zstd").partitionBy(PREFIX).parquet(f"{path}/library/{here}")


def start_ingest(feed: DataFrame, path: str, checkpoint: str, library: DataFrame | None = None, **trigger) -> StreamingQuery:
    """Ingest an unbounded feed of landed files, such as ``landed.stream_landed``.

    ``library`` (file_hash, doc_id, original_filename) is what was stored before the
    stream began; it becomes batch -1, once.  The feed may carry ``text`` and the
    optional columns of ``ingest.outcome``; without ``text`` a file has none.
    """
    spark = feed.sparkSession
    stored = library if library is not None else spark.createDataFrame([], LIBRARY)
    stored = _by_prefix(stored.select("file_hash", "doc_id", "original_filename"))
    stored.repartition(PREFIX).write.mode("ignore").option("compression", "zstd").partitionBy(PREFIX).parquet(f"{path}/library/{BATCH}=-1")
    if "text" not in feed.columns:
        feed = feed.withColumn("text", F.lit(None).cast("string"))
    return (
        feed.writeStream.foreachBatch(lambda batch, batch_id: ingest_batch(batch, batch_id, path))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def outcomes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/outcomes").drop(BATCH)
