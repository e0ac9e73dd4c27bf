"""Workflow states over a live stream of change requests.

A micro-batch is folded to one packed mapping per document (see
``functions/states.py``), by the same skew-safe levels as the batch replay, and
written to the folder of its batch id.  The current state of a document is the
composition of its mappings in batch order: one small row per document and
batch, instead of one Python call per request.  ``compact`` folds old batches
into one.  Within a batch requests are ordered by sequence number, between
batches by arrival.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerleaf.functions import states
from ledgerleaf.operators import audit
from ledgerleaf.operators.replay import mapping_per_document
from ledgerleaf.operators.workflow import change_status
from ledgerleaf.session import written

# A snapshot of all states is written before every such batch; a batch reads the last
# snapshot and the states that fewer batches than that left since.
SNAPSHOT_EVERY = 32
STATES = "doc_id LONG, workflow_status STRING"
MARKS = "next_id LONG"
SCHEMA = "document_id LONG, mapping LONG, requests LONG, batch_id LONG"


def store_mappings(batch: DataFrame, batch_id: int, path: str) -> None:
    mappings = mapping_per_document(batch, "document_id", "seq", "requested_state")
    mappings.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def start_workflow(feed: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Start the stream.  ``feed`` needs document_id, seq and requested_state."""
    return (
        feed.writeStream.foreachBatch(
            lambda batch, batch_id: store_mappings(batch, batch_id, path)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def current_states(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame:
    """(document_id, workflow_status, requests) after all stored batches.

    A document has at most one row per batch; ``compact`` keeps that number
    small.
    """
    folded = _folded(spark, path, upto)
    start = F.lit(0).cast("long")
    return folded.select(
        "document_id",
        states.state_name(states.apply_mapping(F.col("mapping"), start)).alias("workflow_status"),
        "requests",
    )


def _folded(spark: SparkSession, path: str, upto: int | None) -> DataFrame:
    rows = spark.read.schema(SCHEMA).parquet(path)
    if upto is not None:
        rows = rows.filter(F.col("batch_id") <= upto)
    identity = F.lit(states.IDENTITY).cast("long")
    ordered = F.array_sort(F.collect_list(F.struct("batch_id", "mapping")))
    return rows.groupBy("document_id").agg(
        F.aggregate(ordered, identity, lambda m, r: states.compose(m, r["mapping"])).alias("mapping"),
        F.sum("requests").alias("requests"),
    )


def compact(spark: SparkSession, path: str, target: str, upto: int) -> None:
    """Write the batches up to ``upto`` as one, and the later ones unchanged,
    to a new folder.  The stream is stopped meanwhile and continues there."""
    _folded(spark, path, upto).write.mode("overwrite").parquet(f"{target}/batch_id={upto}")
    later = spark.read.schema(SCHEMA).parquet(path).filter(F.col("batch_id") > upto)
    later.write.mode("append").partitionBy("batch_id").parquet(target)


def _states_before(spark: SparkSession, path: str, batch_id: int, base: int) -> DataFrame:
    """(doc_id, workflow_status) of every document when ``batch_id`` begins."""
    snapshot = spark.read.schema(STATES).parquet(f"{path}/snapshots/at={base}").withColumn("batch_id", F.lit(-1).cast("long"))
    changed = spark.read.schema(f"{STATES}, batch_id LONG").parquet(f"{path}/states")
    changed = changed.filter((F.col("batch_id") >= base) & (F.col("batch_id") < batch_id))
    last = F.max_by("workflow_status", "batch_id").alias("workflow_status")
    return snapshot.unionByName(changed).groupBy("doc_id").agg(last)


def apply_batch(requests: DataFrame, batch_id: int, path: str) -> None:
    """Judge one micro-batch of requests (document_id, seq, new_state, action, reason).

    Below ``path``, each with a folder per batch: ``states`` of the changed documents,
    ``audit`` rows with ids that go on where the batch before ended, ``refused``
    requests, and ``marks`` with the next free id.  A batch that runs again reads
    earlier folders only and replaces its own, so its ids are the same.
    """
    spark = requests.sparkSession
    base = batch_id - batch_id % SNAPSHOT_EVERY
    if base == batch_id and batch_id:
        _states_before(spark, path, base, base - SNAPSHOT_EVERY).write.mode("overwrite").parquet(f"{path}/snapshots/at={base}")
    requests = written(requests, "requests")
    known = _states_before(spark, path, batch_id, base)
    asked = known.join(requests.select(F.col("document_id").alias("doc_id")).distinct(), "doc_id", "left_semi")
    change = change_status(asked, requests)
    here = f"batch_id={batch_id}"
    marks = spark.read.schema(f"{MARKS}, batch_id LONG").parquet(f"{path}/marks")
    first = marks.filter(F.col("batch_id") == batch_id - 1).first()["next_id"]
    rows = written(audit.numbered(change.audit, first), "numbered")
    rows.write.mode("overwrite").parquet(f"{path}/audit/{here}")
    change.refused.write.mode("overwrite").parquet(f"{path}/refused/{here}")
    change.documents.select("doc_id", "workflow_status").write.mode("overwrite").parquet(f"{path}/states/{here}")
    spark.createDataFrame([(first + rows.count(),)], MARKS).write.mode("overwrite").parquet(f"{path}/marks/{here}")


def start_review(feed: DataFrame, documents: DataFrame, path: str, checkpoint: str, first_id: int = 1, **trigger) -> StreamingQuery:
    """Apply an unbounded feed of requests to ``documents`` (doc_id, workflow_status), as
    they stood when the stream began; ``first_id`` is the first id of its audit rows."""
    spark = feed.sparkSession
    documents.select("doc_id", "workflow_status").write.mode("ignore").parquet(f"{path}/snapshots/at=0")
    spark.createDataFrame([], STATES).write.mode("ignore").parquet(f"{path}/states/batch_id=-1")
    spark.createDataFrame([(first_id,)], MARKS).write.mode("ignore").parquet(f"{path}/marks/batch_id=-1")
    return (
        feed.writeStream.foreachBatch(lambda batch, batch_id: apply_batch(batch, batch_id, path))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def reviewed(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """The ``audit`` rows or the ``refused`` requests of all batches."""
    return spark.read.parquet(f"{path}/{kind}").drop("batch_id")


def reviewed_states(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, workflow_status) of every document after all batches."""
    last = spark.read.schema(f"{MARKS}, batch_id LONG").parquet(f"{path}/marks").agg(F.max("batch_id")).first()[0]
    return _states_before(spark, path, last + 1, max(0, last - last % SNAPSHOT_EVERY))
