"""Documents and audit tables: scans, schema evolution, sinks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerleaf import constants as C
from ledgerleaf.functions.fields import load_fields
from ledgerleaf.functions.upload import folder_for
from ledgerleaf.operators.audit import numbered
from ledgerleaf.schemas import AUDIT_LOG, WORKFLOW_COLUMNS
from ledgerleaf.session import written


def scan_documents(spark: SparkSession, path: str) -> DataFrame:
    return with_decoded_fields(spark.read.parquet(path))


def with_decoded_fields(documents: DataFrame) -> DataFrame:
    """Adds ``fields`` from the stored JSON; anything but an object gives {}."""
    return documents.withColumn("fields", load_fields(F.col("fields_json")))


def scan_audit(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(AUDIT_LOG).parquet(path)


def migrate(documents: DataFrame) -> DataFrame:
    """Adds the workflow columns that are absent and fills in the first state.

    Columns that exist keep their values, so running it again changes nothing.
    """
    added = {
        name: F.lit(default).cast(kind)
        for name, (kind, default) in WORKFLOW_COLUMNS.items()
        if name not in documents.columns
    }
    return documents.withColumns(added).withColumn(
        "workflow_status", F.coalesce("workflow_status", F.lit(C.NEW))
    )


def write_documents(rows: DataFrame, path: str, mode: str = "append") -> None:
    """One folder per document type: a type filter reads its folder only."""
    routed = rows.withColumn("folder", folder_for(F.col("document_type")))
    routed.write.mode(mode).partitionBy("folder").parquet(path)


def _marks(path: str) -> str:
    return f"{path.rstrip('/')}_marks"


def last_audit_id(spark: SparkSession, path: str) -> int:
    """The highest id given out for the log.  It is read from the marks that appends
    leave, a row each; a log without marks is scanned, once."""
    for where, column in ((_marks(path), "last_id"), (path, "id")):
        try:
            return spark.read.parquet(where).agg(F.max(column)).first()[0] or 0
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
    return 0


def append_audit(rows: DataFrame, path: str, stamped_at=None) -> None:
    """Append what an operator reports, with ids that go on where the log ends.

    The ids are reserved before the rows are written: an append that fails leaves a gap,
    never an id twice.  Appends to one log must follow each other, as its ids do.
    """
    spark = rows.sparkSession
    last = last_audit_id(spark, path)
    ready = written(numbered(rows, last + 1, stamped_at), "appended")
    spark.createDataFrame([(last + ready.count(),)], "last_id long").write.mode("append").parquet(_marks(path))
    ready.write.mode("append").parquet(path)


def write_report(metrics: DataFrame, matrices: DataFrame, best: str, path: str) -> None:
    """The evaluation as JSON lines: a row per model with its metrics, its confusion
    matrix (label, predicted, n) and whether it was chosen."""
    cells = matrices.groupBy("model").agg(
        F.array_sort(F.collect_list(F.struct("label", "predicted", "n"))).alias("confusion")
    )
    report = metrics.join(cells, "model", "left").withColumn("chosen", F.col("model") == best)
    report.coalesce(1).write.mode("overwrite").json(path)
