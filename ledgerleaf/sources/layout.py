"""Task layout of scans that feed per-row text work."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """A scan over enough tasks to keep every core busy.

    For plans without a shuffle only: counting the splits of others runs them.

    A large table comes as many splits and is returned as it is, without a
    shuffle.  A scan with fewer splits than the cluster has cores (a few small
    files, or files of one row group) is dealt out before the text work, which
    costs far more per row than moving it.
    """
    if df.isStreaming:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(2 * cores) if df.rdd.getNumPartitions() < cores else df
