"""Byte-balanced shards by Karmarkar-Karp differencing (operator 5)."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerleaf.llm.tools import doc_rows, hash_bucket, running
from ledgerleaf.session import written

SHARDS = 24
ROW_BYTES = 8
GROUPS_PER_PART = 1 << 17
MOST_PARTS = 1 << 12


def differencing(sizes: np.ndarray, shards: int) -> np.ndarray:
    """Combine partial partitions until one is left; return the bins of each item.

    ``sizes`` has a row per partial partition and a column per bin.  The two partitions
    of largest spread are combined again and again, the fullest bin of one with the
    emptiest of the other.  Row ``i`` of the result says which final bin each bin of
    partition ``i`` became.  A combination only records which bins met, so the bins of
    all items are read off once at the end, from the last combination to the first.
    """
    n = len(sizes)
    sums, order = {}, {}
    heap = []
    for i in range(n):
        order[i] = np.argsort(-sizes[i], kind="stable")
        sums[i] = sizes[i][order[i]]
        heap.append((-(int(sums[i][0]) - int(sums[i][-1])), i))
    heapq.heapify(heap)
    met = []
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        total = sums.pop(a) + sums.pop(b)[::-1]
        to = np.argsort(-total, kind="stable")
        new = n + len(met)
        met.append((a, b, to))
        sums[new] = total[to]
        heapq.heappush(heap, (-(int(sums[new][0]) - int(sums[new][-1])), new))
    out = np.zeros((n, shards), np.int64)
    place = {heap[0][1]: np.arange(shards)} if heap else {}
    for step in range(len(met) - 1, -1, -1):
        a, b, to = met[step]
        final = np.empty(shards, np.int64)
        final[to] = place.pop(n + step)
        place[a], place[b] = final, final[::-1]
    for i in range(n):
        out[i, order[i]] = place[i]
    return out


def _local(shards: int):
    """Differencing inside one part: a bin for each group, then the part's bin sizes."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["bytes", "group_key"], ascending=[False, True], kind="stable")
        sizes = np.zeros((len(frame), shards), np.int64)
        sizes[:, 0] = frame["bytes"].to_numpy()
        return frame.assign(bin=differencing(sizes, shards)[:, 0].astype("int32"))[["part", "group_key", "bytes", "bin"]]

    return run


def _across(shards: int):
    """Differencing of whole parts: which shard each bin of each part becomes."""

    def run(stream: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bins = pd.concat(list(stream))
        if bins.empty:
            return
        parts = np.sort(bins["part"].unique())
        sizes = np.zeros((len(parts), shards), np.int64)
        sizes[np.searchsorted(parts, bins["part"]), bins["bin"]] = bins["bytes"]
        to = differencing(sizes, shards)
        yield pd.DataFrame({"part": np.repeat(parts, shards), "bin": np.tile(np.arange(shards), len(parts)), "shard": to.ravel()})

    return run


def balanced_groups(groups: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(group_key, shard) for ``groups(group_key binary, bytes long)``.

    Groups are dealt over parts of about ``GROUPS_PER_PART``; each part is one partial
    partition, made by differencing in its own task.  The parts, at most ``MOST_PARTS``
    rows of ``shards`` numbers, are then combined in the same way in one task.  Groups
    stay whole, so a group above the mean of a shard sets the largest shard.
    """
    groups = written(groups, "groups")
    parts = min(MOST_PARTS, -(-groups.count() // GROUPS_PER_PART))
    dealt = groups.withColumn("part", F.pmod(F.xxhash64("group_key"), F.lit(max(1, parts))).cast("int"))
    binned = written(dealt.groupBy("part").applyInPandas(_local(shards), "part int, group_key binary, bytes long, bin int"), "bins")
    sums = binned.groupBy("part", "bin").agg(F.sum("bytes").alias("bytes"))
    top = sums.coalesce(1).mapInPandas(_across(shards), "part int, bin int, shard int")
    return binned.join(F.broadcast(top), ["part", "bin"]).select("group_key", "shard")


def op5_shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per document: size, checksum, shard and slot; equal texts share a shard.

    Law ``bytes``: shard sizes are near equal.  Size is the text's UTF-8 bytes plus 8;
    a null text has none and groups with other nulls, an empty text with empty texts.
    Slots count from 0 in each shard without a gap.  Repeated rows are documents of
    their own; they share a shard, and their slots follow in no stated order.
    """
    content = doc_rows(docs, "text").select(
        "doc_id",
        F.when(F.col("text").isNull(), F.unhex(F.lit("00"))).otherwise(F.unhex(F.sha2("text", 256))).alias("group_key"),
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    rows = written(content, "sizes")
    placed = balanced_groups(rows.groupBy("group_key").agg(F.sum("size").alias("bytes")), shards)
    rows = written(rows.join(placed, "group_key").select("doc_id", "size", "text_crc32", "shard", F.lit(1).alias("one")), "placed")
    slots = running(rows, "shard", ["doc_id", "text_crc32", "size"], "one", "slot", hash_bucket(rows.count(), "doc_id"))
    return slots.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
