"""Comparison of the members of a bucket in blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 2048

Columns = dict[str, np.ndarray]


def groups(stream: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[Columns]:
    """The runs of equal ``keys`` in a sorted stream, as arrays; a run may span batches."""
    held: list[pa.RecordBatch] = []

    def columns(parts: list[pa.RecordBatch]) -> Columns:
        table = pa.Table.from_batches(parts)
        kinds = {f.name: pa.types.is_binary(f.type) for f in table.schema}
        return {c: np.array(table.column(c).to_pylist(), object) if kinds[c] else table.column(c).to_numpy() for c in table.column_names}

    for batch in stream:
        if not batch.num_rows:
            continue
        own = [batch.column(k).to_numpy() for k in keys]
        new = np.zeros(batch.num_rows, bool)
        for column in own:
            new[1:] |= column[1:] != column[:-1]
        new[0] = bool(held) and any(held[-1].column(k)[-1].as_py() != c[0] for k, c in zip(keys, own))
        starts = np.flatnonzero(new)
        at = 0
        if len(starts):
            closed = [*held, batch.slice(0, starts[0])] if starts[0] else held
            if closed:
                yield columns(closed)
            at, held = int(starts[-1]), []
            if len(starts) > 1:
                whole = columns([batch.slice(int(starts[0]), int(starts[-1] - starts[0]))])
                cuts = starts - starts[0]
                for a, b in zip(cuts[:-1], cuts[1:]):
                    yield {c: v[a:b] for c, v in whole.items()}
        held.append(batch.slice(at))
    if held:
        yield columns(held)


def spanning(found: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what the matrix ``found`` connects, one for each node at most."""
    rows, columns = found.any(axis=1), found.any(axis=0)
    part, of_a, of_b = found[rows][:, columns], a[rows].copy(), b[columns].copy()
    turned = np.ascontiguousarray(part.T)
    while part.size:
        x = np.array([min(own, of_b[line].min()) for own, line in zip(of_a, part)])
        y = np.array([min(own, x[line].min()) for own, line in zip(of_b, turned)])
        if (x == of_a).all() and (y == of_b).all():
            break
        of_a, of_b = x, y
    nodes, roots = np.concatenate([a[rows], b[columns]]), np.concatenate([of_a, of_b])
    kept = nodes != roots
    return roots[kept], nodes[kept]


def blocked_links(
    members: DataFrame, bucket: str, match: Callable[[Columns, Columns, np.ndarray], np.ndarray], block: int = BLOCK, every_pair: bool = True
) -> DataFrame:
    """Distinct links (a < b) of ``node`` that ``match`` accepts inside a bucket.

    ``match(left, right, asked)`` returns which pairs of the boolean matrix ``asked`` link.  The members of a bucket are dealt
    over blocks by a hash, and each pair of blocks is a group of its own: a bucket of m
    members becomes about (m / block)^2 / 2 groups, which spread over tasks.  Accepted
    pairs leave a task, or, without ``every_pair``, only as many links as connect them.
    ``members`` is read twice, so it should be written.
    """
    counts = members.groupBy(bucket).agg(F.ceil(F.count("*") / block).cast("int").alias("_blocks"))
    dealt = members.join(counts, bucket).withColumn("_block", F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int"))
    spread = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).drop("_blocks")
    spread = spread.withColumn("_i", F.least("_block", "_other")).withColumn("_j", F.greatest("_block", "_other")).drop("_other")
    keys = [bucket, "_i", "_j"]

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts, seconds, held = [], [], 0
        for group in groups(stream, keys):
            i, j = group["_i"][0], group["_j"][0]
            left, right = ({c: v[group["_block"] == k] for c, v in group.items()} for k in (i, j))
            a, b = left["node"], right["node"]
            if not len(a) or not len(b):
                continue
            asked = (a[:, None] < b[None, :]) if i == j else (a[:, None] != b[None, :])
            found = match(left, right, asked)
            if every_pair:
                x, y = np.nonzero(found)
                first, second = np.minimum(a[x], b[y]), np.maximum(a[x], b[y])
            else:
                first, second = spanning(found, a, b)
            firsts.append(first)
            seconds.append(second)
            held += len(first)
            if held > 1 << 18:
                yield links(firsts, seconds)
                firsts, seconds, held = [], [], 0
        if firsts:
            yield links(firsts, seconds)

    def links(firsts, seconds):
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(firsts)), pa.array(np.concatenate(seconds))], ["a", "b"])

    return spread.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long").distinct()
