"""Replay of ordered change requests against the state graph.

Each request is judged against the state its predecessors left, and a blocked
request leaves the state as it is, so a history is a sequential fold.  A
document may hold a large share of all requests, so its history is never
gathered in one place.  It is cut by sequence number into chunks of at most
``CHUNK`` requests, chunks of chunks, and so on.  On the way up every chunk is
folded to one packed mapping; on the way down each chunk learns the state it
starts in.  Every level is a grouping by (document, chunk) of narrow rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerleaf.functions import states

CHUNK = 64


def replay(
    requests: DataFrame,
    initial: DataFrame | None = None,
    doc: str = "document_id",
    seq: str = "seq",
    requested: str = "requested_state",
    chunk: int = CHUNK,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Every request with ``previous_status``, ``new_status`` and ``applied``, its
    columns named in ``keep``, and ``turn``, which orders requests that share a
    sequence number.

    The sequence number is a whole number, not negative.  Requests without one come
    first; those that share one are ordered by their kept columns, and each is
    judged.  ``initial`` has (document, workflow_status), one row per document;
    documents without a row there start as new.
    """
    carried = F.struct(F.col(seq).alias("_seq"), *keep).alias("_kept")
    nodes = requests.select(
        F.col(doc).alias("_doc"),
        _place(seq).alias("_node"),
        states.request_mapping(F.col(requested)).alias("_map"),
        carried,
    )
    span = nodes.agg(F.max("_node")).first()[0] or 0

    levels = []  # bottom-up: (document, chunk, ordered children)
    while True:
        child = [c for c in ("_node", "_kept", "_map") if c in nodes.columns]
        grouped = (
            nodes.withColumn("_chunk", F.floor(F.col("_node") / F.lit(chunk)))
            .groupBy("_doc", "_chunk")
            .agg(F.array_sort(F.collect_list(F.struct(*child))).alias("_children"))
        )
        levels.append(grouped)
        span //= chunk
        if span == 0:
            break
        nodes = grouped.select(
            "_doc", F.col("_chunk").alias("_node"), _folded(F.col("_children")).alias("_map")
        )

    if initial is None:
        entry = levels[-1].withColumn("_entry", F.lit(0).cast("long"))
    else:
        start = initial.select(
            F.col(doc).alias("_doc"),
            states.state_code(states.current_state(F.col("workflow_status"))).alias("_entry"),
        )
        entry = levels[-1].join(start, "_doc", "left").withColumn(
            "_entry", F.coalesce("_entry", F.lit(0).cast("long"))
        )

    for below in reversed(levels[:-1]):
        entered = entry.select("_doc", F.inline(_entry_states(F.col("_children"), F.col("_entry"))))
        entry = below.join(
            entered.select("_doc", F.col("_node").alias("_chunk"), F.col("_before").alias("_entry")),
            ["_doc", "_chunk"],
        )
    entered = _entry_states(F.col("_children"), F.col("_entry"), "_kept")
    judged = entry.select("_doc", F.posexplode(entered).alias("turn", "_child")).select("_doc", "turn", "_child.*")
    after = states.apply_mapping(F.col("_map"), F.col("_before"))
    return judged.select(
        F.col("_doc").alias(doc),
        F.col("_kept._seq").alias(seq),
        *(F.col(f"_kept.{name}").alias(name) for name in keep),
        states.state_name(F.col("_before")).alias("previous_status"),
        states.state_name(after).alias("new_status"),
        (after != F.col("_before")).alias("applied"),
        "turn",
    )


def _place(seq: str) -> Column:
    """Where a request stands: those without a sequence number before all others."""
    return F.coalesce(F.col(seq).cast("long") + 1, F.lit(0).cast("long"))


def _folded(children: Column) -> Column:
    return F.aggregate(
        children,
        F.lit(states.IDENTITY).cast("long"),
        lambda so_far, child: states.compose(so_far, child["_map"]),
    )


def _entry_states(children: Column, entry: Column, *more: str) -> Column:
    """ARRAY of (node, map, before, *more): each child with the state it starts in."""
    start = F.struct(
        entry.alias("state"), F.expr("CAST(array() AS ARRAY<BIGINT>)").alias("befores")
    )
    befores = F.aggregate(
        children,
        start,
        lambda acc, child: F.struct(
            states.apply_mapping(child["_map"], acc["state"]).alias("state"),
            F.array_append(acc["befores"], acc["state"]).alias("befores"),
        ),
        lambda acc: acc["befores"],
    )
    return F.zip_with(
        children,
        befores,
        lambda child, before: F.struct(
            child["_node"].alias("_node"),
            child["_map"].alias("_map"),
            before.alias("_before"),
            *(child[name].alias(name) for name in more),
        ),
    )


def final_states(
    judged: DataFrame, doc: str = "document_id", seq: str = "seq", state: str = "new_status"
) -> DataFrame:
    """Last state of every replayed document, with counts of both kinds."""
    return judged.groupBy(doc).agg(
        F.max_by(state, F.struct(F.coalesce(F.col(seq).cast("long"), F.lit(-1)), "turn")).alias("workflow_status"),
        F.count_if("applied").alias("applied"),
        F.count_if(~F.col("applied")).alias("blocked"),
    )


def mapping_per_document(requests: DataFrame, doc: str, seq: str, requested: str) -> DataFrame:
    """(document, mapping, requests): each history as one packed mapping."""
    base = requests.select(
        F.col(doc).alias("_doc"),
        _place(seq).alias("_node"),
        states.request_mapping(F.col(requested)).alias("_map"),
        F.lit(1).cast("long").alias("_n"),
    )
    span = base.agg(F.max("_node")).first()[0] or 0
    while True:
        base = (
            base.withColumn("_chunk", F.floor(F.col("_node") / F.lit(CHUNK)))
            .groupBy("_doc", "_chunk")
            .agg(
                _folded(F.array_sort(F.collect_list(F.struct("_node", "_map")))).alias("_map"),
                F.sum("_n").alias("_n"),
            )
            .select("_doc", F.col("_chunk").alias("_node"), "_map", "_n")
        )
        span //= CHUNK
        if span == 0:
            return base.select(
                F.col("_doc").alias(doc), F.col("_map").alias("mapping"), F.col("_n").alias("requests")
            )
