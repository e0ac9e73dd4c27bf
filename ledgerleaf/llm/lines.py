"""Line deduplication that returns keep bitmaps (operator 9)."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerleaf.llm.tools import NO_ID, batches, doc_rows, free_prefix, text_bytes
from ledgerleaf.session import written

MIN_CHARS = 10
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ROWS_PER_RANGE = 1 << 21
BATCH_BYTES = 16 << 20

LINE = "h1 long, h2 long, doc_id long, pos int, text_hash long, n_lines int"


def _keyed_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """One narrow row per line that has a key: two hashes of the key, document, position."""
    split = doc_rows(docs, "text").select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        F.split(F.coalesce("text", F.lit("")), "\n", -1).alias("lines"),
    )
    lines = split.select("doc_id", "text_hash", F.size("lines").alias("n_lines"), F.posexplode("lines").alias("pos", "line"))
    key = F.translate(F.btrim("line", F.lit(BLANKS)), UPPER, LOWER)
    return (
        lines.withColumn("key", key)
        .filter(F.length("key") >= min_chars)
        .select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(9), "key").alias("h2"), "doc_id", "pos", "text_hash", "n_lines")
    )


def _late_lines(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One sorted range: the rows of a key after its first document.

    A key that starts in this range has its first document here.  The first key may
    have started in an earlier range: all its rows are passed on with the key.  Rows
    of position -1 state the first document that the range saw of its first and last key.
    """
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("doc_id", pa.int64()), ("pos", pa.int32()), ("text_hash", pa.int64()), ("n_lines", pa.int32())])

    def claim(key, owner):
        return pa.RecordBatch.from_pylist([{"h1": int(key[0]), "h2": int(key[1]), "doc_id": int(owner), "pos": -1, "text_hash": 0, "n_lines": 0}], schema=schema)

    opening = key = owner = None
    for batch in stream:
        if not batch.num_rows:
            continue
        h1, h2, doc = (batch.column(k).to_numpy() for k in ("h1", "h2", "doc_id"))
        new = np.ones(len(h1), bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        starts = np.flatnonzero(new)
        owners = doc[starts].copy()
        if opening is None:
            opening = (h1[0], h2[0])
            yield claim(opening, doc[0])
        elif key == (h1[0], h2[0]):
            owners[0] = owner
        key, owner = (h1[-1], h2[-1]), owners[-1]
        first = (h1 == opening[0]) & (h2 == opening[1])
        out = first | (doc != owners[np.cumsum(new) - 1])
        if out.any():
            kept = batch.filter(pa.array(out))
            known = pa.array(~first[out])
            arrays = [pa.compute.if_else(known, None, kept.column(k)) for k in ("h1", "h2")]
            yield pa.RecordBatch.from_arrays(arrays + [kept.column(k) for k in schema.names[2:]], schema=schema)
    if key is not None and key != opening:
        yield claim(key, owner)


def _bitmaps(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in stream:
        keep = []
        for n, dropped in zip(batch.column("n_lines").to_pylist(), batch.column("dropped")):
            bits = np.ones(n, bool)
            bits[dropped.values.to_numpy()] = False
            keep.append(zlib.compress(np.packbits(bits, bitorder="little").tobytes()))
        arrays = [batch.column(k) for k in ("doc_id", "text_hash", "n_lines")]
        counts = pa.compute.cast(pa.compute.list_value_length(batch.column("dropped")), pa.int32())
        yield pa.RecordBatch.from_arrays([*arrays, counts, pa.array(keep, pa.binary())], ["doc_id", "text_hash", "n_lines", "n_dropped", "keep"])


def line_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, text_hash, n_lines, n_dropped, keep) for documents that lose a line.

    ``keep`` is a zlib-compressed bitmap, one bit per line, lowest bit first.  Lines
    are split at LF; a line's key is the line without ASCII blanks at its ends, A-Z in
    lower case.  A key of at least ``min_chars`` code points found in two documents
    stays in its smallest doc_id alone; shorter lines always stay.  A null text is one
    empty line, a null doc_id counts as -1, rows that share a doc_id count as one
    document (``text_hash``, ``xxhash64`` of the text, tells them apart), repeated rows
    share a bitmap.  Documents that lose nothing have no row here.

    Rows are range-partitioned by (key hash, document, position): a key that holds a
    third of all lines spreads over ranges, and each range is read as one sorted stream.
    Ranges that open inside a key learn its first document from the claims of the other
    ranges, of which there are two for each range.
    """
    spark = docs.sparkSession
    lines = written(_keyed_lines(docs, min_chars), "lines")
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-lines.count() // ROWS_PER_RANGE))
    order = ("h1", "h2", "doc_id", "pos")
    found = written(lines.repartitionByRange(ranges, *order).sortWithinPartitions(*order).mapInArrow(_late_lines, LINE), "late-lines")
    first = found.filter("pos = -1").groupBy("h1", "h2").agg(F.min("doc_id").alias("first_doc"))
    sure = found.filter("pos >= 0 AND h1 IS NULL")
    open_ = found.filter("pos >= 0 AND h1 IS NOT NULL").join(F.broadcast(first), ["h1", "h2"]).filter("doc_id > first_doc")
    late = sure.select("doc_id", "text_hash", "n_lines", "pos").union(open_.select("doc_id", "text_hash", "n_lines", "pos"))
    grouped = late.groupBy("doc_id", "text_hash", "n_lines").agg(F.collect_set("pos").alias("dropped"))
    return grouped.mapInArrow(_bitmaps, "doc_id long, text_hash long, n_lines int, n_dropped int, keep binary")


def kept_lines(bitmap: bytes | None, text: bytes) -> bytes:
    """The text without the lines whose bit is 0; no bitmap keeps all."""
    if bitmap is None:
        return text
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), bitorder="little")
    return b"\n".join(line for line, bit in zip(text.split(b"\n"), bits) if bit)


def _apply(text: str, keep: str):
    """Put the kept lines into the column ``text``, by the bitmaps in ``keep``."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in stream:
            for batch in batches([whole], BATCH_BYTES):
                at = batch.schema.get_field_index(text)
                bodies = batch.column(at).cast(pa.binary()).to_pylist()
                kept = [t if k is None else kept_lines(k, t) for k, t in zip(batch.column(keep).to_pylist(), bodies)]
                column = pa.array(kept, pa.binary()).cast(batch.schema.field(at).type)
                yield pa.RecordBatch.from_arrays([column if i == at else batch.column(i) for i in range(batch.num_columns)], schema=batch.schema)

    return run


def with_kept_text(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``doc_id, text_hash, n_lines, n_dropped, keep`` and ``text_utf8``, the kept lines, for each row."""
    text = F.coalesce("text", F.lit(""))
    n_lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    rows = doc_rows(docs, F.xxhash64("text").alias("text_hash"), text_bytes().alias("text_utf8"), n_lines.cast("long").alias("n_lines"))
    joined = rows.join(bitmaps.drop("n_lines"), ["doc_id", "text_hash"], "left").select(
        "doc_id",
        "text_hash",
        "n_lines",
        F.coalesce(F.col("n_dropped").cast("long"), F.lit(0)).alias("n_dropped"),
        "keep",
        "text_utf8",
    )
    return joined.mapInArrow(_apply("text_utf8", "keep"), joined.schema)


def deduplicated_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with the kept lines as text; n_chars, where there is one, follows it."""
    prefix = free_prefix(docs)
    id_, hash_, keep = (prefix + name for name in ("id", "hash", "keep"))
    dropped = line_bitmaps(docs).select(F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_), F.col("keep").alias(keep))
    keyed = docs.withColumn(id_, F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))).withColumn(hash_, F.xxhash64("text"))
    joined = keyed.join(dropped, [id_, hash_], "left").drop(id_, hash_)
    kept = joined.mapInArrow(_apply("text", keep), joined.schema)
    if "n_chars" in docs.columns:
        length = F.when(F.col(keep).isNull(), F.col("n_chars")).otherwise(F.length("text"))
        kept = kept.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))
    return kept.select(docs.columns)


def op9_line_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and the SHA-256 of the kept lines, per row."""
    kept = with_kept_text(docs, line_bitmaps(docs))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text_utf8", 256).alias("kept_sha256"))
