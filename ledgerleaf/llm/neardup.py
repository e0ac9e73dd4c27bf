"""Near-duplicate documents by fast similarity sketching (operator 8)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerleaf.llm.blocks import Columns, blocked_links
from ledgerleaf.llm.components import components
from ledgerleaf.llm.tools import NO_ID, batches, doc_rows, free_prefix, text_bytes, with_texts, words
from ledgerleaf.session import written

SHINGLE = 5
PERCENT = 75
COORDINATES = 128
BAND = 4
BATCH_BYTES = 8 << 20
SKETCHES_PER_BLOCK = 4096
TEXTS_PER_BLOCK = 256
# An estimate from 128 coordinates lies this far under its mean once in ten million.
MARGIN = 0.2

EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
ROW = "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>, low binary"


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser, salted."""
    x = x ^ np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """Distinct 64-bit hashes of the word shingles of a text; of the whole sequence if it is shorter."""
    tokens = words(text)
    if not tokens:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    k = min(size, len(h))
    out = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        out = out * np.uint64(0x2545F4914F6CDD1D) + h[i : len(h) - k + 1 + i]
    return np.unique(mixed(out))


def similarity_sketch(hashes: np.ndarray, owner: np.ndarray, n: int, t: int = COORDINATES) -> np.ndarray:
    """Sketches of ``n`` sets, a row each; ``owner`` names the set of each hash.

    In round r each element falls into one of the ``t`` bins by a hash of its own, from
    round t on into bin r - t, and leaves r and a hash value there; a bin keeps the
    least.  A set stops when its bins are full, so that two rounds of t fill every bin of
    every set that is not empty, and equal bins estimate the Jaccard similarity.
    """
    sketch = np.full(n * t, EMPTY, np.uint64)
    for r in range(2 * t):
        if not len(hashes):
            break
        x = mixed(hashes, r + 1)
        bins = (x >> np.uint64(32)).astype(np.int64) % t if r < t else r - t
        value = (np.uint64(r) << np.uint64(32)) | (x & np.uint64(0xFFFFFFFF))
        np.minimum.at(sketch, owner * t + bins, value)
        open_ = (sketch.reshape(n, t) == EMPTY).any(axis=1)[owner]
        hashes, owner = hashes[open_], owner[open_]
    return sketch.reshape(n, t)


def _sketched(coordinates: int, band: int, size: int):
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(stream, BATCH_BYTES):
            sets = [shingle_hashes(t, size) for t in batch.column("text_utf8").to_pylist()]
            counts = np.array([len(s) for s in sets])
            hashes = np.concatenate(sets)
            owner = np.repeat(np.arange(len(sets)), counts)
            sketch = similarity_sketch(hashes, owner, len(sets), coordinates)
            keys = np.zeros((len(sets), coordinates // band), np.uint64)
            for i in range(band):
                keys = mixed(keys + sketch[:, i::band], i)
            keys = mixed(keys ^ np.arange(keys.shape[1], dtype=np.uint64)[None, :], 99).view(np.int64)
            full = counts > 0
            starts = np.concatenate(([0], np.cumsum(counts)))[:-1]
            digest = [np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64)]
            for k in range(2):
                digest[k][full] = np.add.reduceat(mixed(hashes, 1000 + k), starts[full]) if full.any() else 0
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    *[pa.array(np.where(full, d.view(np.int64), 0), pa.int64()) for d in digest],
                    pa.array([k if f else None for k, f in zip(keys, full)], pa.list_(pa.int64())),
                    pa.array([s.tobytes() if f else None for s, f in zip(sketch.astype(np.uint8), full)], pa.binary()),
                ],
                ["doc_id", "n_shingles", "k1", "k2", "bands", "low"],
            )

    return run


def shingle_set(text: bytes, size: int) -> set:
    w = words(text)
    return set(zip(*(w[i:] for i in range(size)))) if len(w) >= size else {tuple(w)}


def alike(s: set, u: set, percent: int) -> bool:
    both = len(s & u)
    return 100 * both >= percent * (len(s) + len(u) - both)


def _confirmed(percent: int, size: int):
    """Keep the pairs whose full shingle sets meet the threshold."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in stream:
            for batch in batches([whole], BATCH_BYTES):
                texts = zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist())
                ok = [alike(shingle_set(x, size), shingle_set(y, size), percent) for x, y in texts]
                yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def confirm(pairs: DataFrame, texts: DataFrame, percent: int, size: int) -> DataFrame:
    """Pairs (a, b) whose texts meet the threshold; ``pairs`` should be written."""
    both = with_texts(pairs, texts, "b", "a")
    return written(both.mapInArrow(_confirmed(percent, size), "a long, b long").distinct(), "confirmed")


def near_duplicates(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE, coordinates: int = COORDINATES, band: int = BAND) -> DataFrame:
    """One row per row of ``docs``: n_shingles, component_id and kept.

    A document's set is its distinct ``size``-word shingles (A-Z in lower case), or its
    whole word sequence if shorter.  Documents without words, or with a null text, have
    an empty set and link with nothing.  Documents are linked from ``percent`` per cent
    of Jaccard similarity on; component_id is the smallest doc_id that links reach.
    Rows that share a doc_id are one document, whose texts link each on its own; a null
    doc_id is read as -1.

    Equal sets are one class with one sketch.  Bands of the sketches are buckets.  Each
    member is first compared with the smallest document of its buckets, which joins the
    copies of one text without pairs among them.  Only buckets that still hold more than
    one component are compared in full, in blocks, by sketch with a wide margin.  What
    this brings together forms clusters, whose documents are compared, again in blocks,
    by sketch and then on their full sets.
    """
    rows = doc_rows(docs, text_bytes().alias("text_utf8"))
    sketched = written(rows.mapInArrow(_sketched(coordinates, band, size), ROW), "sketches")
    full = sketched.filter("n_shingles > 0")
    classes = full.groupBy("k1", "k2").agg(F.min("doc_id").alias("node"))
    members = written(
        sketched.join(classes, ["k1", "k2"], "left").select("doc_id", "n_shingles", F.coalesce("node", "doc_id").alias("node"), "k1", "k2"), "classes"
    )
    first = F.col("doc_id") == F.col("node")
    heads = sketched.join(classes, ["k1", "k2"]).filter(first).dropDuplicates(["k1", "k2"])
    heads = written(heads.select("node", F.col("n_shingles").alias("n"), "bands", "low"), "heads")

    bands = heads.select("node", "n", F.explode("bands").alias("bucket"))
    least = bands.groupBy("bucket").agg(F.min(F.struct("node", "n")).alias("least"), F.count("*").alias("in_bucket"))
    buckets = written(bands.join(least.filter("in_bucket > 1"), "bucket").select("bucket", "node", "n", "least"), "buckets")
    similar = F.least("n", "least.n") * 100 >= F.greatest("n", "least.n") * percent
    stars = buckets.filter(similar & (F.col("node") != F.col("least.node")))
    stars = written(stars.select(F.col("least.node").alias("a"), F.col("node").alias("b")).distinct(), "stars")
    found = confirm(stars, rows, percent, size)

    reps = members.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("z")).filter("a <> z")
    same_id = members.join(reps, "doc_id").select("a", F.col("node").alias("b"))
    links = written(found.select("a", "b").union(same_id), "links")
    groups = written(components(links), "groups")

    placed = buckets.join(groups, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("component"))
    mixed_ = placed.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi").select("bucket")
    apart = written(placed.join(mixed_, "bucket").join(heads.select("node", "n", "low"), "node"), "apart")
    near = written(blocked_links(apart, "bucket", _likely(percent, coordinates), SKETCHES_PER_BLOCK, every_pair=False), "near")
    if not near.isEmpty():
        clusters = components(near).withColumnRenamed("component", "cluster")
        facts = apart.select("node", "component", "n", "low").dropDuplicates(["node"]).join(clusters, "node")
        texts = rows.hint("merge").select(F.col("doc_id").alias("node"), "text_utf8")
        facts = written(facts.join(texts, "node"), "cluster-texts")
        more = blocked_links(facts, "cluster", _linked(percent, size, coordinates), TEXTS_PER_BLOCK, every_pair=False)
        links = written(links.union(more), "links")
        groups = written(components(links), "groups")

    component = F.coalesce("component", "node")
    return members.join(groups, "node", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"), (F.col("doc_id") == component).alias("kept")
    )


def _likely(percent: int, coordinates: int):
    """Pairs of different components whose sizes and sketches allow the threshold."""

    def match(left: Columns, right: Columns, asked: np.ndarray) -> np.ndarray:
        # Row by row: of the matrices only the asked one is ever whole.
        n, m = left["n"], right["n"]
        a = np.frombuffer(b"".join(left["low"]), np.uint8).reshape(-1, coordinates)
        b = np.frombuffer(b"".join(right["low"]), np.uint8).reshape(-1, coordinates)
        least = (percent / 100 - MARGIN) * coordinates
        for i in range(len(asked)):
            row = asked[i] & (np.minimum(n[i], m) * 100 >= np.maximum(n[i], m) * percent)
            at = np.flatnonzero(row & (right["component"] != left["component"][i]))
            asked[i] = False
            if len(at):
                asked[i, at] = np.count_nonzero(b[at] == a[i], axis=1) >= least
        return asked

    return match


def distinct_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, one for each doc_id."""
    prefix = free_prefix(docs)
    id_, rows, turn = (prefix + name for name in ("id", "rows", "turn"))
    kept = near_duplicates(docs).filter("kept").groupBy(F.col("doc_id").alias(id_)).agg(F.count("*").alias(rows))
    found = docs.withColumn(id_, F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))).join(kept, id_)
    once = found.filter(F.col(rows) == 1).select(docs.columns)
    order = Window.partitionBy(id_).orderBy(F.xxhash64(*docs.columns))
    again = found.filter(F.col(rows) > 1).withColumn(turn, F.row_number().over(order)).filter(F.col(turn) == 1)
    return once.union(again.select(docs.columns))


def _linked(percent: int, size: int, coordinates: int):
    """Of the likely pairs those that meet the threshold on their full sets."""
    likely = _likely(percent, coordinates)

    def match(left: Columns, right: Columns, asked: np.ndarray) -> np.ndarray:
        ok = likely(left, right, asked)
        sets: list[dict[int, set]] = [{}, {}]

        def of(side: int, columns: Columns, k: int) -> set:
            if k not in sets[side]:
                sets[side][k] = shingle_set(columns["text_utf8"][k], size)
            return sets[side][k]

        for i, j in zip(*np.nonzero(ok)):
            ok[i, j] = alike(of(0, left, i), of(1, right, j), percent)
        return ok

    return match


def op8_near_duplicates(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs)
