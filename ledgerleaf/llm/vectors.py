"""Near-duplicate embeddings by cross-polytope hashing (operator 4)."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerleaf.llm.blocks import Columns, blocked_links
from ledgerleaf.llm.components import components
from ledgerleaf.session import written

COSINE = 0.93
MISS = 0.001
PROBES = 3
BUCKET = 256
SEED = 3
TRIALS = 4000
NO_ID = -1


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the length is a power of two."""
    x = x.copy()
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), axis=2).reshape(n, d)
        h *= 2
    return x / math.sqrt(d)


def axes(dims: int) -> int:
    """The next power of two, to which vectors are padded."""
    return 1 << max(1, (dims - 1).bit_length())


class CrossPolytope:
    """``tables`` x ``functions`` hashes; each rotates by three sign flips and Hadamard
    transforms and names the axis, with its sign, that a vector lies nearest to."""

    def __init__(self, dims: int, tables: int, functions: int, seed: int = SEED):
        self.size = axes(dims)
        self.tables, self.functions = tables, functions
        self.signs = np.random.default_rng(seed).choice([-1.0, 1.0], (tables, functions, 3, self.size))

    def rotated(self, x: np.ndarray, table: int, function: int) -> np.ndarray:
        wide = np.zeros((len(x), self.size))
        wide[:, : x.shape[1]] = x
        for flips in self.signs[table, function]:
            wide = hadamard(wide * flips)
        return wide

    def buckets(self, x: np.ndarray, table: int, probes: int) -> tuple[np.ndarray, np.ndarray]:
        """(own bucket, the ``probes`` next likeliest buckets) of each row of a table.

        A probe takes the second nearest axis for one function or for two; those whose
        axes lose the least length come first.
        """
        best, second, lost = [], [], []
        for f in range(self.functions):
            y = self.rotated(x, table, f)
            order = np.argpartition(-np.abs(y), 1, axis=1)[:, :2]
            size = np.take_along_axis(np.abs(y), order, axis=1)
            swap = size[:, 0] < size[:, 1]
            order[swap] = order[swap][:, ::-1]
            sign = np.take_along_axis(y, order, axis=1) < 0
            code = order * 2 + sign
            size = -np.sort(-size, axis=1)
            best.append(code[:, 0])
            second.append(code[:, 1])
            lost.append(size[:, 0] ** 2 - size[:, 1] ** 2)
        base = 2 * self.size
        own = np.zeros(len(x), np.int64)
        for code in best:
            own = own * base + code
        sets = [(f,) for f in range(self.functions)] + [(f, g) for f in range(self.functions) for g in range(f)]
        costs = np.stack([sum(lost[f] for f in s) for s in sets], axis=1)
        chosen = np.argsort(costs, axis=1, kind="stable")[:, :probes]
        place = [base ** (self.functions - 1 - f) for f in range(self.functions)]
        moves = np.stack([sum((second[f] - best[f]) * place[f] for f in s) for s in sets], axis=1)
        return own, own[:, None] + np.take_along_axis(moves, chosen, axis=1)


def tables_needed(dims: int, functions: int, probes: int, cosine: float, miss: float, seed: int = SEED) -> int:
    """How many tables leave at most ``miss`` of the pairs at the threshold without a common
    bucket, by the share of simulated pairs that one table brings together."""
    if dims < 2:
        return 1
    rng = np.random.default_rng(seed)
    a = rng.standard_normal((TRIALS, dims))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((TRIALS, dims))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = cosine * a + math.sqrt(1 - cosine**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    met = []
    for s in range(4):
        lsh = CrossPolytope(dims, 1, functions, seed + 1 + s)
        own_a, more_a = lsh.buckets(a, 0, probes)
        own_b, more_b = lsh.buckets(b, 0, probes)
        met.append((own_a == own_b) | (own_a[:, None] == more_b).any(axis=1) | (own_b[:, None] == more_a).any(axis=1))
    p = min(0.999, max(0.01, float(np.mean(met))))
    return max(1, math.ceil(math.log(miss) / math.log(1 - p)))


def unit(vector: list | None) -> np.ndarray | None:
    """The vector scaled to length 1, None if it cannot link.

    It is scaled by its greatest component first, so that no square over- or underflows;
    -0.0 becomes 0.0.
    """
    if not vector or any(v is None for v in vector):
        return None
    x = np.array(vector, np.float64)
    most = np.abs(x).max()
    if not (np.isfinite(x).all() and most > 0):
        return None
    x = x / most
    return x / np.linalg.norm(x) + 0.0


def _units(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each vector's length, its unit vector and a digest of that; nulls if it cannot link."""
    for batch in stream:
        labels = batch.column("label").to_pylist()
        units = [None if label is None else unit(v) for label, v in zip(labels, batch.column("embedding").to_pylist())]
        bodies = [None if u is None else u.tobytes() for u in units]
        keys = [None if u is None else hashlib.md5(u).digest() for u in bodies]
        dims = pa.array([None if u is None else len(u) for u in units], pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), dims, pa.array(keys, pa.binary()), pa.array(bodies, pa.binary())], ["vec_id", "label", "dims", "key", "unit"])


def _hashed(lsh: CrossPolytope, dims: int, probes: int):
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            if not batch.num_rows:
                continue
            x = np.frombuffer(b"".join(batch.column("unit").to_pylist()), np.float64).reshape(-1, dims)
            for table in range(lsh.tables):
                own, more = lsh.buckets(x, table, probes)
                for column, home in [(own, True), *((more[:, k], False) for k in range(more.shape[1]))]:
                    arrays = [batch.column("node"), batch.column("label"), batch.column("unit"), pa.array(np.full(len(x), table), pa.int32()), pa.array(column), pa.array(np.full(len(x), home))]
                    yield pa.RecordBatch.from_arrays(arrays, ["node", "label", "unit", "tab", "cell", "home"])

    return run


def _near(cosine: float, dims: int):
    def match(left: Columns, right: Columns, asked: np.ndarray) -> np.ndarray:
        a = np.frombuffer(b"".join(left["unit"]), np.float64).reshape(-1, dims)
        b = np.frombuffer(b"".join(right["unit"]), np.float64).reshape(-1, dims)
        return asked & (a @ b.T >= cosine) & (left["home"][:, None] | right["home"][None, :])

    return match


def _pairs(heads: DataFrame, dims: int, cosine: float, probes: int, miss: float, bucket: int) -> DataFrame:
    """Links (a < b) of ``node`` among the classes ``heads``, all of ``dims`` components."""
    most = heads.groupBy("label").count().agg(F.max("count")).first()[0] or 1
    functions = max(1, round(math.log(max(1, most / bucket), 2 * axes(dims))))
    lsh = CrossPolytope(dims, tables_needed(dims, functions, probes, cosine, miss), functions)
    hashed = heads.mapInArrow(_hashed(lsh, dims, probes), "node long, label string, unit binary, tab int, cell long, home boolean")
    placed = written(hashed.withColumn("bucket", F.xxhash64("label", "tab", "cell")), "buckets")
    met = placed.groupBy("bucket").agg(F.count("*").alias("n"), F.max("home").alias("lived_in")).filter("n > 1 AND lived_in")
    shared = written(placed.join(met.select("bucket"), "bucket").select("bucket", "node", "label", "unit", "home"), "shared")
    return written(blocked_links(shared, "bucket", _near(cosine, dims)), "pairs")


def near_vectors(vectors: DataFrame, cosine: float = COSINE, probes: int = PROBES, miss: float = MISS, bucket: int = BUCKET) -> DataFrame:
    """One row per vector: n_links, component_id and kept.

    Vectors are linked if their labels are equal and not null, they have the same length,
    and their cosine, in double precision, is at least ``cosine``.  Null, empty and zero
    vectors and vectors with a null or non-finite component link with nothing.
    component_id is the smallest vec_id that links reach, kept marks it.  Repeated rows
    are vectors of their own and count as links of each other; a null vec_id is read as -1.

    Vectors of a label with the same unit vector are one class with a count; only one of
    a class is hashed, and each length is searched on its own.  Each table holds a vector
    in its own bucket and, as a visitor, in the buckets it nearly fell into; two visitors
    are not compared there.  The number of hash functions grows with the logarithm of the
    vectors of a label, and the number of tables is the least whose simulated misses stay
    under ``miss``.  Buckets are compared in blocks, so a hot bucket spreads over tasks,
    and only verified pairs leave them.
    """
    rows = vectors.select(F.coalesce(F.col("vec_id").cast("long"), F.lit(NO_ID)).alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    units = written(rows.mapInArrow(_units, "vec_id long, label string, dims int, key binary, unit binary"), "units")
    usable = units.filter("key IS NOT NULL")
    classes = usable.groupBy("label", "dims", "key").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("unit").alias("unit"))
    # Vectors may share a vec_id, so a class has a number of its own, fixed by the written table.
    heads = written(classes.withColumn("node", F.monotonically_increasing_id()), "heads")
    members = usable.drop("unit").join(heads.select("label", "dims", "key", "node", "least", "copies"), ["label", "dims", "key"])

    lengths = sorted(r["dims"] for r in heads.select("dims").distinct().collect())
    found = [_pairs(heads.filter(F.col("dims") == n).select("node", "label", "unit"), n, cosine, probes, miss, bucket) for n in lengths]
    pairs = reduce(DataFrame.union, found, vectors.sparkSession.createDataFrame([], "a long, b long"))

    both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    copies = heads.select("node", "copies")
    linked = both.join(copies.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.sum("copies").alias("other_links")).withColumnRenamed("a", "node")
    groups = written(components(pairs).join(heads.select("node", "least"), "node"), "groups")
    firsts = groups.groupBy("component").agg(F.min("least").alias("first"))
    groups = groups.join(firsts, "component").select("node", "first")
    links = F.coalesce("other_links", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))
    found = members.select("vec_id", "node", "least", "copies").join(linked, "node", "left").join(groups, "node", "left")
    found = found.select("vec_id", links.cast("long").alias("n_links"), F.coalesce("first", "least").alias("component_id"))
    alone = units.filter("key IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found.union(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op4_near_vectors(vectors: DataFrame) -> DataFrame:
    return near_vectors(vectors)
