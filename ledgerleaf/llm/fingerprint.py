"""Lempel-Ziv phrase fingerprints (operator 10)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerleaf.llm.tools import batches, doc_rows
from ledgerleaf.session import written

COORDINATES = 64
SLICE_BYTES = 8 << 20
SEED = 5
ROWS_PER_RANGE = 1 << 15
_P = 0x9E3779B97F4A7C15
_P_INVERSE = pow(_P, -1, 1 << 64)

RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
PARTIAL = RESULT + ", part int, kind int, body string"
DONE, OPEN, HEAD = 0, 1, 2


class PhraseParser:
    """LZ78 over the characters of a text: each new phrase is a known one and a character."""

    def __init__(self, coordinates: int = COORDINATES, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.factors = rng.integers(0, 1 << 63, coordinates, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.powers = self.inverses = np.ones(1, np.uint64)

    @staticmethod
    def parse(text: str, known: set[str], open_: str) -> tuple[list[int], str]:
        """Go on with a parse: the lengths of the phrases added to ``known``, and what
        follows the last of them.  ``open_`` is what followed the phrase before."""
        lengths = []
        add, note = known.add, lengths.append
        phrase = open_
        for c in text:
            phrase += c
            if phrase not in known:
                add(phrase)
                note(len(phrase))
                phrase = ""
        return lengths, phrase

    def minima(self, text: str, lengths: list[int]) -> np.ndarray:
        """Per coordinate the least hash of the phrases, which stand side by side in ``text``."""
        if not lengths:
            return np.full(len(self.factors), 0xFFFFFFFFFFFFFFFF, np.uint64)
        n = len(text)
        if len(self.powers) <= n:
            self.powers, self.inverses = (np.cumprod(np.array([1] + 2 * n * [f], np.uint64), dtype=np.uint64) for f in (_P, _P_INVERSE))
        codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(codes * self.powers[:n], out=sums[1:])
        ends = np.cumsum(lengths)
        starts = ends - lengths
        h = (sums[ends] - sums[starts]) * self.inverses[starts]
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        least = np.full(len(self.factors), 0xFFFFFFFFFFFFFFFF, np.uint64)
        for at in range(0, len(h), 1 << 14):
            least = np.minimum(least, (h[at : at + (1 << 14), None] * self.factors).min(axis=0))
        return least

    def signature(self, text: str) -> np.ndarray:
        return self.minima(text, self.parse(text, set(), "")[0])

    def with_edit(self, text: str, following: str) -> tuple[np.ndarray, np.ndarray, str]:
        """Signatures of the text and of its edited text, and the edited text.

        Both share their first two thirds, which are parsed once.
        """
        k = len(text) // 3
        stem, edited = text[: len(text) - k], text[: len(text) - k] + following[:k]
        known: set[str] = set()
        lengths, open_ = self.parse(stem, known, "")
        shared = self.minima(stem, lengths)
        done = sum(lengths)
        out = []
        for whole, own in ((text, set(known)), (edited, known)):
            more, _ = self.parse(whole[len(stem) :], own, open_)
            out.append(np.minimum(shared, self.minima(whole[done:], more)))
        return out[0], out[1], edited


def as_string(minima: np.ndarray) -> str:
    """Sixteen bits of each minimum, in hex."""
    stirred = (minima ^ (minima >> np.uint64(32))) * np.uint64(_P)
    return (stirred >> np.uint64(48)).astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of equal minima, which estimates the Jaccard similarity of the phrase sets."""
    return float((a == b).mean())


def _row(parser: PhraseParser, doc_id: int, text: str, following: str) -> list:
    """The document's row, its own minima last, without its likeness to the next document."""
    own, other, edited = parser.with_edit(text, following)
    sha = hashlib.sha256(edited.encode("utf-8")).hexdigest()
    return [doc_id, len(text), sha, as_string(own), as_string(other), likeness(own, other), own]


def _streamed(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range in falling doc_id: every document meets the next one, but for the last."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    parser = PhraseParser()
    names = [f.split()[0] for f in PARTIAL.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int32(), pa.int32(), pa.string()]

    def table(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    # A document's minima come with its own row, one document after it met the next one.
    waiting = edited = None
    for batch in batches(stream, SLICE_BYTES):
        out = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("body").to_pylist()):
            if waiting is None:
                out.append((doc_id, None, None, None, None, None, None, part, HEAD, text))
            else:
                row = _row(parser, *waiting, text)
                if edited is not None:
                    out.append((*edited[:-1], likeness(edited[-1], row[-1]), part, DONE, None))
                edited = row
            waiting = (doc_id, text)
        if out:
            yield table(out)
    if waiting is not None:
        out = [(waiting[0], None, None, None, None, None, None, part, OPEN, waiting[1])]
        if edited is not None:
            out.append((*edited[:-1], likeness(edited[-1], parser.signature(waiting[1])), part, DONE, None))
        yield table(out)


def _resolved(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parser = PhraseParser()
    names = [f.split()[0] for f in RESULT.split(", ")]
    for whole in stream:
        for batch in batches([whole], SLICE_BYTES):
            triples = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "body", "following")))
            rows = [_row(parser, i, t, f) for i, t, f in triples]
            rows = [(*r[:-1], likeness(r[-1], parser.signature(f))) for r, f in zip(rows, batch.column("following").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names)


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: fingerprints of its text and of its edited text, and how like
    they are to each other and to the next document's.

    A fingerprint holds, for each of 64 hash functions, 16 bits of the least hash of the
    text's LZ78 phrases.  The next document is the one of the next smaller doc_id; the
    first follows the last.  A null text is empty; texts without phrases are alike.
    Repeated ids follow each other in the order of their texts' hashes; a null doc_id is
    read as -1.

    Texts move once, to ranges of falling doc_id that are read as streams.  The last
    document of a range and the first of each range, two for each range, then meet in a
    small join.
    """
    spark = docs.sparkSession
    body = F.coalesce("text", F.lit(""))
    rows = doc_rows(docs, body.alias("body"), F.xxhash64("text").alias("text_hash"))
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // ROWS_PER_RANGE))
    order = (F.desc("doc_id"), F.asc("text_hash"))
    found = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order).select("doc_id", "body").mapInArrow(_streamed, PARTIAL)
    found = written(found, "fingerprints")
    names = [f.split()[0] for f in RESULT.split(", ")]
    heads = found.filter(F.col("kind") == HEAD).select("part", F.col("body").alias("following"))
    parts = heads.select("part").withColumn("turn", F.row_number().over(Window.orderBy("part")) - 1)
    following = parts.select(F.col("part").alias("of"), ((F.col("turn") + 1) % F.lit(max(1, heads.count()))).alias("turn"))
    after = following.join(parts, "turn").join(heads, "part").select("of", "following")
    last = found.filter(F.col("kind") == OPEN).select("doc_id", "body", F.col("part").alias("of")).join(after, "of")
    ends = last.select("doc_id", "body", "following").mapInArrow(_resolved, RESULT)
    return found.filter(F.col("kind") == DONE).select(*names).union(ends)


def op10_fingerprints(docs: DataFrame) -> DataFrame:
    return fingerprints(docs)
