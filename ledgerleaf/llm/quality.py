"""Quality classifier on supervised subword embeddings (operator 2)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerleaf.llm.features import SLICE_BYTES, byte_map, flattened, ngram_hashes, text_batches, word_hashes
from ledgerleaf.llm.tools import batches, doc_rows, text_bytes

BUCKET_BITS = 18
DIMENSIONS = 16
SHORTEST, LONGEST = 3, 5
EPOCHS = 5
RATE = 1.0
SAMPLE_PER_CLASS = 1024
SAMPLE_BYTES = 1 << 16
SEED = 11


def held_out(doc_id) -> F.Column:
    """The fold that no model learns from: crc32 of the id's digits mod 3 is 1."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, most_bytes: int = SAMPLE_BYTES):
    """(label, text_utf8) rows to learn from, as pandas: at most ``per_class`` documents
    of each of the two labels, of at most ``most_bytes``, drawn by a hash of the id from
    the training fold.  A document with both labels counts as 0; null labels and ids
    are left out.  The drawn ids are bounded, so they are broadcast to the scan."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).filter("label IN (0, 1) AND doc_id IS NOT NULL")
    known = known.groupBy("doc_id").agg(F.min("label").alias("label")).filter(~held_out(F.col("doc_id")))
    draw = F.xxhash64(F.lit(SEED), "doc_id")
    drawn = [known.filter(F.col("label") == k).orderBy(draw, "doc_id").limit(per_class) for k in (0, 1)]
    texts = doc_rows(docs, text_bytes().alias("text_utf8")).filter(F.octet_length("text_utf8") <= most_bytes)
    found = texts.join(F.broadcast(drawn[0].union(drawn[1])), "doc_id").select("doc_id", "label", "text_utf8").toPandas()
    return found.sort_values(["doc_id", "text_utf8"], kind="stable").reset_index(drop=True)


@dataclass
class SubwordModel:
    """``vectors`` of the hashed features, and the softmax layer ``output``, ``bias``."""

    vectors: np.ndarray
    output: np.ndarray
    bias: np.ndarray

    def folded(self) -> np.ndarray:
        """Each feature's share in each class's logit: the mean of the vectors times the
        output layer is the mean of these."""
        return (self.vectors @ self.output.T).astype(np.float32)


def feature_rows(texts: list[bytes], bits: int = BUCKET_BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pieces of (feature, text): words, repeats of the word before, n-grams of words."""
    data, bounds = flattened(texts, byte_map())
    shift = np.uint32(32 - bits)
    hashes, at = word_hashes(data)
    owner = np.searchsorted(bounds, at, side="right") - 1
    yield (hashes >> shift).astype(np.int64), owner
    again = np.flatnonzero((hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])) + 1
    yield np.zeros(len(again), np.int64), owner[again]
    for grams, at in ngram_hashes(data, SHORTEST, LONGEST):
        yield (grams >> shift).astype(np.int64), np.searchsorted(bounds, at, side="right") - 1


def train(texts: list[bytes], labels: np.ndarray, classes: int = 2, bits: int = BUCKET_BITS, dims: int = DIMENSIONS, epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> SubwordModel:
    """Stochastic gradient descent on the softmax loss, one document a step, the rate
    falling to 0; every class weighs the same however many documents it has."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dims, 1 / dims, (1 << bits, dims)).astype(np.float32)
    output = np.zeros((classes, dims), np.float32)
    bias = np.zeros(classes, np.float32)
    seen = np.bincount(labels, minlength=classes)
    weight = len(labels) / np.maximum(1, seen) / max(1, (seen > 0).sum())
    rows = []
    for text in texts:
        features, counts = np.unique(np.concatenate([f for f, _ in feature_rows([text], bits)]), return_counts=True)
        rows.append((features.astype(np.int32), (counts / max(1, counts.sum())).astype(np.float32)))
    steps, step = epochs * len(rows), 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            features, share = rows[i]
            mine = vectors[features]
            mean = share @ mine
            logits = output @ mean + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[labels[i]] -= 1
            lr = rate * (1 - step / steps) * min(2.0, weight[labels[i]])
            vectors[features] = mine - (lr * share)[:, None] * (p @ output)[None, :] * len(share) ** 0.5
            output -= lr * np.outer(p, mean)
            bias -= 0.1 * lr * p
            step += 1
    return SubwordModel(vectors, output, bias)


def probabilities(texts: list[bytes], shares: np.ndarray, bias: np.ndarray, bits: int) -> np.ndarray:
    """The softmax probability of class 1 of whole texts."""
    sums, counts = np.zeros((len(texts), shares.shape[1])), np.zeros(len(texts))
    for features, owner in feature_rows(texts, bits):
        counts += np.bincount(owner, minlength=len(texts))
        for k in range(shares.shape[1]):
            sums[:, k] += np.bincount(owner, shares[features, k], minlength=len(texts))
    logits = sums / np.maximum(1, counts)[:, None] + bias
    p = np.exp(logits - logits.max(axis=1, keepdims=True))
    return p[:, 1] / p.sum(axis=1)


def _scored(shares: np.ndarray, bias: np.ndarray, bits: int):
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(stream):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(probabilities(texts, shares, bias, bits))], ["doc_id", "score"])

    return run


def score_documents(docs: DataFrame, model: SubwordModel, bits: int = BUCKET_BITS) -> DataFrame:
    """(doc_id, score) for each row: the probability of label 1 from the whole text.  A
    text without words, or null, gets the score of the bias alone."""
    rows = doc_rows(docs, text_bytes().alias("text_utf8"))
    return rows.mapInArrow(_scored(model.folded(), model.bias, bits), "doc_id long, score double")


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> SubwordModel:
    """Train on a bounded sample of the labelled documents outside the held-out fold."""
    sample = labelled_sample(docs, labels, "quality", per_class)
    return train(list(sample["text_utf8"]), sample["label"].to_numpy(np.int64))


def op2_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from a score of 0.5 on) for each row.

    Only the text makes the score.  Repeated rows are scored each; a null doc_id counts
    as -1.  Without usable labels every score is 0.5.
    """
    scored = score_documents(docs, fit(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def good_documents(docs: DataFrame, model: SubwordModel, least: float = 0.5, bits: int = BUCKET_BITS) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score ``least`` or more."""
    shares, bias = model.folded(), model.bias

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in stream:
            for batch in batches([whole], SLICE_BYTES):
                texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
                yield batch.filter(pa.array(probabilities(texts, shares, bias, bits) >= least))

    return docs.mapInArrow(run, docs.schema)
