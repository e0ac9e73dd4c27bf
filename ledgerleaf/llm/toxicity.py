"""Toxicity severity by cumulative-link ordinal regression (operator 6)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerleaf.llm.features import byte_map, flattened, prefix_hashes, text_batches, word_hashes
from ledgerleaf.llm.quality import held_out, labelled_sample
from ledgerleaf.llm.tools import doc_rows, text_bytes

SAMPLE_PER_CLASS = 2048
FEATURES = 2048
LEAST_Z = 3.0
GRADES = 3
PREFIXES = (4, 5, 6)
STEPS = 400
RATE = 0.05
PENALTY = 1e-4


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


@dataclass
class OrdinalModel:
    """Sorted feature hashes, one weight for each, and rising thresholds between the grades."""

    words: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, x: np.ndarray) -> np.ndarray:
        """P(grade > k) for each threshold k; the thresholds share the weights."""
        return _sigmoid(x[:, None] - self.thresholds[None, :])


def document_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature hash) once for each distinct feature of a text, and the words of each text.

    Features are words and the beginnings of longer words.  Words are runs of letters,
    A-Z as a-z; bytes outside ASCII count as letters.
    """
    data, bounds = flattened(texts, byte_map(letters_only=True))
    hashes, at = word_hashes(data)
    n_words = np.bincount(np.searchsorted(bounds, at, side="right") - 1, minlength=len(texts))
    pieces = [(hashes, at), *prefix_hashes(data, at, PREFIXES)]
    owner = np.concatenate([np.searchsorted(bounds, starts, side="right") - 1 for _, starts in pieces])
    pairs = np.unique((owner.astype(np.uint64) << np.uint64(32)) | np.concatenate([h for h, _ in pieces]).astype(np.uint64))
    return (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(0xFFFFFFFF)).astype(np.uint32), n_words


def select_words(owner: np.ndarray, hashes: np.ndarray, label: np.ndarray, most: int = FEATURES, least_z: float = LEAST_Z) -> tuple[np.ndarray, np.ndarray]:
    """The words whose document counts differ most between the two labels, by the z value
    of their log odds ratio, and that value."""
    vocabulary, index = np.unique(hashes, return_inverse=True)
    n1, n0 = label.sum(), (1 - label).sum()
    df1 = np.bincount(index, label[owner], minlength=len(vocabulary))
    df0 = np.bincount(index, 1 - label[owner], minlength=len(vocabulary))
    odds = np.log((df1 + 0.5) / (n1 - df1 + 0.5)) - np.log((df0 + 0.5) / (n0 - df0 + 0.5))
    spread = np.sqrt(1 / (df1 + 0.5) + 1 / (n1 - df1 + 0.5) + 1 / (df0 + 0.5) + 1 / (n0 - df0 + 0.5))
    z = odds / spread
    best = np.argsort(-np.abs(z), kind="stable")[:most]
    best = np.sort(best[np.abs(z[best]) >= least_z])
    return vocabulary[best], z[best]


def severity_grades(owner: np.ndarray, toxic_words: np.ndarray, n_words: np.ndarray, label: np.ndarray, grades: int = GRADES) -> np.ndarray:
    """Grade 0 for label 0.  Documents of label 1 get grades from 1 on, in equal parts, by
    how many distinct toxic-leaning words they hold per word."""
    density = np.bincount(owner[toxic_words], minlength=len(label)) / np.maximum(1, n_words)
    grade = np.zeros(len(label), np.int64)
    toxic = np.flatnonzero(label == 1)
    if len(toxic):
        cuts = np.quantile(density[toxic], np.arange(1, grades - 1) / (grades - 1))
        grade[toxic] = 1 + np.searchsorted(cuts, density[toxic], side="left")
    return grade


def train(texts: list[bytes], label: np.ndarray, grades: int = GRADES, steps: int = STEPS, rate: float = RATE, penalty: float = PENALTY) -> OrdinalModel:
    """Fit weights and thresholds by Adam on the ordinal log likelihood."""
    owner, hashes, n_words = document_words(texts)
    if not len(label) or label.min() == label.max():
        prior = 0.0 if not len(label) or label.max() == 0 else 1.0
        return OrdinalModel(np.empty(0, np.uint32), np.empty(0), np.where(prior, -30.0, 30.0) + np.arange(grades - 1))
    vocabulary, z = select_words(owner, hashes, label)
    at = np.searchsorted(vocabulary, hashes)
    known = (at < len(vocabulary)) & (vocabulary[np.minimum(at, len(vocabulary) - 1)] == hashes) if len(vocabulary) else np.zeros(len(hashes), bool)
    x = np.zeros((len(label), len(vocabulary)), np.float32)
    x[owner[known], at[known]] = 1
    leaning = known.copy()
    leaning[known] = z[at[known]] > 0
    grade = severity_grades(owner, leaning, n_words, label, grades)
    over = (grade[:, None] > np.arange(grades - 1)[None, :]).astype(float)
    # Parameters: weights, first threshold, log of the gaps to the next ones.
    theta = np.concatenate([np.zeros(len(vocabulary)), np.zeros(1), np.zeros(grades - 2)])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    f = len(vocabulary)
    for t in range(1, steps + 1):
        gaps = np.exp(np.clip(theta[f + 1 :], -6, 6))
        cuts = theta[f] + np.concatenate(([0.0], np.cumsum(gaps)))
        above = _sigmoid((x @ theta[:f])[:, None] - cuts[None, :])
        # d log P(grade) / d score at each threshold, P(grade) a difference of neighbours.
        full = np.concatenate([np.ones((len(x), 1)), above, np.zeros((len(x), 1))], axis=1)
        rows = np.arange(len(x))
        p = np.maximum(full[rows, grade] - full[rows, grade + 1], 1e-12)
        slope = np.concatenate([np.zeros((len(x), 1)), above * (1 - above), np.zeros((len(x), 1))], axis=1)
        up, down = slope[rows, grade] / p, slope[rows, grade + 1] / p
        by_score = -(up - down)
        by_cut = np.zeros((len(x), grades + 1))
        by_cut[rows, grade] += up
        by_cut[rows, grade + 1] -= down
        cut_gradient = by_cut[:, 1:-1].mean(axis=0)
        gradient = np.concatenate([x.T @ by_score / len(x) + penalty * theta[:f], [cut_gradient.sum()], np.cumsum(cut_gradient[::-1])[::-1][1:] * gaps])
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        theta -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    gaps = np.exp(np.clip(theta[f + 1 :], -6, 6))
    return OrdinalModel(vocabulary, theta[:f], theta[f] + np.concatenate(([0.0], np.cumsum(gaps))))


def predict(model: OrdinalModel, texts: list[bytes]) -> np.ndarray:
    """P(grade > k) of whole texts, a row each."""
    owner, hashes, _ = document_words(texts)
    x = np.zeros(len(texts))
    if len(model.words):
        at = np.minimum(np.searchsorted(model.words, hashes), len(model.words) - 1)
        known = model.words[at] == hashes
        x = np.bincount(owner[known], model.weights[at[known]], minlength=len(texts))
    return model.above(x)


def _scored(model: OrdinalModel):
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(stream):
            above = predict(model, texts)
            columns = [batch.column("doc_id"), pa.array(above[:, 0]), pa.array(above.sum(axis=1))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "severity"])

    return run


def score_documents(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """(doc_id, score, severity) for each row: P(grade > 0) and the expected grade.  A
    null or empty text has no words, so that the thresholds alone decide."""
    rows = doc_rows(docs, text_bytes().alias("text_utf8"))
    return rows.mapInArrow(_scored(model), "doc_id long, score double, severity double")


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> OrdinalModel:
    sample = labelled_sample(docs, labels, "toxic", per_class)
    return train(list(sample["text_utf8"]), sample["label"].to_numpy(np.int64))


def op6_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, severity, predicted (1 from a score of 0.5 on) for each row.

    Repeated rows are scored each; a null doc_id counts as -1.  Without labels of both
    kinds every document gets the only grade known, 0 without any.
    """
    scored = score_documents(docs, fit(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "severity", (F.col("score") >= 0.5).cast("int").alias("predicted"))
