"""Hashed word and character n-gram features of many texts at once, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from ledgerleaf.llm.tools import batches

SLICE_BYTES = 2 << 20
_MULTIPLIER = 0x9E3779B1


def byte_map(letters_only: bool = False) -> np.ndarray:
    """What each byte counts as: 0 parts words.  ASCII blanks always do; with
    ``letters_only`` every other ASCII byte that is no letter does, and A-Z count as a-z."""
    table = np.arange(256, dtype=np.uint8)
    table[[32, *range(9, 14), 0]] = 0
    if letters_only:
        ascii_ = np.arange(128)
        letters = ((ascii_ | 32) >= 97) & ((ascii_ | 32) <= 122)
        table[:128] = np.where(letters, ascii_ | 32, 0)
    return table


def flattened(texts: list[bytes], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one array with a 0 around each, and where each one starts."""
    data = table[np.frombuffer(b"\0" + b"\0".join(texts) + b"\0", np.uint8)]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    return data, np.concatenate(([0], np.cumsum(lengths + 1)))


def _stirred(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return h ^ (h >> np.uint32(13))


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 32-bit hash of each word, and where it starts."""
    inside = data != 0
    edges = np.diff(inside.astype(np.int8))
    starts, ends = np.flatnonzero(edges == 1) + 1, np.flatnonzero(edges == -1) + 1
    if not len(starts):
        return np.empty(0, np.uint32), starts
    lengths = ends - starts
    place = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    powers = np.cumprod(np.full(int(lengths.max()) + 1, _MULTIPLIER, np.uint32), dtype=np.uint32)
    terms = (data[inside].astype(np.uint32) + np.uint32(1)) * powers[place]
    sums = np.add.reduceat(terms, np.cumsum(lengths) - lengths, dtype=np.uint32)
    return _stirred(sums + lengths.astype(np.uint32)), starts


def ngram_hashes(data: np.ndarray, shortest: int, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length the hashes of the n-grams of words with their edges, and where they start.

    A 0 may open or close an n-gram, as the edge of its word, but not stand inside.
    """
    wide = data.astype(np.uint32)
    inside = data != 0
    h = wide + np.uint32(1)
    clear = np.ones(len(data), bool)
    for n in range(2, longest + 1):
        m = len(data) - n + 1
        if m <= 0:
            return
        h = h[:m] * np.uint32(_MULTIPLIER) + wide[n - 1 :]
        if n > 2:
            clear = clear[:m] & inside[n - 2 : n - 2 + m]
        if n >= shortest:
            at = np.flatnonzero(clear[:m])
            yield _stirred(h[at] + np.uint32(n * 77)), at


def prefix_hashes(data: np.ndarray, starts: np.ndarray, lengths: tuple[int, ...]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length the hashes of the first bytes of the words that are longer, and where they start."""
    h = np.ones(len(starts), np.uint32)
    for n in range(1, max(lengths) + 1):
        longer = data[np.minimum(starts + n, len(data) - 1)] != 0
        h = (h * np.uint32(_MULTIPLIER) + data[starts + n - 1])[longer]
        starts = starts[longer]
        if n in lengths:
            yield _stirred(h + np.uint32(n * 131)), starts


def text_batches(stream: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch in batches(stream, SLICE_BYTES):
        yield batch, batch.column("text_utf8").to_pylist()
