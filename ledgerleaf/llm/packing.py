"""Lexical retrieval packing into fixed windows (operator 1)."""

from __future__ import annotations

import json
import os
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerleaf.llm.scoring import split_words, spread
from ledgerleaf.llm.tools import doc_rows, kept_by_worker, text_bytes, text_slices
from ledgerleaf.session import written

WINDOW = 2048
END_ID = 1
K1, B = 1.2, 0.75
SHARD_TOKENS = 1 << 19
SHARD_ROWS = 1 << 13
SLICE_BYTES = 2 << 20
LONG_WORD = 1 << 10
# The fixed rules of the tokenizer: how it normalises a text and splits it into pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLIT = {"type": "Split", "pattern": {"Regex": PIECES}, "behavior": "Removed", "invert": True}
BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
WORD_END = "</w>"
# What a byte is part of in such words: all beyond ASCII are parts of letters.
LETTER, DIGIT, SIGN, END = range(4)
KINDS = np.array([END if x == 10 else LETTER if x >= 128 or chr(x).isalpha() else DIGIT if chr(x).isdigit() else SIGN for x in range(256)], np.uint8)
# Texts that may hold a special token, or a capital that composes with a mark in lower case alone.
NOT_BY_WORDS = r"<\||[HJTWY][^\x00-\x7F]*[\x{308}\x{30A}\x{30C}\x{331}]"
# Words on which libraries agree; the dotted capital I is two characters in lower case.
PLAIN_WORD, NOT_PLAIN = r"^[!-~\p{L}]+$", r"[\x{130}\x{10000}-\x{10FFFF}]"

ENCODED = "doc_id long, doc_tokens long, windows array<long>, tail binary, theme long"
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def merge_ranks(rules: dict) -> dict[bytes, int] | None:
    """The ids of the tokens' bytes, with LF for the end of a word; None if the ids do not
    come in the order of the merges, or the file states other rules than those above."""
    model = rules["model"]
    split = {"type": "Sequence", "pretokenizers": [SPLIT, BYTES]}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    expected = (
        rules["normalizer"] == NORMALIZER
        and rules["pre_tokenizer"] == split
        and all(t["content"].startswith("<|") for t in rules["added_tokens"])
        and model["end_of_word_suffix"] == WORD_END
        and [model["vocab"][x + y] for x, y in merges] == list(range(512, 512 + len(merges)))
    )
    if not expected:
        return None
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [x for x in range(256) if x not in set(printable)]
    byte_of = {**{chr(x): x for x in printable}, **{chr(256 + i): x for i, x in enumerate(others)}}
    ranks = {}
    for token, i in model["vocab"].items():
        if i < 512 + len(merges):
            body = bytes(byte_of[c] for c in token.removesuffix(WORD_END))
            # Words hold no LF, so only the byte itself needs an id.
            if b"\n" not in body or token == body.decode("latin-1").translate({x: 256 + k for k, x in enumerate(others)}):
                ranks[body + b"\n" if token.endswith(WORD_END) else body] = i
    return ranks


class WordEncoder:
    """Ids of whole texts as the tokenizer gives them, each different word encoded once.

    The tokenizer normalises to NFC, lower-cases, drops white space and splits the rest into
    pieces (letters, one digit, or other characters) that its model merges one by one.  None
    of this looks across an ASCII blank, so texts are parted there, and the different words
    of many texts are split into pieces and merged as one text: the ids come in the order of
    the merges, so merging by the rank of the result, the end of a word first, is the same.
    Words of other characters than letters and printable ASCII, or not normalised, and very
    long ones go to the tokenizer.  So do whole texts that may hold the string of a special
    token, and every text if the file states other rules than those above.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        ranks = merge_ranks(json.loads(self.tokenizer.to_str()))
        self.by_words = ranks is not None
        if self.by_words:
            self.merger = tiktoken.Encoding("pieces", pat_str=r"[^\n]*\n", mergeable_ranks=ranks, special_tokens={})
            self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
            for token, i in ranks.items():
                self.lengths[i] = len(token)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (UTF-8, no nulls), one after the other, and how many each has."""
        texts = texts.view(pa.string())
        try:
            texts.validate(full=True)
        except pa.ArrowInvalid:
            texts = pa.array([t.decode("utf-8", "replace") for t in texts.view(pa.binary()).to_pylist()], pa.string())
        if not self.by_words:
            return self._by_tokenizer(texts)
        return chosen_apart(texts, pc.match_substring_regex(texts, NOT_BY_WORDS), self._by_tokenizer, self._by_words)

    def _by_tokenizer(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = [np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, np.uint32) for t in texts.to_pylist()]
        return np.concatenate([np.empty(0, np.uint32), *found]), np.fromiter(map(len, found), np.int64, len(found))

    def _by_words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        n_words, flat = split_words(texts)
        words = flat.dictionary
        plain = pc.and_(pc.match_substring_regex(words, PLAIN_WORD), pc.less_equal(pc.binary_length(words), LONG_WORD))
        plain = pc.and_not(plain, pc.match_substring_regex(words, NOT_PLAIN))
        if not unicodedata.is_normalized("NFC", joined_text(words.filter(plain))):
            plain = pc.and_(plain, pa.array([unicodedata.is_normalized("NFC", w) for w in words.to_pylist()], pa.bool_()))
        ids, sizes = chosen_apart(words, pc.invert(plain), self._by_tokenizer, self._merged)
        place = flat.indices.to_numpy()
        ends = np.concatenate(([0], np.cumsum(sizes[place])))
        return ids[spread((np.cumsum(sizes) - sizes)[place], sizes[place])], np.diff(ends[np.cumsum(n_words)], prepend=0)

    def _merged(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return chosen_apart(pc.utf8_lower(words), pc.match_substring(words, "'"), self._with_contractions, self._of_runs)

    def _with_contractions(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        marked = pc.replace_substring_regex(words, f"({PIECES})", "\\1\n")
        return self._of_marked(joined_text(marked, ""), np.cumsum(pc.binary_length(marked).to_numpy(), dtype=np.int64))

    def _of_runs(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Without an apostrophe pieces are runs of letters, runs of signs, and single digits."""
        text = np.frombuffer((joined_text(words) + "\n").encode(), np.uint8)
        kind = KINDS[text]
        cut = ((kind[:-1] != kind[1:]) | (kind[:-1] == DIGIT)) & (kind[:-1] != END) & (kind[1:] != END)
        at = np.flatnonzero(cut) + 1
        ends = np.cumsum(pc.binary_length(words).to_numpy(), dtype=np.int64) + np.arange(1, len(words) + 1)
        return self._of_marked(np.insert(text, at, 10).tobytes().decode(), ends + np.searchsorted(at, ends))

    def _of_marked(self, text: str, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ids = np.array(self.merger.encode_ordinary(text), np.uint32)
        return ids, np.diff(np.searchsorted(np.cumsum(self.lengths[ids]), ends, side="right"), prepend=0)


def joined_text(values: pa.Array, between: str = "\n") -> str:
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values), between)[0].as_py()


def chosen_apart(values: pa.Array, chosen: pa.Array, one, other) -> tuple[np.ndarray, np.ndarray]:
    """What ``one`` returns for the chosen values and ``other`` for the rest, in their order."""
    at = chosen.to_numpy(zero_copy_only=False)
    if not at.any():
        return other(values)
    (a, n), (b, m) = one(values.filter(chosen)), other(values.filter(pc.invert(chosen)))
    sizes, starts = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
    sizes[at], sizes[~at] = n, m
    starts[at], starts[~at] = np.cumsum(n) - n, len(a) + np.cumsum(m) - m
    return np.concatenate([a, b])[spread(starts, sizes)], sizes


def stored_type(path: str) -> str:
    """Two bytes hold an id of a vocabulary of up to 65,536."""
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else "<u4"


def crc_of(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _encoded(path: str, stored: str, window: int, end_id: int):
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_by_worker(("words", path), lambda: WordEncoder(path))
        for batch in text_slices(stream, SLICE_BYTES):
            ids, sizes = encoder.encode(batch.column("text_utf8").combine_chunks())
            ends = np.cumsum(sizes + 1)
            ids = np.insert(ids, np.cumsum(sizes), np.uint32(end_id))
            counts = sizes + 1
            whole = counts // window
            windows = [[crc_of(ids[end - n + i * window : end - n + (i + 1) * window]) for i in range(k)] if k else [] for end, n, k in zip(ends.tolist(), counts.tolist(), whole.tolist())]
            rest = counts - whole * window
            tails = ids[spread(ends - rest, rest)]
            offsets = np.concatenate(([0], np.cumsum(rest)))
            # A theme is the least of a tail's hashed ids: texts share it as often as they share ids.
            hashed = (tails.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(16)).astype(np.int64)
            themes = np.zeros(len(rest), np.int64)
            if len(tails):
                themes[rest > 0] = np.minimum.reduceat(hashed, offsets[:-1][rest > 0])
            packed = tails.astype(stored)
            places = (offsets * packed.itemsize).astype(np.int64)
            bodies = pa.Array.from_buffers(pa.large_binary(), len(rest), [None, pa.py_buffer(places.tobytes()), pa.py_buffer(packed.tobytes())]).cast(pa.binary())
            arrays = [batch.column("doc_id").combine_chunks(), pa.array(counts, pa.int64()), pa.array(windows, pa.list_(pa.int64())), bodies, pa.array(themes, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "doc_tokens", "windows", "tail", "theme"])

    return run


def _document_counts(stored: str):
    """Of a partition: in how many tails each id occurs."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, np.int64)
        for batch in stream:
            for tail in batch.column("tail").to_pylist():
                ids = np.unique(np.frombuffer(tail, stored))
                if len(ids):
                    if ids[-1] >= len(counts):
                        counts = np.append(counts, np.zeros(int(ids[-1]) + 1 - len(counts), np.int64))
                    counts[ids] += 1
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(counts[found])], ["token", "df"])

    return run


class Index:
    """BM25 inverted index of one shard."""

    def __init__(self, terms: list[tuple[np.ndarray, np.ndarray]], lengths: np.ndarray, idf: np.ndarray, mean_length: float):
        self.terms = terms
        sizes = np.fromiter((len(t) for t, _ in terms), np.int64, len(terms))
        token = np.concatenate([t for t, _ in terms])
        tf = np.concatenate([c for _, c in terms]).astype(np.float64)
        doc = np.repeat(np.arange(len(terms)), sizes)
        scale = K1 * (1 - B + B * lengths / mean_length)
        weight = idf[token] * tf * (K1 + 1) / (tf + scale[doc])
        useful = weight > 0
        order = np.argsort(token[useful], kind="stable")
        self.doc, self.weight = doc[useful][order], weight[useful][order]
        self.ends = np.cumsum(np.bincount(token[useful], minlength=len(idf)))
        self.n = len(terms)

    def scores(self, seed: int) -> np.ndarray:
        terms = self.terms[seed][0]
        ends = self.ends[terms]
        starts = np.where(terms > 0, self.ends[terms.astype(np.int64) - 1], 0)
        lengths = ends - starts
        total = np.cumsum(lengths)
        at = np.arange(int(total[-1])) + np.repeat(starts - total + lengths, lengths)
        return np.bincount(self.doc[at], self.weight[at], minlength=self.n)


def fill_windows(tails: list[np.ndarray], idf: np.ndarray, mean_length: float, window: int = WINDOW) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences of (row, start, length) over all ids of ``tails``.

    The next unused tail is a seed.  The unused tails follow it in the order of their
    BM25 scores against it until the window is full; the last one is cut there, and its
    rest is the next seed.  A short window at the end is cut at powers of two.
    """
    left = [i for i, t in enumerate(tails) if len(t)]
    terms = [np.unique(t, return_counts=True) for t in tails]
    begun = np.zeros(len(tails), np.int64)
    lengths = np.fromiter(map(len, tails), np.int64, len(tails))
    seed = None
    while left:
        index = Index([terms[i] for i in left], lengths[left], idf, mean_length)
        row = np.array(left)
        unused = np.ones(len(row), bool)
        at = 0 if seed is None else int(np.flatnonzero(row == seed)[0])
        seed = None
        n_unused, keep_until = len(row), len(row) // 2
        # Half-used indexes are built anew, so that postings of used tails stay few.
        while n_unused > keep_until:
            room, filled, seed = window, [], None
            for k in _in_order(index, at, unused):
                r = row[k]
                take = int(min(room, lengths[r] - begun[r]))
                filled.append((int(r), int(begun[r]), take))
                begun[r] += take
                room -= take
                if begun[r] == lengths[r]:
                    unused[k] = False
                    n_unused -= 1
                else:
                    seed, at = int(r), k
                if not room:
                    break
            if room:
                yield from _powers_of_two(filled)
            else:
                yield filled
            if seed is None and n_unused:
                at = int(np.argmax(unused))
        left = row[unused].tolist()


def _in_order(index: Index, seed: int, unused: np.ndarray, first: int = 16) -> Iterator[int]:
    """The seed, then the unused tails from the best score down; the few best are sorted first."""
    yield seed
    scores = index.scores(seed)
    scores[~unused] = -1
    scores[seed] = -1
    rest = int((scores >= 0).sum())
    if rest > 2 * first:
        best = np.argpartition(-scores, first)[: first + 1]
        best = best[np.lexsort((best, -scores[best]))]
        yield from best.tolist()
        scores[best] = -1
        rest -= len(best)
    yield from np.argsort(-scores, kind="stable")[:rest].tolist()


def _powers_of_two(pieces: list[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    rest = sum(p[2] for p in pieces)
    stack = pieces[::-1]
    while rest:
        room = 1 << (rest.bit_length() - 1)
        rest -= room
        out = []
        while room:
            r, start, length = stack.pop()
            take = min(room, length)
            out.append((r, start, take))
            room -= take
            if take < length:
                stack.append((r, start + take, length - take))
        yield out


def _filled(stored: str, idf: np.ndarray, mean_length: float, window: int):
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held = [b for b in stream if b.num_rows]
        if not held:
            return
        whole = pa.Table.from_batches(held)
        ids, tokens = whole.column("doc_id").to_pylist(), whole.column("doc_tokens").to_pylist()
        tails = [np.frombuffer(t, stored) for t in whole.column("tail").to_pylist()]
        first = TaskContext.get().partitionId() << 40
        out, sequence = [], 0
        for row, crcs in enumerate(whole.column("windows").to_pylist()):
            for i, crc in enumerate(crcs):
                out.append((ids[row], i * window, window, crc, tokens[row], first + sequence, 0))
                sequence += 1
        for pieces in fill_windows(tails, idf, mean_length, window):
            offset = 0
            for row, start, length in pieces:
                crc = crc_of(tails[row][start : start + length])
                out.append((ids[row], tokens[row] - len(tails[row]) + start, length, crc, tokens[row], first + sequence, offset))
                offset += length
            sequence += 1
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names)

    return run


def pack_documents(docs: DataFrame, path: str | None = None, window: int = WINDOW, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row per piece of a document in a sequence of at most ``window`` tokens.

    A document's ids are those of its whole text (null: empty) and ``end_id``.  Full
    windows of a document are sequences of their own; its tail is a unit of the index.
    Tails are range-partitioned by a theme, the least of their hashed ids, and the doc_id,
    so that like texts meet and copies of one text spread; each range is a shard with its
    own inverted index and its own unused tails.  Document frequencies and the mean
    length are of all tails: one number for each id of the vocabulary goes to the tasks.
    No sequence needs padding: a shard's last window is cut at powers of two.  Repeated
    rows are documents of their own; a null doc_id is read as -1; other columns are not
    read.  A text is one value of one task: about 100 bytes of memory for each of its bytes.
    """
    rows = doc_rows(docs, text_bytes().alias("text_utf8"))
    path = path or tokenizer_path()
    stored = stored_type(path)
    encoded = written(rows.mapInArrow(_encoded(path, stored, window, end_id), ENCODED), "encoded")
    size = F.octet_length("tail") / np.dtype(stored).itemsize
    n_rows, n_tails, total = encoded.agg(F.count("*"), F.count(F.when(size > 0, 1)), F.coalesce(F.sum(size), F.lit(0.0))).first()
    frequency = encoded.select("tail").mapInArrow(_document_counts(stored), "token long, df long").groupBy("token").agg(F.sum("df").alias("df")).toPandas()
    df = np.zeros(int(frequency["token"].max()) + 1 if len(frequency) else 1)
    df[frequency["token"].to_numpy(np.int64)] = frequency["df"]
    # Ids of more than half of the tails tell nothing; their weight is 0.
    idf = np.maximum(0, np.log((n_tails - df + 0.5) / (df + 0.5)))
    shards = max(1, -(-int(total) // shard_tokens), -(-n_rows // SHARD_ROWS))
    dealt = encoded.repartitionByRange(shards, "theme", "doc_id").sortWithinPartitions("theme", "doc_id", "doc_tokens")
    return dealt.mapInArrow(_filled(stored, idf, total / max(1, n_tails), window), PIECE)


def op1_pack(docs: DataFrame) -> DataFrame:
    return pack_documents(docs)
