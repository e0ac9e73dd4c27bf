"""Alignment of two tokenizers over a corpus (operator 11).

Both tokenizers cut the same bytes.  Where tokens of both end together, the text falls
into groups; a token of one links with the tokens of the other whose bytes it shares.
How many documents hold a pair of ids linked is counted corpus-wide:

1. A first pass encodes the documents in slices, and notes the pairs of each slice.
   Pairs are dealt to shards by their first id, so a shard is bounded by the
   vocabularies, and each shard's distinct pairs, gathered over a tree, get a minimal
   perfect hash.
2. Each bucket of slices adds its counts to a dense vector indexed by the hash, and the
   vectors of a shard are summed over a tree.
3. Each slice asks the shards for its own pairs, and a second pass aligns the documents
   again and looks their links up.

So no task and no broadcast holds the pairs of the corpus.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerleaf.llm.perfect import PerfectHash
from ledgerleaf.llm.tools import doc_rows, kept_by_worker, text_bytes, text_slices
from ledgerleaf.session import written

A_FILE = public_tokenizers.path("byte_bpe_50k.json")
A_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
A_PATTERN = public_tokenizers.PATTERN
B_FILE = public_tokenizers.path("piece_bpe_32k.model")
SHARDS = 64
FAN_IN = 64
SLICE_BYTES = 4 << 20
PART_BYTES = 1 << 19

SLICES = "slice long, shard int, doc_ids binary, lengths binary, ids binary, keys binary, counts binary"
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, groups string"


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1
    bytes stand for themselves, the others for the letters from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokenizers:
    """Both tokenizers, and the bytes of each of their tokens.  The encoders of the first
    are made when a text is encoded: who looks at ids alone does not hold them."""

    def __init__(self, a_file: str, a_ranks: str | None, b_file: str):
        import sentencepiece

        self.files = a_file, a_ranks
        letters = _byte_letters()
        with open(a_file, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        known = {i: bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t, i in vocabulary.items()}
        self.a_bytes = [known.get(i, b"") for i in range(max(known) + 1)]
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        raw = [re.fullmatch(r"<0x([0-9A-F]{2})>", p) for p in pieces]
        self.b_bytes = [bytes([int(r[1], 16)]) if r else p.replace("▁", " ").encode() for r, p in zip(raw, pieces)]
        self.a_lengths, self.b_lengths = (np.fromiter(map(len, t), np.int64, len(t)) for t in (self.a_bytes, self.b_bytes))
        # What a token adds to the string of groups: its id, and what follows it.
        self.width = max(len(self.a_bytes), len(self.b_bytes))
        self.shown = [f"{i}{mark}".encode() for mark in ",|;" for i in range(self.width)]

    @cached_property
    def a_own(self):
        """The same vocabulary as ranks has the same ids, and a faster encoder."""
        import tiktoken

        if not self.files[1]:
            return None
        with open(self.files[1], "rb") as f:
            ranks = {base64.b64decode(t): int(i) for t, i in map(bytes.split, f)}
        if any(self.a_bytes[i] != t for t, i in ranks.items()):
            return None
        return tiktoken.Encoding("a", pat_str=A_PATTERN, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def a_file(self):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(self.files[0])
        tokenizer.encode_special_tokens = True
        return tokenizer

    def encoded(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both, or none where the bytes of either are not a space and the text."""
        whole, none = b" " + text, np.empty(0, np.int32)
        try:
            string = text.decode("utf-8")
        except UnicodeDecodeError:
            return none, none
        if not string:
            return none, none
        spaced = " " + string
        a = self.a_own.encode_ordinary(spaced) if self.a_own else self.a_file.encode(spaced, add_special_tokens=False).ids
        b = self.b.encode(string)
        if b"".join(map(self.a_bytes.__getitem__, a)) != whole or b"".join(map(self.b_bytes.__getitem__, b)) != whole:
            return none, none
        return np.array(a, np.int32), np.array(b, np.int32)


class Aligned:
    """The tokens of several documents, one after the other, aligned.

    ``n_a`` and ``n_b`` are the tokens of each document.  A link is a stretch of bytes
    between two neighbouring ends: it lies in one token of each, and two tokens that
    share bytes share one such stretch.
    """

    def __init__(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, a_lengths: np.ndarray, b_lengths: np.ndarray):
        self.a, self.b, self.n_a, self.n_b = a, b, n_a, n_b
        ends_a, ends_b = np.cumsum(a_lengths[a]), np.cumsum(b_lengths[b])
        total = int(ends_a[-1]) if len(ends_a) else 0
        at_a, at_b = np.zeros(total, bool), np.zeros(total, bool)
        at_a[ends_a - 1] = True
        at_b[ends_b - 1] = True
        ends = np.flatnonzero(at_a | at_b)
        self.link_a, self.link_b = (np.cumsum(at, dtype=np.int32)[ends] - at[ends] for at in (at_a, at_b))
        last = np.cumsum(n_a)
        doc_ends = np.where(last > 0, ends_a[last - 1] if total else 0, 0)
        common = np.flatnonzero(at_a & at_b)
        self.links_before = np.searchsorted(ends, doc_ends - 1, side="right")
        groups_before = np.searchsorted(common, doc_ends - 1, side="right")
        self.n_links, self.n_groups = np.diff(self.links_before, prepend=0), np.diff(groups_before, prepend=0)
        # Tokens up to the end of each group.
        self.cut_a, self.cut_b = np.searchsorted(ends_a, common + 1, side="right"), np.searchsorted(ends_b, common + 1, side="right")

    def link_keys(self, b_size: int) -> np.ndarray:
        return self.a[self.link_a].astype(np.int64) * b_size + self.b[self.link_b]

    def per_document(self, values: np.ndarray) -> np.ndarray:
        """Sums of a value of each link over the documents."""
        sums = np.concatenate(([0], np.cumsum(values)))
        return np.diff(sums[self.links_before], prepend=0)

    def group_strings(self, shown: list[bytes], width: int) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each document, empty without tokens."""
        n = len(self.a) + len(self.b)
        sizes_a, sizes_b = np.diff(self.cut_a, prepend=0), np.diff(self.cut_b, prepend=0)
        codes = np.empty(n, np.int64)
        codes[np.arange(len(self.a)) + np.repeat(self.cut_b - sizes_b, sizes_a)] = self.a
        codes[np.arange(len(self.b)) + np.repeat(self.cut_a, sizes_b)] = self.b
        codes[self.cut_a + self.cut_b - sizes_b - 1] += width
        codes[self.cut_a + self.cut_b - 1] += 2 * width
        tokens = list(map(shown.__getitem__, codes.tolist()))
        bounds = np.concatenate(([0], np.cumsum(self.n_a + self.n_b))).tolist()
        return [b"".join(tokens[i:j])[:-1] for i, j in zip(bounds[:-1], bounds[1:])]


def _in_parts(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, tokens: Tokenizers) -> Iterator[Aligned]:
    """The documents of a slice aligned in parts of about ``PART_BYTES``, so that memory
    follows the part and not the slice."""
    to_a, to_b = (np.concatenate(([0], np.cumsum(n))) for n in (n_a, n_b))
    spelt = np.concatenate(([0], np.cumsum(tokens.a_lengths[a])))
    for i, j in parts_of(np.diff(spelt[to_a]), PART_BYTES):
        yield Aligned(a[to_a[i] : to_a[j]], b[to_b[i] : to_b[j]], n_a[i:j], n_b[i:j], tokens.a_lengths, tokens.b_lengths)


def shard_of(keys: np.ndarray, b_size: int, shards: int) -> np.ndarray:
    """The shard of a pair follows from its first id, so the pairs of an id stay together."""
    first = (keys // b_size).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((first >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)


def _dealt(keys: np.ndarray, b_size: int, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of distinct keys by shard and key, and where each shard begins in it."""
    shard = shard_of(keys, b_size, shards)
    order = np.lexsort((keys, shard))
    return order, np.searchsorted(shard[order], np.arange(shards + 1))


def parts_of(sizes: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Ranges of documents of about ``most`` in all, by their sizes; a longer one is alone."""
    number = (np.cumsum(sizes) - sizes) // most
    bounds = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(sizes)]
    return [(i, j) for i, j in zip(bounds[:-1], bounds[1:]) if j > i]


def _packed(values: np.ndarray) -> bytes:
    import zstandard

    return zstandard.compress(values.tobytes(), 3)


def _unpacked(data: bytes, kind) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.decompress(data), kind)


class Alignment:
    """The corpus of ``docs`` under two tokenizers: pair counts, and links per document."""

    def __init__(self, docs: DataFrame, a_file: str = A_FILE, b_file: str = B_FILE, a_ranks: str | None = A_RANKS, shards: int = SHARDS, fan_in: int = FAN_IN, slice_bytes: int = SLICE_BYTES):
        self.files, self.shards, self.fan_in = (a_file, a_ranks, b_file), shards, fan_in
        rows = doc_rows(docs, text_bytes().alias("text_utf8"))
        self.slices = written(rows.mapInArrow(self._first_pass(slice_bytes), SLICES), "slices")
        n_slices = self.slices.filter("shard < 0").count()
        self.buckets = max(1, -(-n_slices // fan_in))
        bucket = F.pmod(F.xxhash64("slice"), F.lit(self.buckets)).alias("bucket")
        self.blocks = self.slices.filter("shard >= 0").select("slice", "shard", bucket, "keys", "counts")
        self.hashes = written(self._hashes(), "hashes")
        self.table = written(self._totals(), "counts")

    def _loaded(self) -> Callable[[], Tokenizers]:
        files = self.files
        return lambda: kept_by_worker(("alignment", *files), lambda: Tokenizers(*files))

    def _first_pass(self, slice_bytes: int):
        loaded, shards = self._loaded(), self.shards

        def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names = ["slice", "shard", "doc_ids", "lengths", "ids", "keys", "counts"]
            kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 5]
            number = TaskContext.get().partitionId() << 32
            for rows in text_slices(stream, slice_bytes):
                tokens = loaded()
                both = [tokens.encoded(t.as_py()) for c in rows.column("text_utf8").chunks for t in c]
                n_a, n_b = (np.fromiter((len(x[k]) for x in both), np.int64, len(both)) for k in (0, 1))
                a, b = (np.concatenate([x[k] for x in both]) for k in (0, 1))
                del both
                b_size = len(tokens.b_bytes)
                held = []
                for aligned in _in_parts(a, b, n_a, n_b, tokens):
                    doc = np.repeat(np.arange(len(aligned.n_a)), aligned.n_links)
                    own = np.unique(doc << 32 | aligned.link_keys(b_size)) & 0xFFFFFFFF
                    held.append(own.astype(np.uint32))
                keys, counts = np.unique(np.concatenate(held), return_counts=True)
                keys = keys.astype(np.int64)
                order, starts = _dealt(keys, b_size, shards)
                keys, counts = keys[order].astype(np.uint32), counts[order].astype(np.uint32)
                full = np.flatnonzero(np.diff(starts))
                out = [[number, -1, rows.column("doc_id").to_numpy().astype(np.int64).tobytes(), _packed(np.stack([n_a, n_b])), _packed(np.concatenate([a, b]).astype(np.uint32 if tokens.width > 1 << 16 else np.uint16)), None, None]]
                out += [[number, int(s), None, None, None, keys[starts[s] : starts[s + 1]].tobytes(), counts[starts[s] : starts[s + 1]].tobytes()] for s in full]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                number += 1

        return run

    def _tree(self, parts: DataFrame, combine: Callable[[list[bytes]], bytes], column: str) -> DataFrame:
        """(shard, column): ``combine`` over the buckets of each shard, ``fan_in`` at a time."""

        def run(key: tuple, rows: pa.Table) -> pa.Table:
            return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "bucket": pa.array([key[1].as_py()], pa.int64()), column: pa.array([combine(rows.column(column).to_pylist())], pa.binary())})

        buckets, schema = self.buckets, f"shard int, bucket long, {column} binary"
        while buckets > 1:
            buckets = -(-buckets // self.fan_in)
            parts = parts.withColumn("bucket", F.floor(F.col("bucket") / self.fan_in))
            parts = parts.groupBy("shard", "bucket").applyInArrow(run, schema)
        return parts

    def _hashes(self) -> DataFrame:
        """(shard, sizes, taken, keys): the perfect hash of the distinct pairs of each shard."""

        def union(parts: list[bytes]) -> bytes:
            return np.unique(np.concatenate([np.frombuffer(p, np.uint32) for p in parts])).tobytes()

        def distinct(key: tuple, rows: pa.Table) -> pa.Table:
            return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "bucket": pa.array([key[1].as_py()], pa.int64()), "keys": pa.array([union(rows.column("keys").to_pylist())], pa.binary())})

        def build(key: tuple, rows: pa.Table) -> pa.Table:
            made = [PerfectHash.build(np.frombuffer(k, np.uint32)).dumped() for k in rows.column("keys").to_pylist()]
            return pa.Table.from_arrays([rows.column("shard"), *(pa.array([m[i] for m in made], pa.binary()) for i in range(3))], ["shard", "sizes", "taken", "keys"])

        first = self.blocks.groupBy("shard", "bucket").applyInArrow(distinct, "shard int, bucket long, keys binary")
        # Grouped again: a step of its own in Python needs no second worker beside the tree's.
        return self._tree(first, union, "keys").select("shard", "keys").groupBy("shard").applyInArrow(build, "shard int, sizes binary, taken binary, keys binary")

    def _in_buckets(self, per_shard: DataFrame) -> DataFrame:
        return per_shard.withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(self.buckets - 1).cast("long"))))

    def _totals(self) -> DataFrame:
        """The hashes with ``counts`` in slot order, and ``best``: whether no other pair of
        the first id has a higher count."""
        b_size = self._b_size()

        def count(key: tuple, blocks: pa.Table, hashes: pa.Table) -> pa.Table:
            own = PerfectHash.loaded(*(hashes.column(c)[0].as_py() for c in ("sizes", "taken", "keys")))
            dense = np.zeros(len(own.keys), np.int64)
            for keys, counts in zip(blocks.column("keys").to_pylist(), blocks.column("counts").to_pylist()):
                dense[own.slots(np.frombuffer(keys, np.uint32))] += np.frombuffer(counts, np.uint32)
            return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "bucket": pa.array([key[1].as_py()], pa.int64()), "counts": pa.array([dense.tobytes()], pa.binary())})

        def add(parts: list[bytes]) -> bytes:
            return np.sum([np.frombuffer(p, np.int64) for p in parts], axis=0).tobytes()

        def mark(key: tuple, rows: pa.Table) -> pa.Table:
            best = []
            for keys, counts in zip(rows.column("keys").to_pylist(), rows.column("counts").to_pylist()):
                first, n = np.frombuffer(keys, np.uint32) // b_size, np.frombuffer(counts, np.int64)
                _, at = np.unique(first, return_inverse=True)
                highest = np.zeros(at.max() + 1, np.int64)
                np.maximum.at(highest, at, n)
                best.append((n == highest[at]).tobytes())
            return rows.append_column("best", pa.array(best, pa.binary()))

        # A bucket whose slices hold no pair of a shard has no block, and adds nothing.
        hashes = self._in_buckets(self.hashes).join(self.blocks.select("shard", "bucket").distinct(), ["shard", "bucket"], "left_semi")
        dense = self.blocks.groupBy("shard", "bucket").cogroup(hashes.groupBy("shard", "bucket")).applyInArrow(count, "shard int, bucket long, counts binary")
        totals = self._tree(dense, add, "counts").select("shard", "counts")
        joined = self.hashes.join(totals, "shard").select("shard", "sizes", "taken", "keys", "counts")
        return joined.groupBy("shard").applyInArrow(mark, "shard int, sizes binary, taken binary, keys binary, counts binary, best binary")

    def _b_size(self) -> int:
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=self.files[2]).get_piece_size()

    def pair_counts(self) -> DataFrame:
        """(a, b, n_docs, best): each linked pair of ids, and how many documents hold it."""
        b_size = self._b_size()

        def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in stream:
                for keys, counts, best in zip(*(batch.column(c).to_pylist() for c in ("keys", "counts", "best"))):
                    a, b = np.divmod(np.frombuffer(keys, np.uint32).astype(np.int64), b_size)
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.frombuffer(counts, np.int64)), pa.array(np.frombuffer(best, bool))], ["a", "b", "n_docs", "best"])

        return self.table.select("keys", "counts", "best").mapInArrow(run, "a long, b long, n_docs long, best boolean")

    def documents(self, with_groups: bool = True) -> DataFrame:
        """One row for each document: its tokens, groups and links, ``groups`` itself if
        asked for, how many links are the best of their first id, and the counts' sum."""
        loaded, shards = self._loaded(), self.shards

        def answer(key: tuple, blocks: pa.Table, tables: pa.Table) -> pa.Table:
            own = PerfectHash.loaded(*(tables.column(c)[0].as_py() for c in ("sizes", "taken", "keys")))
            counts, best = np.frombuffer(tables.column("counts")[0].as_py(), np.int64), np.frombuffer(tables.column("best")[0].as_py(), bool)
            slots = [own.slots(np.frombuffer(k, np.uint32)) for k in blocks.column("keys").to_pylist()]
            return pa.table({"slice": blocks.column("slice"), "shard": blocks.column("shard"), "counts": pa.array([counts[s].tobytes() for s in slots], pa.binary()), "best": pa.array([best[s].tobytes() for s in slots], pa.binary())})

        def second_pass(key: tuple, slices: pa.Table, answers: pa.Table) -> pa.Table:
            tokens = loaded()
            row = {c: slices.column(c)[0].as_py() for c in ("doc_ids", "lengths", "ids")}
            n_a, n_b = _unpacked(row["lengths"], np.int64).reshape(2, -1)
            ids = _unpacked(row["ids"], np.uint32 if tokens.width > 1 << 16 else np.uint16).astype(np.int32)
            cut = int(n_a.sum())
            b_size = len(tokens.b_bytes)
            part_keys = lambda aligned: np.unique(aligned.link_keys(b_size)).astype(np.uint32)
            keys = np.unique(np.concatenate([part_keys(p) for p in _in_parts(ids[:cut], ids[cut:], n_a, n_b, tokens)])).astype(np.int64)
            order, _ = _dealt(keys, b_size, shards)
            by_shard = np.argsort(answers.column("shard").to_numpy(), kind="stable")
            count, best = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
            for into, column, kind in ((count, "counts", np.int64), (best, "best", bool)):
                parts = answers.column(column).to_pylist()
                into[order] = np.frombuffer(b"".join(parts[i] for i in by_shard), kind)
            shas, shown, sums = [], [], []
            for aligned in _in_parts(ids[:cut], ids[cut:], n_a, n_b, tokens):
                place = np.searchsorted(keys, aligned.link_keys(b_size))
                groups = aligned.group_strings(tokens.shown, tokens.width)
                shas += [hashlib.sha256(g).hexdigest() if g else "" for g in groups]
                shown += [g.decode() for g in groups] if with_groups else [None] * len(groups)
                sums.append(np.stack([aligned.n_groups, aligned.n_links, aligned.per_document(best[place]), aligned.per_document(count[place])]))
            columns = [np.frombuffer(row["doc_ids"], np.int64), n_a, n_b, *np.concatenate(sums, axis=1)]
            return pa.Table.from_arrays([*(pa.array(c.astype(np.int64)) for c in columns), pa.array(shas, pa.string()), pa.array(shown, pa.string())], [f.split()[0] for f in RESULT.split(", ")])

        tables = self._in_buckets(self.table).join(self.blocks.select("shard", "bucket").distinct(), ["shard", "bucket"], "left_semi")
        answers = self.blocks.drop("counts").groupBy("shard", "bucket").cogroup(tables.groupBy("shard", "bucket")).applyInArrow(answer, "slice long, shard int, counts binary, best binary")
        own = self.slices.filter("shard < 0").select("slice", "doc_ids", "lengths", "ids")
        return own.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(second_pass, RESULT)


def op11_alignment(docs: DataFrame) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 per row.

    A text that is null, empty, no UTF-8, or not what its tokens spell has no tokens:
    zeros, and '' for the groups.  Repeated rows, and rows with a null doc_id (read as
    -1), are documents of their own.  Other columns are not read.  A text is one value
    of one task: about 60 bytes of memory for each of its bytes.
    """
    return Alignment(docs).documents(with_groups=False).drop("groups")
