"""Scoring of documents by language models of the corpus (operator 12).

The base is a model of single words with counts of the whole training part.  The model
itself is causal self-attention on subword ids (``attention.py``).  It starts from counts
of neighbouring ids over all training documents; its weights learn from all of their
windows: each round teaches its own share of them, learners of about equal size take a
pass each over their windows, and the weights are averaged over a tree after each round.
"""

from __future__ import annotations

import base64
import math
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerleaf.llm import attention
from ledgerleaf.llm.tools import doc_rows, kept_by_worker, text_bytes, text_slices, tree_sum
from ledgerleaf.session import written

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
SLICE_BYTES = 8 << 20
ONE_WINDOW_OF = 1
WINDOWS_PER_LEARNER = 8192
ROUNDS = 3
RATE = 0.01

WORDS_PER_SHARD = 1 << 20

SLICES = "slice long, doc_ids binary, held binary, n_words binary, n_train long, n_distinct long, places binary, words binary, word_ids binary, id_counts binary"


# White space beyond ASCII, in UTF-8.
OTHER_SPACE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")


def held_out(doc_id: Column) -> Column:
    """The part that no model learns from: crc32 of the id's digits mod 7 is 2."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2


class Subwords:
    """Subword ids of words, each with the space before it; the last id ends a document."""

    def __init__(self, ranks: str):
        import tiktoken

        with open(ranks, "rb") as f:
            known = {base64.b64decode(t): int(i) for t, i in map(bytes.split, f)}
        self.encoder = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=known, special_tokens={})
        self.end = max(known.values()) + 1
        self.lengths = np.zeros(self.end, np.int64)
        for token, i in known.items():
            self.lengths[i] = len(token)

    def of_words(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, one after the other, and how many each has."""
        ids = [self.encoder.encode_ordinary(" " + w.decode("utf-8", "replace")) for w in found]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter((i for own in ids for i in own), np.int64, int(sizes.sum())), sizes

    def of_many(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same, from one text of all words: a space parts words before the merges, so
        no token crosses it, unless a word holds other white space or is no UTF-8."""
        joined = b" " + b" ".join(found) if found else b""
        if OTHER_SPACE.search(joined):
            odd = np.fromiter((OTHER_SPACE.search(w) is not None for w in found), bool, len(found))
            if odd.all():
                return self.of_words(found)
            parts = [self.of_words([w for w, o in zip(found, odd) if o]), self.of_many([w for w, o in zip(found, odd) if not o])]
            sizes, starts = np.empty(len(found), np.int64), np.empty(len(found), np.int64)
            for (ids, own), chosen, base in zip(parts, (odd, ~odd), (0, len(parts[0][0]))):
                sizes[chosen], starts[chosen] = own, base + np.cumsum(own) - own
            return np.concatenate([parts[0][0], parts[1][0]])[spread(starts, sizes)], sizes
        try:
            text = joined.decode("utf-8")
        except UnicodeDecodeError:
            return self.of_words(found)
        ids = np.array(self.encoder.encode_ordinary(text), np.int64)
        word_ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
        token_ends = np.cumsum(self.lengths[ids])
        return ids, np.diff(np.searchsorted(token_ends, word_ends, side="right"), prepend=0)


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each run, one run after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


def _pack(*arrays: np.ndarray) -> bytes:
    return zstandard.compress(b"".join(a.tobytes() for a in arrays), 3)


def _unpack(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), kind)


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """How many words each text has, and all of them, dictionary-encoded.  Words are parted
    by ASCII blanks and A-Z lower-cased; the kernels look at ASCII bytes alone."""
    pieces = pc.ascii_split_whitespace(pc.ascii_lower(texts.view(pa.string())))
    flat = pieces.flatten()
    # A blank at an edge of the text leaves an empty piece.
    full = pc.greater(pc.binary_length(flat), 0)
    before = np.concatenate(([0], np.cumsum(full.to_numpy(zero_copy_only=False))))
    offsets = pieces.offsets.to_numpy() - pieces.offsets[0].as_py()
    return np.diff(before[offsets]).astype(np.int64), flat.filter(full).dictionary_encode()


def _sliced(ranks: str, slice_bytes: int):
    """Documents in slices: the distinct words of a slice, their subword ids, and for each
    document the places of its words among them."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in SLICES.split(", ")]
        number = TaskContext.get().partitionId() << 32
        for table in text_slices(stream, slice_bytes):
            subwords = kept_by_worker(("subwords", ranks), lambda: Subwords(ranks))
            held = np.asarray(table.column("held_out"))
            n_words, flat = split_words(table.column("text_utf8").combine_chunks())
            found, place = flat.dictionary.view(pa.binary()).to_pylist(), flat.indices.to_numpy()
            ids, sizes = subwords.of_many(found)
            train = np.bincount(place[~np.repeat(held, n_words)], minlength=len(found))
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            row = [
                number,
                table.column("doc_id").to_numpy().astype(np.int64).tobytes(),
                held.tobytes(),
                n_words.tobytes(),
                int((~held).sum()),
                len(found),
                _pack(place.astype(np.uint32)),
                zstandard.compress(np.stack([lengths, train]).astype(np.uint32).tobytes() + b"".join(found), 3),
                _pack(sizes.astype(np.uint32), ids.astype(np.uint32)),
                _pack(np.bincount(ids, np.repeat(train, sizes), subwords.end + 1).astype(np.int64)),
            ]
            yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64() if isinstance(v, int) else pa.binary()) for v in row], names)
            number += 1

    return run


class Slice:
    """The documents of a slice as ids, from its row: ``sizes`` ids each, an end among them."""

    def __init__(self, n_words: bytes, places: bytes, word_ids: bytes, n_distinct: int, end: int):
        n_words, place = np.frombuffer(n_words, np.int64), _unpack(places, np.uint32).astype(np.int64)
        word_ids = _unpack(word_ids, np.uint32).astype(np.int64)
        sizes, ids = word_ids[:n_distinct], np.append(word_ids[n_distinct:], end)
        ends = np.cumsum(n_words)
        lengths = np.insert(sizes[place], ends, 1)
        starts = np.insert((np.cumsum(sizes) - sizes)[place], ends, len(ids) - 1)
        self.ids = ids[spread(starts, lengths)]
        total = np.concatenate(([0], np.cumsum(sizes[place])))
        self.sizes = np.diff(total[ends], prepend=0) + 1


SLICE_COLUMNS = ["n_words", "places", "word_ids", "n_distinct"]


def _slice_words(data: bytes, n: int) -> tuple[pa.Array, np.ndarray]:
    """The distinct words of a slice, and how often its training documents hold each."""
    raw = zstandard.decompress(data)
    lengths, train = np.frombuffer(raw, np.uint32, 2 * n).reshape(2, n)
    offsets = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw[8 * n :])]), train


def _shards(found: pa.Array, shards: int) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) % shards for w in found.to_pylist()), np.int64, len(found))


def _chosen(doc_ids: np.ndarray, sizes: np.ndarray, one_of: int, rounds: int, turn: int) -> np.ndarray:
    """Which windows of the documents a round teaches, by a hash of document and place: one
    of ``one_of`` teaches at all, and in one round."""
    n = -(-sizes // attention.STEP)
    place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    h = np.repeat(doc_ids, n).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + place.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return ((h >> np.uint64(33)) % np.uint64(one_of * rounds)) == turn * one_of


def _learned(parameters: attention.Arrays, counts: attention.Counts, context: np.ndarray, target: np.ndarray, per_learner: int, rate: float, seed: list[int]) -> np.ndarray:
    """The windows' number, and what learners of at most ``per_learner`` of them make of the
    weights, weighed by their windows."""
    learners = -(-len(target) // per_learner)
    total = np.zeros(1 + attention.flat(parameters).size)
    for k in range(learners):
        model = attention.Attention(dict(parameters), counts)
        model.learn(context[k::learners], target[k::learners], np.random.default_rng([*seed, k]), rate)
        total += np.concatenate(([1.0], attention.flat(model.p).astype(np.float64))) * len(target[k::learners])
    return total


class CorpusModel:
    """Both models of ``docs``, learned from the documents that are not held out."""

    def __init__(self, docs: DataFrame, ranks: str = RANKS, one_window_of: int = ONE_WINDOW_OF, windows_per_learner: int = WINDOWS_PER_LEARNER, rounds: int = ROUNDS, rate: float = RATE, slice_bytes: int = SLICE_BYTES):
        self.ranks = ranks
        rows = doc_rows(docs, text_bytes().alias("text_utf8"))
        rows = rows.withColumn("held_out", held_out(F.col("doc_id")))
        self.slices = written(rows.mapInArrow(_sliced(ranks, slice_bytes), SLICES), "slices")
        self._count_words()
        self.counts = self._count_neighbours()
        self.parameters = self._learn(one_window_of, windows_per_learner, rounds, rate)

    def _count_words(self) -> None:
        """``answers``: (slice, shard, counts): for the words of a slice that belong to a
        shard, in their order, how often the training documents of the corpus hold them.

        A word meets its shard with one row per slice, however often it occurs; the
        shards are as many as keep the words that meet in one about equally many.
        """
        zero = F.lit(0)
        self.ends, n_distinct = self.slices.agg(F.coalesce(F.sum("n_train"), zero), F.coalesce(F.sum("n_distinct"), zero)).first()
        self.shards = shards = max(1, -(-n_distinct // WORDS_PER_SHARD))

        def deal(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in stream:
                for number, data, n in zip(*(batch.column(c).to_pylist() for c in ("slice", "words", "n_distinct"))):
                    found, train = _slice_words(data, n)
                    shard = _shards(found, shards)
                    order = np.argsort(shard, kind="stable")
                    starts = np.searchsorted(shard[order], np.arange(shards + 1))
                    found, train = found.take(pa.array(order)), train[order]
                    ends = np.frombuffer(found.buffers()[1], np.int32)[: n + 1].astype(np.int64)
                    lengths, whole = np.diff(ends).astype(np.uint32), found.buffers()[2].to_pybytes() if n else b""
                    full = np.flatnonzero(np.diff(starts)).tolist()
                    bounds = [(starts[k], starts[k + 1]) for k in full]
                    sizes = [int(j - i) for i, j in bounds]
                    blobs = [zstandard.compress(lengths[i:j].tobytes() + train[i:j].tobytes() + whole[ends[i] : ends[j]], 3) for i, j in bounds]
                    yield pa.RecordBatch.from_arrays([pa.array([number] * len(full), pa.int64()), pa.array(full, pa.int64()), pa.array(sizes, pa.int64()), pa.array(blobs, pa.binary())], ["slice", "shard", "n", "words"])

        def count(key: tuple, rows: pa.Table) -> pa.Table:
            parts = [_slice_words(data, n) for data, n in zip(rows.column("words").to_pylist(), rows.column("n").to_pylist())]
            coded = pa.chunked_array([found for found, _ in parts], pa.binary()).combine_chunks().dictionary_encode()
            code, train = coded.indices.to_numpy(), np.concatenate([t for _, t in parts]).astype(np.int64)
            total = np.bincount(code, train, len(coded.dictionary)).astype(np.int64)
            bounds = np.cumsum([0, *(len(found) for found, _ in parts)])
            answers = [_pack(total[code[i:j]]) for i, j in zip(bounds[:-1], bounds[1:])]
            # The shard's sums stand in its first row.
            sums = [[int(v), *[0] * (len(answers) - 1)] for v in (total.sum(), (total > 0).sum())]
            return pa.table({"slice": rows.column("slice"), "shard": rows.column("shard"), "counts": pa.array(answers, pa.binary()), "total": pa.array(sums[0], pa.int64()), "distinct": pa.array(sums[1], pa.int64())})

        blocks = self.slices.select("slice", "words", "n_distinct").mapInArrow(deal, "slice long, shard long, n long, words binary")
        answers = blocks.groupBy("shard").applyInArrow(count, "slice long, shard long, counts binary, total long, distinct long")
        self.answers = written(answers, "answers")
        total, distinct = self.answers.agg(F.coalesce(F.sum("total"), zero), F.coalesce(F.sum("distinct"), zero)).first()
        self.train_tokens, self.distinct = total + self.ends, distinct + (self.ends > 0)

    def _count_neighbours(self) -> attention.Counts:
        """Counts of the ids, then of their neighbours, over all training documents."""
        end = kept_by_worker(("subwords", self.ranks), lambda: Subwords(self.ranks)).end
        per_id = tree_sum(self.slices.select(F.col("slice").alias("part"), F.col("id_counts").alias("data")), np.int64)
        per_id = np.zeros(end + 1, np.int64) if per_id is None else per_id.copy()
        per_id[end] = self.ends
        counts = attention.Counts.of_ids(per_id)

        def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part, dense = TaskContext.get().partitionId(), None
            for batch in stream:
                for held, *row in zip(*(batch.column(c).to_pylist() for c in ("held", *SLICE_COLUMNS))):
                    own = Slice(*row, end)
                    taught = ~np.repeat(np.frombuffer(held, bool), own.sizes)
                    # Each document begins after an end, as after the one before it.
                    before = np.concatenate(([end], own.ids[:-1]))
                    found = np.concatenate(counts.neighbours(before[taught], own.ids[taught]))
                    dense = found if dense is None else dense + found
            if dense is not None:
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([_pack(dense)], pa.binary())], ["part", "data"])

        made = self.slices.select("held", *SLICE_COLUMNS).mapInArrow(run, "part long, data binary")
        dense = tree_sum(written(made, "neighbours"), np.int64)
        split = counts.n_before * counts.n_classes
        if dense is None:
            dense = np.zeros(split + counts.n_before * counts.n_inputs, np.int64)
        return counts.with_neighbours(dense[:split], dense[split:])

    def _learn(self, one_of: int, per_learner: int, rounds: int, rate: float) -> attention.Arrays:
        """Every slice teaches where it lies: its windows do not move, the weights do."""
        counts = self.counts
        end = len(counts.of_id) - 1

        def teacher(parameters: attention.Arrays, turn: int):
            def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                part, total = TaskContext.get().partitionId(), None
                for batch in stream:
                    for number, doc_ids, held, *row in zip(*(batch.column(c).to_pylist() for c in ("slice", "doc_ids", "held", *SLICE_COLUMNS))):
                        held, own = np.frombuffer(held, bool), Slice(*row, end)
                        sizes, ids = own.sizes[~held], own.ids[~np.repeat(held, own.sizes)]
                        chosen = _chosen(np.frombuffer(doc_ids, np.int64)[~held], sizes, one_of, rounds, turn)
                        context, target = attention.windows(ids, sizes, end, chosen=chosen)
                        if len(target):
                            found = _learned(parameters, counts, context, target, per_learner, rate * (1 - turn / rounds), [turn, number])
                            total = found if total is None else total + found
                if total is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([_pack(total)], pa.binary())], ["part", "data"])

            return run

        parameters = attention.first_parameters()
        slices = self.slices.select("slice", "doc_ids", "held", *SLICE_COLUMNS)
        for turn in range(rounds):
            total = tree_sum(written(slices.mapInArrow(teacher(parameters, turn), "part long, data binary"), "learned"), np.float64)
            if total is not None:
                parameters = attention.shaped(total[1:] / total[0], parameters)
        return parameters

    def base_scores(self) -> DataFrame:
        """(slice, place, doc_id, held_out, n_tokens, n_known, base_score): the shards'
        answers come back to the slice whose words they are."""
        ends, room, shards = self.ends, self.train_tokens + self.distinct + 1, self.shards

        def run(key: tuple, slices: pa.Table, answers: pa.Table) -> pa.Table:
            row = {c: slices.column(c)[0].as_py() for c in ("doc_ids", "held", "n_words", "places", "words", "n_distinct")}
            doc_ids, held, n_words = (np.frombuffer(row[c], k) for c, k in (("doc_ids", np.int64), ("held", bool), ("n_words", np.int64)))
            found, _ = _slice_words(row["words"], row["n_distinct"])
            parts = answers.column("counts").to_pylist()
            counts = np.zeros(len(found), np.int64)
            if parts:
                by_shard = np.argsort(answers.column("shard").to_numpy())
                counts[np.argsort(_shards(found, shards), kind="stable")] = np.concatenate([_unpack(parts[i], np.int64) for i in by_shard])
            place, doc = _unpack(row["places"], np.uint32), np.repeat(np.arange(len(held)), n_words)
            score = np.bincount(doc, np.log10((counts + 1.0) / room)[place], len(held)) + math.log10((ends + 1) / room)
            known = np.bincount(doc, (counts > 0)[place], len(held)).astype(np.int64) + (ends > 0)
            return pa.table({"slice": pa.array(np.full(len(held), key[0].as_py())), "place": pa.array(np.arange(len(held))), "doc_id": pa.array(doc_ids), "held_out": pa.array(held), "n_tokens": pa.array(n_words + 1), "n_known": pa.array(known), "base_score": pa.array(score)})

        own = self.slices.select("slice", "doc_ids", "held", "n_words", "places", "words", "n_distinct")
        answers = self.answers.select("slice", "shard", "counts")
        schema = "slice long, place long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double"
        return own.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(run, schema)

    def model_scores(self) -> DataFrame:
        """(slice, place, score): log10 of the model's probability of each whole document."""
        parameters, counts = self.parameters, self.counts
        end = len(counts.of_id) - 1

        def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = attention.Attention(parameters, counts)
            for batch in stream:
                for number, *row in zip(*(batch.column(c).to_pylist() for c in ("slice", *SLICE_COLUMNS))):
                    own = Slice(*row, end)
                    score = model.documents(own.ids, own.sizes, end) / math.log(10)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(score), number)), pa.array(np.arange(len(score))), pa.array(score)], ["slice", "place", "score"])

        return self.slices.select("slice", *SLICE_COLUMNS).mapInArrow(run, "slice long, place long, score double")

    def scores(self) -> DataFrame:
        found = self.base_scores().join(self.model_scores(), ["slice", "place"])
        return found.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(self.train_tokens).cast("long").alias("train_tokens"), "base_score", "score")


def op12_scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score for each row.

    A null text is an empty one: its only token is the end.  Repeated rows, and rows with
    a null doc_id (read as -1), are documents of their own; other columns are not read.
    Without training documents each count is 0 and the model is its untrained start.  A
    text is one value of one task: about 100 bytes of memory for each of its bytes.
    """
    return CorpusModel(docs).scores()
