"""Language-model scoring: the base against plain counts, the attention against naive
loops, its gradient against differences, and what it learns on held-out documents."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ledgerleaf.llm import attention
from ledgerleaf.llm.scoring import ONE_WINDOW_OF, RANKS, ROUNDS, CorpusModel, Subwords, _chosen, op12_scores, split_words

SCHEMA = "doc_id long, text string, slice long, word string, n long, at int, place long, total long"


def rows():
    rng = np.random.default_rng(6)
    known = ["alpha", "Beta", "gamma", "ÉLAN", "日本", "x-y", "the", "of"]
    out = [(i, rng.choice([" ", "\n", "\t ", "\x0b"]).join(rng.choice(known, int(n)))) for i, n in enumerate(rng.integers(1, 60, 90))]
    out += [(200, None), (201, ""), (202, " \n "), (203, "neverseen " * 3), (None, "no id"), (5, "repeated id"), (5, "repeated id"), (204, "w " * 30000), (205, "y" * 100000)]
    return [*out, *((300 + i, f"unseen{i} of the rest") for i in range(40))]


def plain_words(text):
    return (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).replace("\x0b", " ").replace("\x0c", " ").encode().split()


def brute(docs):
    docs = [(-1 if i is None else i, plain_words(t)) for i, t in docs]
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in docs]
    counts = Counter(w for (_, own), h in zip(docs, held) if not h for w in [*own, None])
    n, v = sum(counts.values()), len(counts)
    score = lambda own: sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in [*own, None])
    return [(i, h, len(own) + 1, sum(counts[w] > 0 for w in [*own, None]), n, round(score(own), 6)) for (i, own), h in zip(docs, held)]


@pytest.mark.parametrize("slice_bytes", [8 << 20, 1500])
def test_base(spark, slice_bytes):
    docs = spark.createDataFrame([(*r, 1, "w", 2, 3, 4, 5) for r in rows()], SCHEMA).repartition(3)
    got = CorpusModel(docs, slice_bytes=slice_bytes, windows_per_learner=4, one_window_of=2, rounds=1).scores().collect()
    assert Counter((*tuple(r)[:5], round(r["base_score"], 6)) for r in got) == Counter(brute(rows()))
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_odd_tables(spark):
    one = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert op12_scores(one.limit(0)).count() == 0
    assert op12_scores(one).count() == 1


def test_words_and_their_ids_as_one_by_one():
    texts = [None, b"", b" \n", "A b\u00a0 \u00a0c\u3000 \u2003d".encode(), b"x\x0by\x0cz\x1cq", "it's ÉLAN 日本 ".encode(), b"\xff\xfe bad", b"2026, (ok)"]
    texts = [t or b"" for t in texts]
    n, flat = split_words(pa.array([b"skipped text", *texts], pa.binary()).slice(1))
    found = flat.dictionary.view(pa.binary()).to_pylist()
    assert n.tolist() == [len(t.lower().split()) for t in texts]
    assert [found[i] for i in flat.indices.to_pylist()] == [w for t in texts for w in t.lower().split()]
    subwords = Subwords(RANKS)
    for some in (found, [w for w in found if b"\xff" not in w], found[:1], []):
        for one, many in zip(subwords.of_words(some), subwords.of_many(some)):
            assert one.tolist() == many.tolist()


def small_model(seed=0):
    rng = np.random.default_rng(seed)
    counts = attention.Counts.of_ids(rng.integers(0, 50, 40), 8, 5, 12, 6)
    ids = rng.integers(0, 40, 500)
    counts.with_neighbours(*counts.neighbours(ids[:-1], ids[1:]))
    p = attention.first_parameters(1, 12, 4, 8, 6)
    p = {k: v + rng.normal(0, 0.3, v.shape).astype(np.float32) for k, v in p.items()}
    return attention.Attention(p, counts)


def naive(model, ids, start, step=3):
    """ln P of a document, one token and one place at a time."""
    p, c, total = model.p, model.counts, 0.0
    seen = [start, *ids]
    for t, i in enumerate(ids):
        first = max(0, t - t % step + step - model.window)
        q = p["embed"][c.input_of[seen[t]]] @ p["query"] / 2
        weight = [math.exp(q @ (p["embed"][c.input_of[seen[j]]] @ p["key"]) + p["distance"][t - j]) for j in range(first, t + 1)]
        mixed = sum(w * (p["embed"][c.input_of[seen[j]]] @ p["value"]) for w, j in zip(weight, range(first, t + 1))) / sum(weight)
        h = mixed + p["direct"][c.input_of[seen[t]]]
        h = h / (1 + abs(h))
        row = min(c.input_of[seen[t]], c.n_before - 1)
        e = np.exp(h @ p["output"]) * c.next_class[row]
        total += math.log(e[c.of_id[i]] / e.sum() * c.inside(np.array([row]), np.array([i]))[0])
    return total


def test_windows_score_each_token_once_as_loops_do():
    model, rng = small_model(), np.random.default_rng(1)
    docs = [rng.integers(0, 40, n) for n in (1, 3, 4, 7, 20)]
    ids, sizes = np.concatenate(docs), np.array([len(d) for d in docs])
    context, target = attention.windows(ids, sizes, 39, 3, 6)
    assert target[target != attention.NO_TOKEN].tolist() == ids.tolist()
    rows = np.repeat(np.arange(5), -(-sizes // 3))
    got = np.bincount(rows, model.log_probabilities(context, target, rows=4).sum(axis=1))
    assert np.allclose(got, [naive(model, d.tolist(), 39) for d in docs], atol=1e-3)


def test_probabilities_of_all_ids_sum_to_one():
    model = small_model()
    context = np.tile([[attention.NO_TOKEN, 3, 7, 39, 5, 11]], (40, 1))
    target = np.full((40, 3), attention.NO_TOKEN)
    target[:, 2] = np.arange(40)
    assert math.isclose(np.exp(model.log_probabilities(context, target)[:, 2]).sum(), 1, rel_tol=1e-5)


def test_gradient():
    model, rng = small_model(), np.random.default_rng(3)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    ids = rng.integers(0, 40, 30)
    context, target = attention.windows(ids, np.array([10, 20]), 39, 3, 6)
    _, gradient = model.gradient(context, target)
    for k, g in gradient.items():
        for at in zip(*(rng.integers(0, s, 5) for s in g.shape)):
            ends = []
            for d in (1e-4, -1e-4):
                model.p[k][at] += d
                ends.append(model.gradient(context, target)[0])
                model.p[k][at] -= d
            assert math.isclose((ends[0] - ends[1]) / 2e-4, g[at], rel_tol=2e-2, abs_tol=2e-4), (k, at)


def test_learning_beats_the_counts_it_starts_from(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    learned = CorpusModel(docs, one_window_of=2, rounds=3).scores().filter("held_out").groupBy().sum("score", "n_tokens").first()
    start = CorpusModel(docs, one_window_of=2, rounds=0).scores().filter("held_out").groupBy().sum("score", "n_tokens").first()
    assert learned[0] > start[0]


def test_every_window_teaches_in_one_round():
    sizes, doc_ids = np.array([1, 32, 33, 5000]), np.array([7, -1, -1, 2**40])
    taught = sum(_chosen(doc_ids, sizes, ONE_WINDOW_OF, ROUNDS, turn).astype(int) for turn in range(ROUNDS))
    assert len(taught) == 1 + 1 + 2 + 157 and (taught == 1).all()


def test_weights_learn_from_documents_of_one_window(spark):
    """32 short documents of one window each were mostly left out of the weights."""
    docs = spark.createDataFrame([(i, f"word{i} and more") for i in range(4)], "doc_id long, text string").repartition(1)
    model = CorpusModel(docs)
    assert np.abs(model.parameters["output"]).sum() > 0
