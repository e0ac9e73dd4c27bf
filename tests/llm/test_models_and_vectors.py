"""Classifiers by held-out accuracy, vectors against brute force, the pipeline by its stages."""

import itertools
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerleaf.llm import quality, toxicity, vectors
from ledgerleaf.llm.components import components
from ledgerleaf.llm.tools import table


@pytest.fixture(scope="module")
def tables(spark):
    return table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")


def held(found, labels, name):
    known = labels.select("doc_id", name)
    return found.join(known, "doc_id").filter("held_out").toPandas()


def test_quality(spark, tables):
    docs, labels = tables
    found = quality.op2_quality(docs, labels)
    test = held(found, labels, "quality")
    assert (test.predicted == test.quality).mean() > 0.95
    everything = found.toPandas()
    assert len(everything) == docs.count() and everything.score.between(0, 1).all()
    assert all(h == (zlib.crc32(str(i).encode()) % 3 == 1) for i, h in zip(everything.doc_id, everything.held_out))


def test_toxicity(spark, tables):
    docs, labels = tables
    found = toxicity.op6_toxicity(docs, labels)
    test = held(found, labels, "toxic")
    assert (test.predicted == test.toxic).mean() > 0.9
    assert test.severity[test.toxic == 1].mean() > 3 * test.severity[test.toxic == 0].mean()


def test_models_on_odd_rows(spark, tables):
    odd = spark.createDataFrame(
        [(1, None, 1), (2, "", 2), (None, "words without an id", 3), (4, "\t \n", 4), (5, "z" * 3000, 5), (5, "z" * 3000, 5)], "doc_id long, text string, label int"
    )
    labels = spark.createDataFrame([(1, 0, 0), (2, 1, None), (None, 1, 1), (4, None, 1), (5, 1, 1), (5, 0, 0)], "doc_id long, quality int, toxic int")
    for operator in (quality.op2_quality, toxicity.op6_toxicity):
        for known in (labels, labels.limit(0)):
            found = operator(odd, known).collect()
            assert Counter(r.doc_id for r in found) == Counter([1, 2, -1, 4, 5, 5]) and all(0 <= r.score <= 1 for r in found)
        assert operator(odd.limit(0), labels).count() == 0


def test_ordinal_thresholds_rise_and_share_weights():
    rng = np.random.default_rng(1)
    texts = [" ".join(rng.choice(["plain", "words", "only", "here"], 40)).encode() for _ in range(200)]
    label = np.arange(200) % 2
    texts = [t + b" awful" * (1 + i % 3) + (b" vile" if i % 4 == 1 else b"") if y else t for i, (t, y) in enumerate(zip(texts, label))]
    model = toxicity.train(texts, label)
    assert (np.diff(model.thresholds) > 0).all()
    above = toxicity.predict(model, texts)
    assert (np.diff(above, axis=1) <= 0).all() and ((above[:, 0] >= 0.5) == label).all()


def test_folded_scores_are_the_model():
    rng = np.random.default_rng(2)
    model = quality.SubwordModel(rng.standard_normal((1 << 10, 4)), rng.standard_normal((2, 4)), rng.standard_normal(2))
    texts = [b"some words and words", b"", b"other"]
    got = quality.probabilities(texts, model.folded(), model.bias, 10)
    for text, score in zip(texts, got):
        features = np.concatenate([f for f, _ in quality.feature_rows([text], 10)])
        mean = model.vectors[features].mean(axis=0) if len(features) else np.zeros(4)
        logits = model.output @ mean + model.bias
        assert abs(score - 1 / (1 + np.exp(logits[0] - logits[1]))) < 1e-5


def clustered(n, dims=24, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((n // 8, dims))
    return np.repeat(centres, 8, axis=0) + 0.25 * rng.standard_normal((n // 8 * 8, dims))


def test_vectors(spark):
    x = clustered(640)
    rows = [(i, [float(v) for v in r], i // 40 % 2, i) for i, r in enumerate(x)]
    rows += [(1000 + i, rows[i][1], rows[i][2], i) for i in range(5)] + [(3000, rows[0][1], None, 0)]
    rows += [(2000, None, 1, 0), (2001, [0.0] * 24, 1, 0), (2002, [float("nan")] * 24, 1, 0), (2003, [None] + [1.0] * 23, 1, 0), (2004, [1.0], 1, 0), (2005, [float("inf")] * 24, 0, 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, node int")
    found = {r.vec_id: r for r in vectors.op4_near_vectors(frame).collect()}
    assert len(found) == len(rows)
    usable = [(i, np.array(v), k) for i, v, k, _ in rows if k is not None and i < 2000]
    unit = np.stack([v / np.linalg.norm(v) for _, v, _ in usable])
    same = np.array([k for _, _, k in usable])
    links = (unit @ unit.T >= 0.93) & (same[:, None] == same[None, :])
    np.fill_diagonal(links, False)
    want = {usable[i][0]: int(n) for i, n in enumerate(links.sum(axis=1))}
    got = sum(found[i].n_links for i in want)
    assert sum(want.values()) * 0.98 <= got <= sum(want.values())
    assert all(found[i].n_links <= n for i, n in want.items())
    assert all(found[i].n_links == 0 and found[i].kept for i in (2000, 2001, 2002, 2003, 2004, 2005, 3000))
    assert all(found[1000 + i].component_id == found[i].component_id for i in range(5))
    assert vectors.op4_near_vectors(frame.limit(0)).count() == 0


def test_cross_polytope_rotations_keep_lengths():
    x = np.random.default_rng(4).standard_normal((5, 20))
    lsh = vectors.CrossPolytope(20, 1, 2)
    assert np.allclose(np.linalg.norm(lsh.rotated(x, 0, 0), axis=1), np.linalg.norm(x, axis=1))
    own, more = lsh.buckets(x, 0, 3)
    assert more.shape == (5, 3) and not (more == own[:, None]).any()


def test_components(spark):
    rng = np.random.default_rng(5)
    links = [(i, i + 1) for i in range(60)] + [tuple(map(int, e)) for e in rng.integers(100, 200, (60, 2))] + [(300, 300)]
    label = {n: n for e in links[:-1] for n in e}
    for _ in label:
        for a, b in links[:-1]:
            label[a] = label[b] = min(label[a], label[b])
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {n: c for n, c in label.items() if n in found} == found
    assert all(n == c and all(n not in e or e == (n, n) for e in links) for n, c in label.items() if n not in found)


def test_pipeline(spark):
    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents").limit(60).cache()
    columns = docs.columns
    for name, stage in itertools.islice(corpus_pipeline.STAGES, 4):
        before, docs = docs, stage(spark, docs, sf).cache()
        assert docs.columns == columns and docs.count() > 0, name
        if name != "mix_sources":
            assert docs.count() <= before.count()
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert pieces.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    assert corpus_pipeline.run(spark, sf).agg(F.sum("length")).first()[0] > 0
