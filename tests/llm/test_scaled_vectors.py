"""Vectors that differ in scale or length alone, against brute force."""

import numpy as np

from ledgerleaf.llm import vectors


def test_scaled_vectors_and_other_lengths_link(spark):
    rng = np.random.default_rng(8)
    base = rng.standard_normal(8)
    rows = [(1, [1.0] + [0.0] * 7, 0), (2, [3.0] + [-0.0] * 7, 0), (3, [3.0] + [0.0] * 7, 0)]
    rows += [(10 + k, (base * 2.0**k).tolist(), 1) for k in range(4)] + [(14, (base * 2.0).tolist(), 1)]
    rows += [(20, [1.0, 2.0, 3.0], 1), (21, [1.0, 2.0, 3.0], 1), (22, [2.0, 4.0, 6.1], 1), (23, [3.0, -1.0, 0.0], 1), (24, [1.0, 2.0, 3.0], 0)]
    rows += [(30, [5.0], 1), (31, [0.5], 1), (32, [-5.0], 1), (33, [], 1), (40, [1e200] * 8, 2), (41, [1e-200] * 8, 2)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.op4_near_vectors(frame).collect()}
    groups = [{1, 2, 3}, set(range(10, 15)), {20, 21, 22}, {23}, {24}, {30, 31}, {32}, {33}, {40, 41}]
    assert found == {i: (len(g) - 1, min(g), i == min(g)) for g in groups for i in g}


def test_repeated_and_null_ids(spark):
    """Rows that share an id are vectors of their own: links are counted row by row."""
    rng = np.random.default_rng(9)
    centres = rng.standard_normal((6, 12))
    rows = []
    for k in range(90):
        near = centres[k % 6] + 0.08 * rng.standard_normal(12)
        rows.append((None if k % 11 == 0 else k % 23, near.tolist(), k % 2))
    rows += rows[:7] + [(None, [1.0, 0.0], 0), (3, [2.0, 0.0], 0), (None, None, 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    ids = [-1 if i is None else i for i, _, _ in rows]
    units = [None if v is None else np.array(v) / np.linalg.norm(v) for _, v, _ in rows]
    links = [{j for j, b in enumerate(units) if j != i and a is not None and b is not None and len(a) == len(b) and rows[i][2] == rows[j][2] and a @ b >= 0.93} for i, a in enumerate(units)]
    component = list(ids)
    for _ in rows:
        component = [min([component[i], *(component[j] for j in links[i])]) for i in range(len(rows))]
    want = sorted((ids[i], len(links[i]), component[i], ids[i] == component[i]) for i in range(len(rows)))
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in vectors.op4_near_vectors(frame).collect()) == want
