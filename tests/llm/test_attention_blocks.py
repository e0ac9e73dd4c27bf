"""The attention works on blocks of windows that stay in a core's cache."""

import tracemalloc

import numpy as np

from ledgerleaf.llm import attention


def model_and_windows(n=128):
    rng = np.random.default_rng(4)
    ids = np.minimum(rng.zipf(1.3, 32 * n) - 1, 4999)
    counts = attention.Counts.of_ids(np.bincount(ids, minlength=5001))
    counts.with_neighbours(*counts.neighbours(ids[:-1], ids[1:]))
    p = {k: v + rng.normal(0, 0.2, v.shape).astype(np.float32) for k, v in attention.first_parameters().items()}
    sizes = np.array([5, 32 * n - 5 - 700, 700])
    return attention.Attention(p, counts), *attention.windows(ids, sizes, 5000)


def test_a_gradient_holds_no_array_of_all_targets_and_classes():
    model, context, target = model_and_windows()
    whole = context.shape[0] * attention.STEP * attention.CLASSES * 4
    tracemalloc.start()
    model.gradient(context, target)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 * whole


def test_blocks_of_any_size_give_the_same(monkeypatch):
    model, context, target = model_and_windows(70)
    loss, gradient = model.gradient(context, target)
    scores = model.log_probabilities(context, target)
    for block, rows in ((1, 7), (1000, 100_000)):
        monkeypatch.setattr(attention, "BLOCK", block)
        monkeypatch.setattr(attention, "ROWS", rows)
        other_loss, other = model.gradient(context, target)
        assert np.isclose(loss, other_loss, rtol=1e-5)
        assert np.allclose(scores, model.log_probabilities(context, target, rows=1 << 12), rtol=1e-4, atol=1e-4)
        for k, g in gradient.items():
            assert np.allclose(g, other[k], rtol=1e-3, atol=1e-5), k
