"""Findings of round 4 on training-data operators."""

import numpy as np
import pytest

from tessera.llm import topk


@pytest.mark.parametrize("pending", [40, 1_000_000])
def test_leaves_meet_in_few_products_with_all_ties(monkeypatch, pending):
    monkeypatch.setattr(topk, "MAX_PENDING", pending, raising=False)
    rng = np.random.default_rng(7)
    p, q = rng.integers(-300, 300, (6000, 64)), rng.integers(-300, 300, (700, 64))
    p[100:140] = p[0]  # ties
    tree = topk.CoverTree(p.astype(float))
    assert len(tree.nodes) < 200  # not a few points to a leaf
    ids = [np.array([3 * i, 3 * i + 1]) for i in range(6000)]
    qids = np.arange(700) * 30
    flat = np.concatenate(ids)
    s = np.repeat(q @ p.T, 2, axis=1)
    s = np.where(flat[None, :] == qids[:, None], np.iinfo(np.int64).min, s)
    order = np.lexsort((np.broadcast_to(flat, s.shape), -s.astype(float)), axis=1)[:, :10]
    tenth = np.take_along_axis(s, order, 1)[:, 9]
    for floor in (np.full(700, -np.inf), tenth.astype(float)):
        score, found = topk.dual_tree(p, ids, q, qids, floor, 10)
        assert (found == flat[order]).all() and (score == np.take_along_axis(s, order, 1)).all()
    score, _ = topk.dual_tree(p, ids, q, qids, tenth + 1.0, 10)
    assert (score != np.take_along_axis(s, order, 1))[:, 9].all()  # below the bound: not needed


def test_first_bounds_stay_below_large_products():
    q = np.array([[1 << 29, (1 << 29) + 1, -(1 << 29)]], np.int64)
    sample = np.array([[(1 << 29) + i, 1 << 29, (1 << 30) + i + 1] for i in range(12)], np.int64)
    floor = topk.first_floor(q, np.array([99]), sample, [np.array([i]) for i in range(12)], 10)
    exact = sorted((sum(int(a) * int(b) for a, b in zip(q[0], s)) for s in sample), reverse=True)
    assert floor[0] <= exact[9]
