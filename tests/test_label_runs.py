"""Distances summed over the members of labels, rows with equal labels standing together."""

import numpy as np
import pytest

from gridlloyd.operators import blocks


@pytest.mark.parametrize("sort", [True, False])
def test_runs_of_equal_members_are_added_up_first(sort, monkeypatch):
    rng = np.random.default_rng(3)
    x, y = rng.normal(0, 1, (700, 3)), rng.normal(0, 1, (1100, 3))
    members, products, real = [], [], blocks._by_member
    for n in (700, 1100):
        labels = rng.integers(0, 3, (n, 2))
        labels = labels[np.lexsort(labels.T)] if sort else labels
        members.append(np.concatenate([labels == k for k in range(3)], axis=1).astype(float))
    monkeypatch.setattr(blocks, "_by_member", lambda d, m, runs: products.append(len(runs) * blocks.LONG_RUN <= len(m)) or real(d, m, runs))
    gap = np.sqrt(((x[:, None] - y[None]) ** 2).sum(-1))
    to_x, to_y = np.zeros((700, 6)), np.zeros((1100, 6))
    blocks.add_distances(x, y, *members, to_x, to_y)
    assert np.allclose(to_x, gap @ members[1]) and np.allclose(to_y, gap.T @ members[0])
    own, gap = np.zeros((700, 6)), np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    blocks.add_distances(x, None, members[0], None, own, None)
    assert np.allclose(own, gap @ members[0]) and set(products) == {sort}
