"""Induced sorting against sorted slices, with tiny blocks and with queues that go to disk."""

import numpy as np
import pytest

from wardflow.llm import induced


@pytest.mark.parametrize(("block", "memory"), [(1 << 16, 1 << 26), (3, 1 << 26), (5, 40)])
def test_order_and_shared_prefixes(monkeypatch, block, memory):
    monkeypatch.setattr(induced, "BLOCK", block)
    monkeypatch.setattr(induced, "MEMORY", memory)
    r = np.random.default_rng(block)
    bodies = [r.integers(1, r.integers(2, 6), r.integers(1, 120)) for _ in range(60)] + [np.ones(300, int), np.tile([1, 2], 150), np.tile([3, 2, 1, 1], 40)]
    for body in bodies:
        depth = int(r.choice([3, 10, 200]))
        text = np.append(body, 0).astype(np.int16)
        position, shared = induced.sorted_suffixes(text, depth)
        suffixes = [tuple(text[p : p + depth].tolist()) for p in position]
        assert sorted(position.tolist()) == list(range(len(text)))
        assert suffixes == sorted(suffixes, reverse=True)
        for k in range(1, len(position)):
            n = next((i for i, (a, b) in enumerate(zip(suffixes[k - 1], suffixes[k], strict=False)) if a != b), min(len(suffixes[k - 1]), len(suffixes[k])))
            assert shared[k] == min(n, depth)
