"""Codebooks of wide vectors in little memory, the same as by a dense solution."""

from __future__ import annotations

import tracemalloc

import numpy as np

from shelfspark.llm import ann


def test_solution_is_the_dense_one():
    rng = np.random.default_rng(1)
    n, m, size = 200, 6, 6 * 16
    column = np.arange(m) * 16 + rng.integers(0, 16, (n, m))
    value = rng.normal(size=(n, m))
    left, right = rng.random(size) + 0.1, rng.normal(size=size)
    v = np.zeros((n, size))
    np.put_along_axis(v, column, value, 1)
    dense = np.linalg.solve(3.5 * v.T @ v + np.diag(left), right)
    assert np.allclose(ann.solved(column, value, 3.5, left, right, np.zeros(size)), dense, atol=1e-5)


def test_wide_vectors_fit_in_little_memory():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 1536))
    tracemalloc.start()
    q = ann.Quantiser(1536).fit(x)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 400e6
    codes = q.encode(x[:100])
    back = q.books[np.arange(q.m), codes].reshape(100, -1)
    assert np.square(back - x[:100]).sum() < 0.25 * np.square(x[:100]).sum()
