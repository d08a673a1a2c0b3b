"""The best path in blocks is that of the whole document, and the best of all paths."""

from __future__ import annotations

import itertools

import numpy as np

from shelfspark.llm import langid


def model(n, penalty=6.0):
    m = langid.Model.__new__(langid.Model)
    m.langs, m.penalty = [str(k) for k in range(n)], np.float32(penalty)
    return m


def total(score, label, penalty):
    return score[np.arange(len(label)), label].sum(dtype=np.float64) - penalty * np.count_nonzero(np.diff(label))


def test_blocks_and_whole_documents(monkeypatch):
    rng = np.random.default_rng(1)
    for _ in range(30):
        n, k = rng.integers(0, 500, 6), int(rng.integers(1, 6))
        doc = np.repeat(np.arange(6), n)
        score = rng.normal(0, 3, (len(doc), k)).astype(np.float32)
        label = model(k).path(score, doc, 6)
        monkeypatch.setattr(langid, "MATRIX", 0)
        assert (model(k).path(score, doc, 6) == label).all()
        monkeypatch.undo()


def test_best_of_all_paths(monkeypatch):
    monkeypatch.setattr(langid, "BLOCK", 3)
    rng = np.random.default_rng(2)
    for _ in range(20):
        score = rng.normal(0, 3, (8, 3)).astype(np.float32)
        label = model(3, 2.0).path(score, np.zeros(8, int), 1)
        assert np.isclose(total(score, label, 2.0), max(total(score, np.array(p), 2.0) for p in itertools.product(range(3), repeat=8)))


def test_repeats_of_a_text_count_once(spark):
    rows = [("the cat and the dog", "en")] * 300 + [("le chat et le chien", "fr")]
    df = spark.createDataFrame(rows, "text string, lang string")
    once = spark.createDataFrame(rows[-2:], "text string, lang string")
    assert np.allclose(langid.fit(df).table, langid.fit(once).table)
