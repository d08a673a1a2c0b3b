"""Near duplicates take memory by the batch that is at hand, whatever the length of texts."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa

from shelfspark.llm import near

NAME = "spark.sql.execution.arrow.maxRecordsPerBatch"


def peak(run) -> int:
    """Bytes of Python and numpy at once while ``run`` yields batches that nobody keeps."""
    tracemalloc.start()
    try:
        for _ in run:
            pass
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_exploded_features_are_not_held_together():
    """20 MB of features go on in parts, in the same order."""
    n, each = 2000, 1250
    ids, w = np.arange(n * each, dtype=np.int32).reshape(n, each), np.ones(each, np.float32).tobytes()
    batch = pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array([x.tobytes() for x in ids], pa.binary()), pa.array([w] * n, pa.binary())], names=["node", "ids", "w"])
    assert peak(near._explode([batch])) < 8_000_000
    out = pa.Table.from_batches(list(near._explode([batch])))
    assert out["id"].to_pylist() == list(range(n * each)) and out["node"].to_numpy().tolist() == np.repeat(np.arange(n), each).tolist()


def test_features_go_on_chunk_by_chunk():
    """A batch of many texts gives several batches, a row a text and in order, empty texts too."""

    class Weights:
        value = np.ones(near.BUCKETS, np.float32)

    texts = ["" if k % 7 == 0 else " ".join(f"w{k}x{i}" for i in range(300)) for k in range(400)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(400), pa.int64()), pa.array(texts)], names=["node", "text"])
    out = list(near._features(Weights)([batch]))
    assert len(out) > 1
    rows = pa.Table.from_batches(out)
    assert rows["node"].to_pylist() == list(range(400))
    assert [len(x) // 4 for x in rows["ids"].to_pylist()] == [0 if not t else 296 for t in texts]


def test_batches_are_bounded_and_the_session_is_as_before(spark, monkeypatch):
    """While classes are found rows go to Python BATCH at a time; afterwards, and after a failure, the session has its own number."""
    before, seen, weigh = spark.conf.get(NAME), [], near.weight_table
    monkeypatch.setattr(near, "weight_table", lambda *a: (seen.append(spark.conf.get(NAME)), weigh(*a))[1])
    docs = spark.createDataFrame([(i, "one two three four five six seven" if i % 2 else f"text {i}") for i in range(8)], "doc_id long, text string")
    assert sorted(r.class_size for r in near.near_classes(docs).collect()) == [1] * 4 + [4] * 4
    assert seen == [str(near.BATCH)] and spark.conf.get(NAME) == before
    monkeypatch.setattr(near, "weight_table", lambda *a: 1 / 0)
    try:
        near.near_classes(docs)
    except ZeroDivisionError:
        pass
    assert spark.conf.get(NAME) == before
