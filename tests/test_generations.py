"""Written generations: what a merge touches, what a failed one leaves, and what a comparison reads."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from shelfspark.operators import generations, reconcile
from shelfspark.operators.generations import ConcurrentMergeError, Generations, MergeRefusedError


@pytest.fixture
def rows(spark):
    return spark.range(1000).select("id", F.concat(F.lit("v"), F.col("id") % 7).alias("v"), F.array(F.col("id")).alias("w"))


def files(table):
    return {r.bucket: r.version for r in table.versions().collect()}


def test_a_merge_writes_touched_buckets_only(spark, tmp_path, rows):
    table = Generations(spark, f"file://{tmp_path}/t", buckets=32)
    table.create(rows)
    before = files(table)
    updates = spark.createDataFrame([(3, "new"), (500, "new"), (7, "v0")], "id long, v string")  # the last changes nothing
    gate = table.merge(updates, ["v"]).first()
    assert (gate.updated, gate.noop, gate.status) == (2, 1, "pass")
    after = files(table)
    touched = {r.b for r in updates.filter("id <> 7").select(generations.bucket_of(F.col("id"), 32).alias("b")).collect()}
    assert {b for b in after if after[b] != before[b]} == touched and set(after) == set(before)
    assert {r.id: r.v for r in table.read().collect()} == {i: "new" if i in (3, 500) else f"v{i % 7}" for i in range(1000)}
    assert table.read(0).filter("v = 'new'").isEmpty() and table.read().schema["w"].dataType.typeName() == "array"


def test_a_refused_or_broken_merge_leaves_the_generation(spark, tmp_path, rows, monkeypatch):
    table = Generations(spark, f"file://{tmp_path}/t", buckets=8)
    table.create(rows)
    with pytest.raises(MergeRefusedError):
        table.merge(spark.createDataFrame([(-1, "x")], "id long, v string"), ["v"])
    update = spark.createDataFrame([(1, "x")], "id long, v string")
    monkeypatch.setattr(Generations, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError, match="lost"):
        table.merge(update, ["v"])
    monkeypatch.undo()
    assert table.current() == 0 and table.read().filter("v = 'x'").isEmpty()
    commit = Generations._commit

    def late(self, before, versions):
        if before == 0:
            monkeypatch.undo()
            Generations(spark, self.base, 8).merge(spark.createDataFrame([(2, "first")], "id long, v string"), ["v"])
        commit(self, before, versions)

    monkeypatch.setattr(Generations, "_commit", late)
    with pytest.raises(ConcurrentMergeError):
        table.merge(update, ["v"])
    assert table.current() == 1 and {r.v for r in table.read().filter("id in (1, 2)").collect()} == {"v1", "first"}
    table.merge(spark.createDataFrame([(4, "v4")], "id long, v string"), ["v"])  # a merge that changes nothing
    assert table.current() == 1


def test_creating_twice_or_from_nothing_is_refused(spark, tmp_path, rows):
    table = Generations(spark, f"file://{tmp_path}/t", buckets=8)
    with pytest.raises(ValueError, match="empty"):
        table.create(rows.limit(0))
    with pytest.raises(ValueError, match="no generation"):
        table.read()
    table.create(rows)
    with pytest.raises(ValueError, match="already"):
        table.create(rows)


def test_a_comparison_reads_the_buckets_that_differ(spark, tmp_path, rows):
    a, b = (Generations(spark, f"file://{tmp_path}/{n}", buckets=256) for n in "ab")
    a.create(rows.filter("id not in (10, 20, 30)"))
    b.create(rows.filter("id <> 40").withColumn("v", F.when(F.col("id").isin(50, 60), "other").otherwise(F.col("v"))))
    assert len(a.differing(b)) <= 6
    found = {(r.id, r.side) for r in a.diff(b).collect()}
    assert found == {(10, "missing"), (20, "missing"), (30, "missing"), (40, "unexpected"), (50, "changed"), (60, "changed")}
    opened = {os.path.basename(os.path.dirname(f)) for f in a.read(buckets=a.differing(b)).inputFiles()}
    assert opened <= {f"bucket={k}" for k in a.differing(b)}
    ids = lambda df: {(r.id, r.side) for r in df.collect()}
    assert ids(generations.local_diff(a.read().select("id"), b.read().select("id"))) == ids(reconcile.id_diff(a.read(), b.read()))
    assert a.diff(a).isEmpty()


def test_repeated_and_null_ids(spark):
    p = spark.createDataFrame([(1, "a"), (1, "a"), (None, "n"), (2, "b"), (3, "c")], "id long, v string")
    b = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (3, "c")], "id long, v string")
    assert {(r.id, r.side) for r in generations.local_diff(p, b, 4).collect()} == {(1, "changed"), (2, "changed"), (None, "unexpected")}
    assert {(r.id, r.side) for r in generations.local_diff(p, p.withColumn("v", F.lit("x")).filter("id IS NULL"), 4).collect()} == {(1, "unexpected"), (2, "unexpected"), (3, "unexpected"), (None, "changed")}
