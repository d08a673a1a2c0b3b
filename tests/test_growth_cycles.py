"""Walks of graphs with cycles send messages, and leave nodes and edges where they lie."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from shelfspark.operators import graph


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def walked(ids, edges):
    """Fewest hops from the roots; then from the smallest unreached id, again and again."""
    edges = {(c, p) for c, p in edges if c in ids and p in ids}
    depth, starts = {}, sorted(ids - {c for c, _ in edges})
    while True:
        level = {i: 0 for i in starts}
        while level:
            depth |= level
            level = {c: depth[p] + 1 for c, p in edges if p in level and c not in depth}
        starts = sorted(ids - depth.keys())[:1]
        if not starts:
            return depth


def test_cycles_send_messages_alone(spark):
    rng = random.Random(5)
    for roots in (0, 3):
        ids = {f"n{i}" for i in range(60)}
        edges = [(f"n{rng.randrange(roots, 60)}", f"n{rng.randrange(62)}") for _ in range(70)] + [(f"n{i}", f"n{roots + (i - roots + 1) % (60 - roots)}") for i in range(roots, 60) if i % 7 or not roots]
        want = walked(ids, set(edges))
        canon = graph.canonical(spark.createDataFrame([(i,) for i in ids], "id string"), spark.createDataFrame(edges, "child string, parent string"))
        known = {(c, p) for c, p in edges if p in ids}
        best = {c: min((want[p], p) for x, p in known if x == c) for c, _ in known}
        got = {r.id: (r.depth, r.parent) for r in canon.collect()}
        assert got == {i: (d, best[i][1] if i in best and best[i][0] < d else None) for i, d in want.items()}
    ring = spark.createDataFrame([(f"r{i}", f"r{(i + 1) % 5}") for i in range(5)], "child string, parent string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # Nodes and edges lie where they are sent from: one exchange, of the edges to their child.
        assert plan_of(graph.canonical(ring.select(F.col("child").alias("id")), ring)).count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rounds_of_a_thousand_cycles(spark, monkeypatch):
    """All tables that a walk writes, laid out in buckets or not, are counted."""
    written, cut, laid = [], graph.cut, graph.laid
    monkeypatch.setattr(graph, "cut", lambda df, name="stage": written.append(name) or cut(df, name))
    monkeypatch.setattr(graph, "laid", lambda df, name, *a, **k: written.append(name) or laid(df, name, *a, **k))
    edges = spark.createDataFrame([(f"c{i:03}-{j}", f"c{i:03}-{(j + 2) % 3}") for i in range(1000) for j in range(3)], "child string, parent string")
    assert {r.id: r.depth for r in graph.depths(edges.select(F.col("child").alias("id")), edges).collect()} == {f"c{i:03}-{j}": j for i in range(1000) for j in range(3)}
    assert len(written) < 10
