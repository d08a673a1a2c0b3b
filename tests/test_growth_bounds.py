"""Bounded runs over lines that are parsed once."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from shelfspark.operators import extract


def test_bounded_runs_parse_once(spark, monkeypatch):
    """Runs share one staging; one that stops at a document curates no more than a few times the records before it, and
    counters need no unions."""
    sizes, curated = [], extract.Extraction._curated
    monkeypatch.setattr(extract.Extraction, "_curated", lambda self, rows, tags: sizes.append(rows.count()) or curated(self, rows, tags))
    images = {"front_en": {"rev": "1", "imgid": "1", "sizes": {"100": 1}}}
    made = [json.dumps({"code": str(i), "lang": "en", "product_name": f"Tea {i}", "generic_name": "Leaves.", "images": images, "categories_tags": ["en:teas"]} if i % 4 else {"code": str(i)}) for i in range(1, 401)]
    lines = spark.createDataFrame([(x,) for x in made], "value string").coalesce(3)
    nodes, edges = spark.createDataFrame([("en:teas",), ("en:food",)], "id string"), spark.createDataFrame([("en:teas", "en:food")], "child string, parent string")
    taxonomy = extract.Taxonomy.of(nodes, edges, nodes.select("id", F.upper("id").alias("label")), extract.Settings())
    none = spark.createDataFrame([], "tag string, to string")
    staged = extract.Staged(lines)
    want = {(None, 3): (3, 3, 0), (10, None): (10, 8, 2), (10, 3): (3, 3, 0), (9, 400): (9, 7, 2), (None, 40): (53, 40, 13), (None, 301): (400, 300, 100), (None, None): (400, 300, 100), (401, 300): (399, 300, 99)}
    for (read, written), (n, docs, untitled) in want.items():
        run = extract.Extraction(staged, taxonomy, none, none, extract.Settings(), read, written)
        figures = {r.metric: int(r.value) for r in run.counted().collect()}
        assert "found" not in run.__dict__
        assert (figures["read"], figures["written"], figures["missing_title"], figures["with_category_path"]) == (n, docs, untitled, docs), (read, written)
        assert run.documents.count() == docs and {r.metric: int(r.value) for r in run.report.filter("block = 'counters'").collect()} == figures
    assert sizes[0] == 24 and sizes[2] == 10 and sizes[4] == 320
