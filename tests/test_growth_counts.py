"""What runs that are only counted leave undone."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from shelfspark.operators import extract


def test_a_counted_run_makes_no_strings(spark):
    """Bounded runs count products with a path; the strings of addresses are not made for it."""
    nodes, edges = spark.createDataFrame([("en:teas",), ("en:food",), ("en:odd",)], "id string"), spark.createDataFrame([("en:teas", "en:food")], "child string, parent string")
    labels = nodes.select("id", F.upper("id").alias("label"))
    none = spark.createDataFrame([], "tag string, to string")
    record = {"lang": "en", "product_name": "Tea", "generic_name": "Leaves.", "images": {"front_en": {"rev": "1"}}}
    lines = spark.createDataFrame([(json.dumps(record | {"code": str(i), "categories_tags": [t]}),) for i, t in enumerate(["en:teas", "en:odd", "en:food"], 1)], "value string")
    for kept, want in ((labels, 3), (labels.filter("id = 'en:food'"), 2)):
        taxonomy = extract.Taxonomy.of(nodes, edges, kept, extract.Settings())
        figures = {r.metric: r.value for r in extract.Extraction(lines, taxonomy, none, none).counted().collect()}
        assert "forms" not in taxonomy.__dict__ and figures["written"] == "3" and figures["with_category_path"] == str(want)
        assert {r.id for r in taxonomy.named.collect()} == {r.id for r in taxonomy.forms.collect()}
