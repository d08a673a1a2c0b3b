"""What a record and a document cost: fields in one walk, lists of paths made once a node, tags gathered from lines."""

from __future__ import annotations

import json
import re

from pyspark.sql import functions as F

from shelfspark.operators import address, documents, extract, graph
from shelfspark.plans import adapters
from shelfspark.sources import products


def test_a_record_is_walked_once(spark):
    """One path into the record, whatever the number of fields; odd kinds stay absent."""
    base = {"code": "1", "lang": "en", "product_name": "A", "generic_name": "B", "images": {"front_en": {"rev": 1, "imgid": "2", "sizes": {"100": 1}}}}
    odd = [{"code": 5, "categories_tags": ["a", None, 3, {"b": 1}, "d"]}, {"categories_tags": ["a", None], "nutriments": {"fat_100g": 1.5, "fat_unit": "g", "salt_100g": "2"}}, {"product_name": 7, "nova_group": "4", "nutriments": [1]}, {"images": "x", "labels_tags": {"a": 1}}]
    made = [json.dumps(base | x) for x in odd] + ['{"code": "1"}, null', "[]", '{"code": "1"} x', "\t", '\t{"code": "3"}', "]", "null"]
    lines = spark.createDataFrame(list(enumerate(made)), "row long, value string")
    rows = extract.fields(products.listed(lines), "en")
    plan = rows._jdf.queryExecution().analyzed().toString()
    assert set(re.findall(r"variant_get\(listed#\d+, ([^,]+),", plan)) == {"$[0]", "$[1]"}
    got = {r.row: r for r in rows.collect()}
    assert {k: r.kind for k, r in got.items()} == {0: "object", 1: "object", 2: "object", 3: "object", 4: "bad_json", 5: "not_object", 6: "bad_json", 8: "object", 9: "bad_json", 10: "not_object"}
    assert got[0].code == "5" and got[0].tags == ["a", "d"] and got[0].image_url.endswith("front_en.1.100.jpg")
    assert got[1].tags == ["a"] and got[1].nutrients["Fat (g/100g)"] == "1.5 g" and got[1].nutrients["Salt (g/100g)"] is None
    assert got[2].title is None and got[2].nova is None and got[3].image_url is None and got[3].labels is None and got[3].tags == []
    assert got[4].code is None and got[8].code == "3"


def test_products_carry_lists_of_paths_made_once_a_node(spark):
    """What products gather holds whole paths, each once, whatever characters labels hold; the first address is in front."""
    found = spark.createDataFrame([("r", 1, ["r"]), ("x", 1, ["r", "x"]), ("x", 2, ["q", "r", "x"])], "id string, address_rank int, path array<string>")
    labels = spark.createDataFrame([("r", "R\n~1/"), ("q", ""), ("x", "~0")], "id string, label string")
    forms = graph.forms(found, labels)
    leaf = spark.createDataFrame([(5, "x", 1), (5, "r", 2)], "product int, tag string, leaf_rank int")
    told = address.told(address.gathered(leaf, forms.select("id", "told", "lead")))
    assert dict(told.dtypes) == {"product": "int", "told": "string", "lead": "int"}
    row = address.listed_paths(told).first()
    assert row.category_path == ["R\n~1/", "R\n~1//~0", "", "/R\n~1/", "/R\n~1//~0"] and row.category_path_primary == row.category_path[:2]


def test_names_of_attributes_are_put_in_order_once(spark):
    attrs = documents.attributes({"Serving size": F.lit("x"), "Energy (kcal/100g)": F.lit("1"), "Allergens": F.array(F.lit("a"))})
    keys = spark.range(1).select(documents.attribute_keys(attrs).alias("k"))
    assert keys.first().k == sorted(["Serving size", "Energy (kcal/100g)", "Allergens", *documents.STAMPS])
    assert "lambda" not in keys._jdf.queryExecution().analyzed().toString()


def test_lists_of_tags_are_those_of_the_tags(spark, tmp_path):
    """Lists of an order's tags, gathered from its lines: repeats, parts that are there twice, orders with no line and
    with more than a thousand. No window sorts tags, and one exchange takes lines to their order."""
    lines = [(1, 2, 7, 3), (1, 1, 10, 3), (1, 2, 7, 3), (2, 1, 97, 1), (2, 1, 7, 2), (9, 1, 7, 1), *[(4, i, 7 + 3 * (i % 2), i) for i in range(1, 1102)]]
    tables = {
        "lineitem": (lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long"), "part": ([(7,), (10,), (97,), (97,)], "p_partkey long"),
        "orders": ([(1, 151), (2, 7), (3, 3), (3, 2), (4, 50)], "o_orderkey long, o_custkey long"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    want = {}
    for r in adapters.table(spark, str(tmp_path), "tags").orderBy("product", "pos", "tag").collect():
        want.setdefault(r.product, []).append(r.tag)
    got = adapters.tag_lists(spark, str(tmp_path))
    assert {r.o_orderkey: r.tags for r in got.collect()} == {k: v for k, v in want.items() if k != 9}
    assert want[3] == ["en:x2", "en:x3"] and want[2] == ["en:p7", "xx:p97", "xx:p97", "en:s2", "en:s1", "en:s1", "en:x7"] and len(want[4]) == 2203
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("hashpartitioning(l_orderkey") == 1
    assert "Window" not in plan
