"""What catalogs of many products need: tables by product in parts of bounded size, strings sent once."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspark import session
from shelfspark.operators import address, curate, graph


def unwritten(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_parts_grow_with_the_rows(spark):
    some = session.parts_for(spark, 0)
    assert session.parts_for(spark, session.ROWS_A_TASK * some) == some
    assert session.parts_for(spark, 1000 * session.ROWS_A_TASK + 1) == 1001


def test_tags_go_to_their_product_once(spark):
    """Curation, leaves, entries and the cap of tags without any broadcast: one exchange on the product."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tags = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (2, 0, "b")], "product int, pos int, tag string")
        facts = spark.createDataFrame([("a", True, 1, 2, 1, "A"), ("b", True, 2, 2, 2, "B")], "id string, eligible boolean, enter long, leave long, length int, label string")
        none = spark.createDataFrame([], "tag string, to string")
        marked = curate.curate(tags, none, none, facts, partitions=7)
        assert unwritten(address.placed_leaves(marked)).count("hashpartitioning(product") == 1
        kept = session.cut(marked, by="product", buckets=7).filter("status = 'accepted'")
        leaves = session.cut(address.placed_leaves(kept), by="product", buckets=7)
        capped = curate.capped_by_place(curate.label_entries(kept), curate.reserved_places(kept, leaves), 1)
        assert "hashpartitioning(product" not in unwritten(capped)
        assert {(r.product, r.tag, r.leaf_rank) for r in leaves.collect()} == {(1, "b", 1), (2, "b", 1)}
        assert {(r.product, r.tag, r.reserved, r.kept, r.chain_over_cap) for r in capped.collect()} == {(1, "a", True, True, 1), (1, "b", True, True, 1), (2, "b", True, True, 0)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_unions_of_labels_and_nodes_with_separators(spark):
    found = spark.createDataFrame([("r", 1, ["r"]), ("x/~y", 1, ["r", "x/~y"]), ("x/~y", 2, ["q", "r", "x/~y"])], "id string, address_rank int, path array<string>")
    labels = spark.createDataFrame([("r", "R/1"), ("q", "~0"), ("x/~y", "")], "id string, label string")
    forms = graph.forms(found, labels)
    leaf = spark.createDataFrame([(5, "x/~y", 1), (5, "r", 2)], "product int, tag string, leaf_rank int")
    gathered = address.gathered(leaf, forms)
    rows = [(r.ord, r.node, r.path, r.is_primary) for r in address.address_union(gathered).orderBy("ord").collect()]
    assert rows == [(1, "r", "R/1", True), (2, "x/~y", "R/1/", True), (3, "q", "~0", False), (4, "r", "~0/R/1", False), (5, "x/~y", "~0/R/1/", False)]
    arrays = address.path_arrays(gathered).first()
    assert arrays.category_path == [r[2] for r in rows] and arrays.category_path_primary == ["R/1", "R/1/"]
    known = {(r.node, r.path): r.is_primary for r in address.known(leaf, forms).collect()}
    assert known == {(n, p): m for _, n, p, m in rows}
    every = address.known(leaf.withColumn("whole", F.lit(True)), forms)
    assert every.filter("is_primary").count() == 5


def test_an_object_over_several_files(spark, tmp_path):
    """Files end after a line feed, after a brace, inside an entry and inside a string."""
    from shelfspark.sources import objects

    for i, text in enumerate(['{"a": {"x": 1}\n', ',"b": {"x": "}"}', ',"c": {"x": [{}, 2], "y": "o{', 'h"}\n', " \n", '}\n']):
        (tmp_path / f"part-{i}.txt").write_text(text)
    found = {r.key: r.v for r in objects.entries(spark, str(tmp_path)).select("key", F.to_json("value").alias("v")).collect()}
    assert found == {"a": '{"x":1}', "b": '{"x":"}"}', "c": '{"x":[{},2],"y":"o{h"}'}
