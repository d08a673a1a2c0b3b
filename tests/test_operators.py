"""Operators on small planted tables."""

from __future__ import annotations

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from shelfspark import session
from shelfspark.functions import pricing as P
from shelfspark.functions import text as T
from shelfspark.operators import address, curate, extract, graph, publish, reconcile, verify
from shelfspark.operators.verify import Tolerance
from shelfspark.sources import products, taxonomy


def graph_of(spark, parents: dict):
    nodes = spark.createDataFrame([(n,) for n in parents], "id string")
    edges = spark.createDataFrame([(n, p) for n, ps in parents.items() for p in ps] or [("", "")], "child string, parent string")
    return nodes, edges


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_diamond_has_two_addresses_primary_first(spark):
    nodes, edges = graph_of(spark, {"r": [], "a": ["r"], "b": ["r", "gone"], "c": ["b", "a"]})
    canon = graph.canonical(nodes, edges)
    found = {(x.id, x.address_rank): "/".join(x.path) for x in graph.addresses(nodes, edges, canon).collect()}
    assert found == {("r", 1): "r", ("a", 1): "r/a", ("b", 1): "r/b", ("c", 1): "r/a/c", ("c", 2): "r/b/c"}


def test_cycle_is_cut_at_its_smallest_node(spark):
    nodes, edges = graph_of(spark, {"x": ["z"], "y": ["x"], "z": ["y"], "r": []})
    canon = {x.id: (x.depth, x.parent) for x in graph.canonical(nodes, edges).collect()}
    assert canon == {"r": (0, None), "x": (0, None), "y": (1, "x"), "z": (2, "y")}


def test_too_many_addresses_are_refused(spark):
    nodes, edges = graph_of(spark, {"r": [], "a": ["r"], "b": ["r"], "c": ["a", "b"]})
    with pytest.raises(graph.AddressExplosionError, match="c has 2"):
        graph.addresses(nodes, edges, graph.canonical(nodes, edges), most=1)


def test_covered_tags_are_no_leaves(spark):
    nodes, edges = graph_of(spark, {"r": [], "a": ["r"], "b": ["a"]})
    chains = graph.ancestry(graph.canonical(nodes, edges))
    tags = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (2, "nowhere")], "product int, tag string")
    rows = address.leaves(tags, graph.intervals(chains), nodes).collect()
    assert {(x.product, x.tag, x.leaf_rank) for x in rows} == {(1, "b", 1), (2, "a", 1)}


def test_curation_renames_before_it_drops_repeats(spark):
    tags = spark.createDataFrame([(1, 0, "old"), (1, 1, "new"), (1, 2, "bad"), (1, 3, "fr:x"), (1, 4, "no"), (1, 5, "gone")], "product int, pos int, tag string")
    alias = spark.createDataFrame([("old", "new")], "tag string, to string")
    drop = spark.createDataFrame([("bad",)], "tag string")
    vocab = curate.vocabulary(spark.createDataFrame([("new",), ("fr:x",)], "id string").withColumn("id", F.when(F.col("id") == "new", "new").otherwise(F.col("id"))), "en")
    vocab = vocab.withColumn("eligible", F.col("id") == "new")
    rows = curate.curate(tags, alias, drop, vocab, exclude=["gone"]).orderBy("pos").collect()
    assert [(x.pos, x.tag, x.status, x.aliased) for x in rows] == [(0, "new", "accepted", 1), (2, "bad", "curated_drop", 1), (3, "fr:x", "out_of_language", 1), (4, "no", "not_in_taxonomy", 1)]
    assert {x.status for x in curate.curate(tags, alias, drop, None).collect()} == {"accepted", "curated_drop"}


@pytest.mark.parametrize(("scans", "points"), [(None, 0), (0, 0), (-3, 0), (1, 693), (10, 2398), (26, 3296), (1000, 6909), (22026, 10000), (10**6, 10000)])
def test_popularity(spark, scans, points):
    assert one(spark, P.popularity(F.lit(scans).cast("long"))) == points


@pytest.mark.parametrize("value", [0.0, 93.3, 1e-5, 0.00012345678, 123456.7, 1234567.0, 100.0, 0.1 + 0.2, -2.5, 5.0, 999999.5])
def test_general_number_is_as_python_has_it(spark, value):
    assert one(spark, T.general_number(F.lit(value))) == f"{value:g}"


@pytest.mark.parametrize(("text", "grams", "ml", "count"), [
    ("6 x 33 cl", None, 1980.0, 6), ("2×100g", 200.0, None, 2), ("500 g (2,5 kg)", 2500.0, None, None), ("12 fl oz 300ml", None, 12 * 29.5735295625, None), ("", None, None, None), (None, None, None, None), ("about", None, None, None),
])
def test_quantity(spark, text, grams, ml, count):
    q = one(spark, P.quantity(F.lit(text).cast("string")))
    assert (q.grams, q.ml and round(q.ml, 6), q["count"]) == (grams, ml and round(ml, 6), count)


def test_retail_rounding(spark):
    got = [one(spark, P.retail_round(F.lit(x), (0.99, 0.49, 0.29))) for x in (0.0, -1.0, 0.10, 3.50, 3.29, 4.05)]
    assert got == [0.0, 0.0, 0.99, 3.49, 3.29, 3.99]


def test_text_jobs(spark):
    assert one(spark, T.deshout(F.lit(" DARK CHOCOLATE 70% "))) == "Dark chocolate 70%"
    assert one(spark, T.deshout(F.lit("12 34"))) == "12 34"
    assert one(spark, T.gtin13(F.lit("12-3"))) == "0000000000123"
    assert one(spark, T.gtin13(F.lit("12345678901234"))) == "1234567890123"
    assert one(spark, T.describe(F.lit("Bar."), F.lit("Sweet"))) == "Bar. Sweet"
    assert one(spark, T.undefined_like(F.lit(" N/A "))) and one(spark, T.undefined_like(F.lit(None).cast("string")))
    assert one(spark, T.clean_tags(F.array(F.lit(" en:a "), F.lit(""), F.lit("b"), F.lit("b")))) == ["a", "b", "b"]
    assert one(spark, T.clean_tags(F.array(F.lit(" ")))) is None
    keys = F.array(F.lit("front_fr"), F.lit("front"))
    assert one(spark, T.front_key(keys)) == "front_fr" and one(spark, T.front_key(keys, require="en")) is None


def test_missing_runs_join_over_block_edges(spark):
    rows = spark.createDataFrame([(n,) for n in [1, 2, 6, 7, 8, 9, 10, 11, 12, 17, 30]], "n long")
    got = sorted(tuple(x) for x in reconcile.missing_runs(rows, width=4).collect())
    assert got == [(1, 2, 2), (6, 12, 7), (17, 17, 1), (30, 30, 1)]


def test_empty_tables_fail_their_checks(spark):
    none = spark.createDataFrame([], "id string, x string")
    assert reconcile.count_check(none, none).first().status == "fail"
    assert reconcile.coverage_check(none, "x").first().status == "fail"
    assert publish.merge_gate(publish.outcomes(none, none, ["x"]), Tolerance(count=9)).first().status == "fail"
    with pytest.raises(ValueError, match="empty"):
        publish.copy_generation(none, "/tmp/never", "y", "string")


def test_tolerance():
    assert Tolerance(fraction=0.5).permitted(5) == 2 and Tolerance(count=3, fraction=0.1).permitted(100) == 3 and Tolerance().permitted(9) == 0
    assert Tolerance(count=-1).problem() and Tolerance(fraction=1.5).problem()
    with pytest.raises(ValueError, match="fraction"):
        Tolerance(fraction=2).permitted(1)


def test_identity_is_unverifiable_without_records(spark):
    m = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "property string, value string")
    assert {x.property: x.status for x in reconcile.identity_check({"a": "1", "b": "9"}, m).collect()} == {"a": "pass", "b": "fail", "c": "unverifiable"}


def test_gate_says_only_that_nothing_was_verified(spark):
    docs = spark.createDataFrame([], "id string, taxonomy_tags array<string>, category_path array<string>, category_path_primary array<string>")
    labels = spark.createDataFrame([], "label string")
    checked = verify.row_violations(docs)
    rows = verify.gate(verify.metrics(checked).join(verify.segment_checks(checked, labels, labels))).collect()
    assert [(x.check, x.failed) for x in rows] == [("nothing_verified", True)]


def test_sources(spark, tmp_path):
    tax = tmp_path / "tax.json"
    tax.write_text(json.dumps({"en:a": {"name": {"en": "A"}}, "en:b": {"name": {"en": "B"}, "parents": ["en:a"]}}))
    nodes, edges = taxonomy.read_taxonomy(spark, str(tax))
    assert nodes.count() == 2 and [tuple(x) for x in edges.collect()] == [("en:b", "en:a")]
    digest = hashlib.sha256(tax.read_bytes()).hexdigest()
    assert taxonomy.snapshot_verdict(spark, str(tax), digest).first().status == "pass"
    assert taxonomy.snapshot_verdict(spark, str(tax), "0").first().status == "fail"
    (tmp_path / "list.json").write_text("[1]")
    with pytest.raises(ValueError, match="object"):
        taxonomy.read_taxonomy(spark, str(tmp_path / "list.json"))
    price = tmp_path / "price.json"
    price.write_text(json.dumps({"buckets": {"dairy": {"unit": "kg", "median_unit_price": 6}}}))
    config = taxonomy.read_pricing(spark, str(price))
    assert config.buckets["dairy"].median == 6 and config.buckets["default"].grams == 250 and config.most == 99.99
    lines = tmp_path / "in.txt"
    lines.write_text('{"code": 1}\n\n[2]\n{bad\n{"a": 1, "a": 2}\n{"a": 1} x\n')
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    kinds = [x.kind for x in products.parsed(products.read_lines(spark, str(lines))).collect()]
    assert sorted(kinds) == ["bad_json", "bad_json", "not_object", "object", "object"]
    docs = spark.createDataFrame([("1", None, []), ("2", "é", ["x"])], "id string, brand string, tags array<string>")
    products.write_documents(docs, str(tmp_path / "out"))
    text = sorted(x.value for x in spark.read.text(str(tmp_path / "out")).collect())
    assert text == ['{"id":"1","tags":[]}', '{"id":"2","brand":"é","tags":["x"]}']
    back = products.read_catalog(spark, str(tmp_path / "out"), "id string, brand string, tags array<string>")
    assert back.count() == 2


def test_a_bad_line_fails_the_catalog_scan(spark, tmp_path):
    (tmp_path / "docs.txt").write_text('{"id": "1"}\n{"id": \n')
    with pytest.raises(Exception, match="FAILFAST|MALFORMED"):
        products.read_catalog(spark, str(tmp_path), "id string").collect()


def test_missing_addresses_are_refused(spark):
    leaf = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (2, "c", 2)], "product int, tag string, leaf_rank int")
    address.require_addresses(leaf, spark.createDataFrame([("a",), ("b",)], "id string"))
    with pytest.raises(address.NodeSetMismatchError, match="leaf b"):
        address.require_addresses(leaf, spark.createDataFrame([("a",), ("c",)], "id string"))


def test_fingerprints_count_repeated_rows(spark):
    rows = [publish.fingerprint("t", spark.createDataFrame([(x, None) for x in xs], "a int, b string")).first().fingerprint for xs in ([1, 2], [2, 1], [1, 2, 2, 2], [1])]
    assert rows[0] == rows[1] and len(set(rows)) == 3
    assert publish.fingerprint("t", spark.createDataFrame([], "a int")).first().fingerprint == "0"


def test_several_primary_addresses_of_a_segment_are_found(spark):
    docs = spark.createDataFrame([("1", [], ["a", "a/x"], ["a", "a/x"]), ("2", [], ["b", "b/x"], ["b", "b/x"])], "id string, taxonomy_tags array<string>, category_path array<string>, category_path_primary array<string>")
    labels = spark.createDataFrame([("a",), ("b",), ("x",)], "label string")
    got = verify.segment_checks(verify.row_violations(docs), labels, labels).first()
    assert got.several_primary_addresses == 1 and got.values_outside == 0


@pytest.mark.parametrize(("bucket", "labels", "margin"), [("snacks_sweets", [], 38), ("", [], 25), ("dairy", ["en:organic"], 25), ("bakery", ["en:organic", "en:fair-trade"], 59), ("default", ["en:vegan"], 25)])
def test_margins(spark, bucket, labels, margin):
    assert one(spark, P.margin(F.lit(bucket), F.array(*map(F.lit, labels)).cast("array<string>"))["margin"]) == margin


TAXONOMY = {"en:beverages": [], "en:hot-beverages": ["en:beverages"], "en:teas": ["en:hot-beverages"]}


def record(code, tags, **more):
    return json.dumps({"code": code, "product_name_en": "Green tea", "generic_name_en": "A tea.", "images": {"front_en": {"rev": "3", "imgid": "1", "sizes": {"400": {"w": 400}}}}, "categories_tags": tags, "unique_scans_n": 10} | more)


@pytest.mark.parametrize("kept", [False, True])
def test_extraction_drops_and_counts_what_does_not_resolve(spark, tmp_path, kept):
    from shelfspark.operators import extract

    nodes, edges = graph_of(spark, TAXONOMY)
    settings = extract.Settings(require_category=not kept, require_path=not kept)
    labels = nodes.select("id", graph.display_label(F.col("id"), []).alias("label"))
    none = spark.createDataFrame([], "tag string, to string")
    lines = [record("5449000000995", list(TAXONOMY)), record("5449000000996", ["en:not-in-taxonomy"]), record(5, ["en:teas"], brands=7, nova_group="x", quantity=" "), record("6", list(TAXONOMY), product_name_en=" "), "{", "[]", " "]
    rows = spark.createDataFrame([(x,) for x in lines], "value string")
    run = extract.Extraction(rows, extract.Taxonomy.of(nodes, edges, labels, settings), none, none, settings)
    docs = {d.id: d for d in run.documents.collect()}
    figures = {(r.block, r.metric): r.value for r in run.report.collect()}
    tea = docs["5449000000995"]
    assert tea.category_path == ["Beverages", "Beverages/Hot beverages", "Beverages/Hot beverages/Teas"] == tea.category_path_primary and tea.taxonomy_tags == ["Beverages", "Hot beverages", "Teas"]
    assert tea.popularity == 2398 and tea.description == "Green tea. A tea." and tea.image_url.endswith("544/900/000/0995/front_en.3.400.jpg") and tea.attrs["Category"] == "Beverages"
    five = docs["0000000000005"]
    assert five.brand == "" and five.nova_group is None and five.attrs["Quantity"] is None and five.taxonomy_tags == ["Teas"]
    assert ("5449000000996" in docs) == kept and figures["counters", "written"] == ("3" if kept else "2") and figures["counters", "missing_category"] == ("0" if kept else "1")
    assert figures["counters", "read"] == "5" and figures["counters", "bad_json"] == "1" and figures["counters", "missing_title"] == "1" and figures["counters", "with_category_path"] == "2"
    assert figures["curation", "rejected_instances"] == "1" and figures["top not_in_taxonomy", "en:not-in-taxonomy"] == "1"
    extract.write_report(run.report, str(tmp_path / "report"))
    blocks = json.loads(spark.read.text(str(tmp_path / "report")).first().value)
    assert json.loads(blocks["counters"])["read"] == "5"


def test_extraction_without_taxonomy(spark):
    from shelfspark.operators import extract

    none = spark.createDataFrame([], "tag string, to string")
    run = extract.Extraction(spark.createDataFrame([(record("1", ["en:teas", "en:teas"]),), (record("2", []),)], "value string"), None, none, none)
    docs = run.documents.collect()
    assert [(d.taxonomy_tags, d.category_path) for d in docs] == [(["Teas"], [])]
    assert {(r.metric, r.value) for r in run.report.filter("block = 'counters' AND value <> '0'").collect()} == {("read", "2"), ("written", "1"), ("missing_category", "1")}


def test_a_million_blanks_are_stripped_in_linear_time(spark):
    import time

    began = time.time()
    assert one(spark, F.length(T.strip(F.concat(F.lit("\u00a0 a"), F.repeat(F.lit(" "), 1_000_000), F.lit("b\n"))))) == 1_000_002
    assert time.time() - began < 20


def plain_depths(parents: dict) -> dict:
    """Breadth first from the roots, then from the smallest node left, again and again."""
    edges = {(c, p) for c, ps in parents.items() for p in ps if p in parents}
    seen: dict = {}
    starts = [n for n in parents if not any(c == n for c, _ in edges)]
    while True:
        level, depth = starts, 0
        while level:
            seen |= {n: depth for n in level}
            level, depth = sorted({c for c, p in edges if p in level and c not in seen}), depth + 1
        rest = sorted(set(parents) - set(seen))
        if not rest:
            return seen
        starts = rest[:1]


def test_depths_on_graphs_with_and_without_cycles(spark):
    rng = random.Random(11)
    for n, fan, back in ((30, 2, 0.0), (40, 2, 0.5), (40, 1, 1.0)):
        names = [f"n{i:02}" for i in range(n)]
        rng.shuffle(names)
        parents = {}
        for i, x in enumerate(names):
            pool = names if rng.random() < back else names[:i]
            parents[x] = rng.sample(pool, min(len(pool), rng.randrange(fan + 1) if back < 1 else 1))
        nodes, edges = graph_of(spark, parents)
        assert {r.id: r.depth for r in graph.depths(nodes, edges).collect()} == plain_depths(parents)


def test_a_thousand_cycles_take_the_rounds_of_one(spark, monkeypatch):
    parents = {f"c{i:03}-{j}": [f"c{i:03}-{(j + 2) % 3}"] for i in range(1000) for j in range(3)}
    nodes, edges = graph_of(spark, parents)
    cuts = []
    monkeypatch.setattr(graph, "cut", lambda df, name="stage": cuts.append(name) or session.cut(df, name))
    depth = {r.id: r.depth for r in graph.depths(nodes, edges).collect()}
    assert depth == {f"c{i:03}-{j}": j for i in range(1000) for j in range(3)}
    assert len(cuts) < 15


def test_counts_are_those_of_the_list(spark):
    rng = random.Random(12)
    names = [f"n{i:02}" for i in range(25)]
    parents = {x: rng.sample(names[:i], min(i, rng.randrange(4))) for i, x in enumerate(names)}
    nodes, edges = graph_of(spark, parents)
    canon = graph.canonical(nodes, edges)
    listed = graph.addresses(nodes, edges, canon)
    want = {r.id: (r.n, r.l) for r in listed.groupBy("id").agg(F.count("*").alias("n"), (F.max(F.size("path")) - 1).alias("l")).collect()}
    assert {r.id: (r.addresses, r.longest) for r in graph.address_counts(nodes, edges, canon).collect()} == want


def test_an_exploding_graph_is_refused_before_a_path_is_written(spark, monkeypatch):
    """Eleven diamonds in a row: 2048 paths to the last node."""
    parents = {"d00": []}
    for i in range(1, 12):
        parents |= {f"a{i:02}": [f"d{i - 1:02}"], f"b{i:02}": [f"d{i - 1:02}"], f"d{i:02}": [f"a{i:02}", f"b{i:02}"]}
    nodes, edges = graph_of(spark, parents)
    canon = graph.canonical(nodes, edges)
    cuts = []
    monkeypatch.setattr(graph, "cut", lambda df, name="stage": cuts.append(name) or session.cut(df, name))
    with pytest.raises(graph.AddressExplosionError):
        graph.addresses(nodes, edges, canon)
    assert "address" not in cuts


def test_counting_refuses_cycles_and_listing_takes_simple_paths(spark):
    nodes, edges = graph_of(spark, {"r": [], "a": ["r", "c"], "b": ["a"], "c": ["b"]})
    canon = graph.canonical(nodes, edges)
    with pytest.raises(graph.CyclicGraphError):
        graph.address_counts(nodes, edges, canon, most=None)
    assert {r.id: "/".join(r.path) for r in graph.addresses(nodes, edges, canon).collect()} == {"r": "r", "a": "r/a", "b": "r/a/b", "c": "r/a/b/c"}


def test_ranks_that_do_not_fit_are_refused(spark):
    nodes, edges = graph_of(spark, {"r": []})
    with pytest.raises(ValueError, match="16 bits"):
        graph.addresses(nodes, edges, graph.canonical(nodes, edges), most=1 << 16)


def test_leaves_by_intervals_are_those_by_paths(spark):
    rng = random.Random(13)
    names = [f"n{i:02}" for i in range(40)]
    parents = {x: rng.sample(names[:i], 1) if i > 3 and rng.random() < 0.9 else [] for i, x in enumerate(names)}
    nodes, edges = graph_of(spark, parents)
    chains = session.cut(graph.ancestry(graph.canonical(nodes, edges)))
    path = {r.id: list(r.path) for r in chains.collect()}
    picks = [(p, t) for p in range(60) for t in rng.choices([*names, "nowhere"], k=rng.randrange(1, 9))]
    want = set()
    for p in range(60):
        own = {t for q, t in picks if q == p and t in path}
        free = sorted((t for t in own if not any(t in path[o][:-1] for o in own)), key=lambda t: (-len(path[t]), t))
        want |= {(p, t, k) for k, t in enumerate(free, 1)}
    found = address.leaves(spark.createDataFrame(picks, "product int, tag string"), graph.intervals(chains), nodes)
    assert {tuple(r) for r in found.collect()} == want
    assert "path" not in found.columns and all("path" not in c for c in graph.intervals(chains).columns)


def test_file_order_over_several_files_and_parts(spark, tmp_path):
    """Rows number up by path and place, whichever task reads what; the nth is found by counts of parts."""
    names = ["b", "a", "c"]
    for k, name in enumerate(names):
        (tmp_path / f"{name}.txt").write_text("".join(f"{name}{i:04}\n" for i in range(50 * (k + 1))))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        rows = session.cut(products.in_file_order(products.read_lines(spark, str(tmp_path))), "rows")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    got = [r.value for r in rows.orderBy("row").collect()]
    assert got == sorted(got) and len(got) == 300
    assert rows.select("row").distinct().count() == 300
    for n in (1, 2, 77, 100, 101, 299, 300):
        last = products.nth_row(rows, n)
        assert rows.filter(F.col("row") <= last).count() == n
    assert products.nth_row(rows, 301) is None


@pytest.mark.parametrize("bounds", [{}, {"read": 3}, {"written": 2}, {"read": 99, "written": 99}])
def test_runs_stop_where_a_bound_is_reached(spark, tmp_path, bounds):
    def line(i, name):
        record = {"code": str(i), "lang": "en", "product_name": name, "generic_name": "Text of it.", "categories_tags": ["en:a"], "images": {"front_en": {"rev": "3", "imgid": "1", "sizes": {"400": {}}}}}
        return json.dumps(record)

    (tmp_path / "dump").mkdir()
    (tmp_path / "dump" / "1.jsonl").write_text("\n".join([line(1, "One"), "[1]", line(2, ""), line(3, "Three")]) + "\n")
    (tmp_path / "dump" / "2.jsonl").write_text("\n".join(["{bad", line(4, "Four"), line(5, "Five")]) + "\n")
    none = spark.createDataFrame([], "tag string, to string")
    x = extract.Extraction(products.read_lines(spark, str(tmp_path / "dump")), None, none, none.select("tag"), **bounds)
    counters = {r.metric: int(r.value) for r in x.report.filter("block = 'counters'").collect()}
    want = {(): (6, 4, 1), (3,): (3, 2, 0), (2,): (3, 2, 0), (99, 99): (6, 4, 1)}[tuple(bounds.values())]
    assert (counters["read"], counters["written"], counters["bad_json"]) == want
    assert counters["missing_title"] == 1
    assert x.documents.count() == counters["written"]


def test_a_run_over_nothing(spark):
    none = spark.createDataFrame([], "tag string, to string")
    x = extract.Extraction(spark.createDataFrame([], "value string"), None, none, none.select("tag"))
    counters = {r.metric: int(r.value) for r in x.report.filter("block = 'counters'").collect()}
    assert counters["read"] == counters["written"] == 0 and x.documents.count() == 0


def test_scopes_of_threads_do_not_meet(spark):
    import threading

    kept = []

    def other():
        with session.scope(spark):
            kept.append(session.cut(spark.range(3), "other"))
            kept.append(kept[0].count())

    with session.scope(spark):
        mine = session.cut(spark.range(5), "mine")
        t = threading.Thread(target=other)
        t.start()
        t.join()
        assert mine.count() == 5
    assert kept[1] == 3


def test_documents_need_no_exchange_on_the_product(spark):
    """What a run wrote lies in buckets of the product; records went there once."""
    nodes, edges = graph_of(spark, TAXONOMY)
    labels = nodes.select("id", graph.display_label(F.col("id"), []).alias("label"))
    none = spark.createDataFrame([], "tag string, to string")
    rows = spark.createDataFrame([(record(str(i), list(TAXONOMY)),) for i in range(1, 30)], "value string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        run = extract.Extraction(rows, extract.Taxonomy.of(nodes, edges, labels, extract.Settings()), none, none)
        docs = run.documents
        assert docs.count() == 29
        plan = docs._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange hashpartitioning(product" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
