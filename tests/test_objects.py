"""Large JSON objects read in parts, against the whole text parsed at once."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from shelfspark.sources import objects, taxonomy


@pytest.fixture
def small_parts(spark):
    """Files are cut into parts of 200 bytes, entries or not."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield spark
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def value(rng, depth=0):
    kind = rng.randrange(8 if depth < 3 else 5)
    text = "".join(rng.choice('ab{}[]",:\\é\n ') for _ in range(rng.randrange(8)))
    if kind < 2:
        return text
    if kind < 5:
        return rng.choice((None, True, 1, -2.5, ""))
    if kind == 5:
        return [value(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {text + str(i): value(rng, depth + 1) for i in range(rng.randrange(4))}


def read(spark, path, key=None):
    return {r.key: json.loads(r.v) for r in objects.entries(spark, str(path), key).select("key", F.to_json("value").alias("v")).collect()}


@pytest.mark.parametrize("indent", [None, 2])
def test_random_objects_in_parts(small_parts, tmp_path, indent):
    rng = random.Random(3)
    whole = {f"k{i}{rng.choice(['', chr(34), '{', '}'])}": value(rng) for i in range(60)}
    whole["inner"] = {f"e{i}": value(rng) for i in range(20)}
    whole["last"] = 5
    text = json.dumps(whole, indent=indent, ensure_ascii=False) + "\n \n"
    (tmp_path / "a.json").write_text(text)
    assert read(small_parts, tmp_path / "a.json") == whole
    cut = len(text) // 2
    (tmp_path / "d").mkdir()
    at = text.index("}", cut) + 1
    (tmp_path / "d" / "1.json").write_text(text[:at])
    (tmp_path / "d" / "2.json").write_text(text[at:])
    assert read(small_parts, tmp_path / "d") == whole


def test_the_object_under_a_key(small_parts, tmp_path):
    whole = {"currency": "USD", "endings": [0.49, 0.99], "note": 'a "buckets": {', "other": {"x": {"y": 1}}, "buckets": {"a": {"unit": "l"}, "b": {}, "c": {"sigma": {"d": [1, {"e": 2}]}}}, "after": {"z": {"q": 1}}, "n": 1}
    (tmp_path / "p.json").write_text(json.dumps(whole, indent=1))
    assert read(small_parts, tmp_path / "p.json", "buckets") == whole["buckets"]
    (tmp_path / "q.json").write_text(json.dumps({"buckets": {"a": 1, "b": {"c": 2}}}))
    assert read(small_parts, tmp_path / "q.json", "buckets") == {"a": 1, "b": {"c": 2}}


@pytest.mark.parametrize("text", ["[1, 2]", "", "  \n", '{"a": {"b": 1}', '{"a": 1} {"b": 2}', '"text"', '{"a": "open}'])
def test_what_is_no_object_is_refused(spark, tmp_path, text):
    (tmp_path / "x.json").write_text(text)
    with pytest.raises(ValueError):
        read(spark, tmp_path / "x.json")


def test_small_objects(spark, tmp_path):
    for text, want in (("{}", {}), ("{ }\n", {}), ('{"a":1}', {"a": 1}), ('\n {"a":{}}\n', {"a": {}})):
        (tmp_path / "x.json").write_text(text)
        assert read(spark, tmp_path / "x.json") == want


def test_written_objects_are_json(spark, tmp_path):
    rows = spark.createDataFrame([(f'k"{i}', json.dumps({"i": i, "t": "}"})) for i in range(40)], "key string, value string").repartition(5)
    objects.write_object(rows, str(tmp_path / "o"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "o").glob("part-*")))
    assert json.loads(text) == {f'k"{i}': {"i": i, "t": "}"} for i in range(40)} == read(spark, tmp_path / "o")
    objects.write_object(rows.limit(0), str(tmp_path / "e"))
    assert read(spark, tmp_path / "e") == {}


def test_prices_take_their_defaults(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps({"min_price": 1, "buckets": {"milk": {"unit": "l", "median_unit_price": 2}, "oil": {"sigma": 0.1, "default_qty_ml": 750}}}))
    rows = {r.bucket: tuple(r)[1:] for r in taxonomy.read_price_buckets(spark, str(tmp_path / "p.json")).collect()}
    assert rows == {"milk": ("l", 2.0, 0.55, None, None), "oil": ("kg", 10.0, 0.1, None, 750.0), "default": ("kg", 10.0, 0.55, 250.0, 500.0)}
