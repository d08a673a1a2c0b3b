"""The driver's tables seen as a product catalog.

Each adapter is one SELECT in the SQL that Spark and DuckDB share, so that a
query and its oracle start from the same rows. ``ctes`` lists what a SELECT
needs; ``table`` builds one as a DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfspark.session import meet, parts_for

TABLES = ("region", "nation", "supplier", "customer", "part", "orders", "lineitem", "events", "documents", "labels")
PART = "concat(CASE WHEN p_partkey % 10 = 0 THEN 'fr' WHEN p_partkey % 97 = 0 THEN 'xx' ELSE 'en' END, ':p', p_partkey)"

SQL = {
    "part_ids": f"SELECT p_partkey, {PART} AS id FROM part",
    "nodes": f"""SELECT concat('en:r', r_regionkey) AS id, r_name AS en, CASE WHEN r_regionkey % 2 = 0 THEN r_name END AS fr FROM region
        UNION ALL SELECT concat('en:n', n_nationkey), n_name, CASE WHEN n_nationkey % 2 = 0 THEN concat('le ', n_name) END FROM nation
        UNION ALL SELECT concat('en:s', s_suppkey), s_name, CASE WHEN s_suppkey % 2 = 0 THEN s_name END FROM supplier
        UNION ALL SELECT {PART}, CASE WHEN p_partkey % 20 <> 0 THEN p_name END, CASE WHEN p_partkey % 20 <> 0 AND p_partkey % 2 = 0 THEN p_name END FROM part""",
    "edges": """SELECT concat('en:n', n_nationkey) AS child, concat('en:r', n_regionkey) AS parent FROM nation
        UNION ALL SELECT concat('en:s', s_suppkey), concat('en:n', s_nationkey) FROM supplier
        UNION ALL SELECT DISTINCT id, concat('en:s', l_suppkey) FROM lineitem JOIN part_ids ON l_partkey = p_partkey WHERE l_linenumber = 1""",
    "lines": """SELECT l_orderkey, id, l_suppkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn
        FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem) x JOIN part_ids ON l_partkey = p_partkey""",
    "tags": """SELECT l_orderkey AS product, rn AS pos, id AS tag FROM lines
        UNION ALL SELECT l_orderkey, 1000 + rn, concat('en:s', l_suppkey) FROM lines
        UNION ALL SELECT o_orderkey, 1000000, concat('en:x', o_custkey % 50) FROM orders""",
    "alias": "SELECT concat('en:x', n_nationkey) AS tag, concat('en:n', n_nationkey) AS \"to\" FROM nation WHERE n_nationkey < 5",
    "drop_tags": "SELECT concat('en:x', n_nationkey) AS tag FROM nation WHERE n_nationkey BETWEEN 5 AND 9",
    "texts": "SELECT doc_id, lang, CASE WHEN doc_id % 7 = 0 THEN upper(replace(text, 'ß', 'ss')) ELSE text END AS product_name, text, source FROM documents",
    "quantities": """SELECT l_orderkey, l_linenumber, l_partkey, CASE l_orderkey % 4 WHEN 0 THEN concat(p_size, ' g') WHEN 1 THEN concat(CAST(l_quantity AS INT), ' x ', p_size, ' ml')
        WHEN 2 THEN concat(p_size, ',5 oz') ELSE '' END AS quantity, l_quantity, p_size FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "raw": """SELECT o_orderkey, CASE WHEN o_orderkey % 97 = 1 THEN 'bad' WHEN o_orderkey % 89 = 2 THEN 'list' ELSE 'good' END AS form,
        CASE WHEN o_orderkey % 101 <> 3 THEN concat(o_orderkey + 1) ELSE '' END AS code, CASE WHEN o_orderkey % 202 = 3 THEN concat(' ', o_orderkey + 1000000000, ' ') END AS alt,
        CASE WHEN o_orderkey % 53 = 4 THEN ' ' WHEN o_orderkey % 7 = 0 THEN upper(concat('bread for ', o_orderstatus)) ELSE concat(CASE o_custkey % 3 WHEN 0 THEN 'Fresh milk' WHEN 1 THEN 'Extra virgin olive oil' ELSE 'Sundries' END, ' ', o_orderkey) END AS title,
        CASE WHEN o_orderkey % 59 <> 5 THEN concat('Parcel of priority ', o_orderpriority, '.') END AS descr, CASE WHEN o_orderkey % 61 <> 6 THEN o_custkey % 30 + 1 END AS rev,
        CASE WHEN o_orderkey % 4 <> 0 THEN concat('Brand ', o_orderstatus) END AS brand, CASE o_orderkey % 3 WHEN 0 THEN concat(o_custkey % 900 + 100, ' g') WHEN 1 THEN concat(o_custkey % 900 + 100, 'ml') END AS quantity,
        CASE o_custkey % 3 WHEN 0 THEN ' b ' WHEN 1 THEN 'unknown' END AS grade, CASE WHEN o_custkey % 5 <> 0 THEN o_custkey % 4 + 1 END AS nova, o_custkey AS scans FROM orders""",
    "scans": "SELECT user_id, count(*) AS scans FROM events GROUP BY user_id",
    "built": "SELECT o_orderkey AS id, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders",
    "published": """SELECT o_orderkey AS id, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders
        WHERE o_orderkey NOT BETWEEN 1000 AND 1399 AND o_orderkey NOT BETWEEN 5000 AND 5049 AND o_orderkey % 500 <> 0""",
}
LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
NEEDS = {"edges": ["part_ids"], "lines": ["part_ids"], "tags": ["part_ids", "lines"]}


def ctes(*names: str) -> str:
    """The WITH list of these adapters and what they need, for an oracle."""
    order: list[str] = []
    for n in names:
        for x in [*NEEDS.get(n, []), n]:
            if x not in order:
                order.append(x)
    return ", ".join(f"{n} AS ({SQL[n]})" for n in order)


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``SQL["tags"]``: lines meet the parts in integers and go to their order once, where they are made
    distinct, numbered and turned into two tags each."""
    lines = _lines(spark, sf_dir)[0].select(*LINE, F.explode(F.array_repeat(F.lit(1), F.col("copies"))))
    lines = lines.withColumn("rn", F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*LINE[1:])))
    two = F.array(F.struct(F.col("rn").alias("pos"), F.expr(PART.replace("p_partkey", "l_partkey")).alias("tag")), F.struct((1000 + F.col("rn")).alias("pos"), F.concat(F.lit("en:s"), "l_suppkey").alias("tag")))
    rest = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", F.lit(1000000), F.expr("concat('en:x', o_custkey % 50)"))
    return lines.select(F.col("l_orderkey").alias("product"), F.inline(two)).union(rest)


def _lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    """Distinct lines with the number of parts of their key, by order, and into how many partitions."""
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    items, parts = read("lineitem").select(LINE), read("part").groupBy(F.col("p_partkey").alias("l_partkey")).agg(F.count("*").cast("int").alias("copies"))
    n = parts_for(spark, items.count())
    return meet(items, parts, "l_partkey", "inner").repartition(n, "l_orderkey").dropDuplicates(LINE), n


def tag_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``o_orderkey, tags``: the tags of each order in order of their places. Lines go to their order as integers, and
    the list is made of them there, so that no tag moves or is sorted by itself."""
    lines, parts = _lines(spark, sf_dir)
    lines = lines.select(*LINE, F.explode(F.array_repeat(F.lit(1), F.col("copies"))))
    line = F.struct(*LINE[1:], F.expr(PART.replace("p_partkey", "l_partkey")).alias("p"), F.concat(F.lit("en:s"), "l_suppkey").alias("q"))
    lines = lines.select(F.col("l_orderkey").alias("o_orderkey"), line.alias("l")).groupBy("o_orderkey").agg(F.sort_array(F.collect_list("l")).alias("s"))
    rest = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", F.expr("concat('en:x', o_custkey % 50)").alias("x")).repartition(parts, "o_orderkey")
    rows, none = rest.groupBy("o_orderkey").agg(F.sort_array(F.collect_list("x")).alias("x")).join(lines, "o_orderkey", "left"), F.array().cast("array<string>")
    rows = rows.select("o_orderkey", "x", F.coalesce("s.p", none).alias("p"), F.coalesce("s.q", none).alias("q"))
    # With a thousand lines and more, places of parts and suppliers meet.
    at = lambda c, first, step: F.transform(c, lambda t, i: F.struct((first + step * i).alias("pos"), t.alias("tag")))
    placed = F.sort_array(F.concat(at("p", 1, 1), at("q", 1001, 1), at("x", 1000000, 0)))["tag"]
    return rows.select("o_orderkey", F.when(F.size("p") < 1000, F.concat("p", "q", "x")).otherwise(placed).alias("tags"))


def tag_count(spark: SparkSession, sf_dir: str) -> int:
    """No fewer than ``tags`` has, from the numbers of rows in the files, if parts are there once."""
    rows = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in ("lineitem", "orders")}
    return 2 * rows["lineitem"] + rows["orders"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An adapter, or one of the driver's own tables, as a DataFrame."""
    if name == "tags":
        return tags(spark, sf_dir)
    if name not in SQL:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    names = [*NEEDS.get(name, []), name]
    sql = " ".join(SQL[n] for n in names)
    base = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f" {t}" in sql}
    text = sql_of(name).replace('"to"', "`to`")
    for t in base:
        text = _from(text, t)
    return spark.sql(text, **base)


def sql_of(name: str) -> str:
    needs = NEEDS.get(name, [])
    return (f"WITH {', '.join(f'{n} AS ({SQL[n]})' for n in needs)} " if needs else "") + SQL[name]


def _from(text: str, name: str) -> str:
    import re

    return re.sub(rf"\b(FROM|JOIN) {name}\b", rf"\1 {{{name}}}", text)
