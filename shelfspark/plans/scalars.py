"""Queries of the column jobs and row gates, with their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.functions import text as T
from shelfspark.operators import gates
from shelfspark.plans.adapters import SQL, ctes, table
from shelfspark.sources import products

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, oracle: str | None = None):
    def add(f):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return add


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def deshout_sql(x: str) -> str:
    letters = f"length(regexp_replace({x}, '\\P{{L}}', '', 'g'))"
    upper = f"length(regexp_replace({x}, '\\P{{Lu}}', '', 'g'))"
    s = strip_sql(x)
    return f"CASE WHEN {letters} > 0 AND {upper} >= 0.8 * {letters} THEN upper(left(lower({s}), 1)) || substr(lower({s}), 2) ELSE {s} END"


@query("deshout_text", f"WITH {ctes('texts')} SELECT doc_id, md5({deshout_sql('product_name')}) AS title_md5, lower({strip_sql('source')}) IN ('undefined', 'unknown', 'null', 'none', 'n/a', 'na', '') AS undefined FROM texts")
def deshout_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "texts").select("doc_id", F.md5(T.deshout(F.col("product_name")).cast("binary")).alias("title_md5"), T.undefined_like(F.col("source")).alias("undefined"))


@query("gtin13", """SELECT o_orderkey, left(lpad(d, CAST(greatest(13, length(d)) AS INT), '0'), 13) AS gtin, substr(left(lpad(d, CAST(greatest(13, length(d)) AS INT), '0'), 13), 1, 3) AS folder
    FROM (SELECT o_orderkey, regexp_replace(concat(o_orderkey, '-', o_custkey, o_orderpriority, CAST(o_totalprice AS BIGINT)), '[^0-9]', '', 'g') AS d FROM orders)""")  # fmt: skip
def gtin13(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.concat("o_orderkey", F.lit("-"), "o_custkey", "o_orderpriority", F.round(F.bround("o_totalprice", 0), 0).cast("long"))
    g = T.gtin13(code)
    return table(spark, sf_dir, "orders").select("o_orderkey", g.alias("gtin"), F.substring(g, 1, 3).alias("folder"))


@query("lang_fallback", f"""WITH {ctes('texts')}, t AS (SELECT doc_id, CASE WHEN lang = 'fr' OR doc_id % 3 = 0 THEN product_name END AS x, CASE WHEN lang = 'fr' THEN text END AS d FROM texts)
    SELECT doc_id, CASE WHEN x IS NULL THEN NULL ELSE md5({deshout_sql('x')}) END AS title_md5,
           CASE WHEN d IS NULL THEN NULL ELSE md5({deshout_sql("substr(" + strip_sql('d') + ", 1, 600)")}) END AS text_md5 FROM t""")  # fmt: skip
def lang_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "texts")
    named = F.when(F.col("doc_id") % 3 == 0, F.col("product_name"))
    title = T.language_title(named, F.col("product_name"), F.col("lang"), "fr")
    text = T.language_description([(F.lit(None).cast("string"), F.lit(" ")), (F.lit(None).cast("string"), F.col("text"))], F.col("lang"), "fr")
    return rows.select("doc_id", F.md5(title.cast("binary")).alias("title_md5"), F.md5(text.cast("binary")).alias("text_md5"))


@query("clean_tags", """SELECT p_partkey, list_filter([trim(p_brand), 'x:' || p_type, CASE WHEN p_size % 2 = 0 THEN 'organic' END], lambda t: t IS NOT NULL AND t <> '') AS tags FROM part""")
def clean_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.array(F.concat(F.lit(" "), "p_brand", F.lit("\t")), F.concat(F.lit("en:x:"), "p_type"), F.when(F.col("p_size") % 2 == 0, " en:organic "), F.lit("  "))
    return table(spark, sf_dir, "part").select("p_partkey", T.clean_tags(raw).alias("tags"))


@query("number_format", """SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN format('{:g}', p_retailprice * 1e3) WHEN p_size % 5 = 1 THEN format('{:g}', p_size / 1e6) ELSE format('{:g}', p_retailprice / 7) END
    || CASE WHEN p_size % 2 = 0 THEN ' g' ELSE '' END AS amount FROM part""")  # fmt: skip
def number_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.when(F.col("p_size") % 5 == 0, F.col("p_retailprice") * 1e3).when(F.col("p_size") % 5 == 1, F.col("p_size") / 1e6).otherwise(F.col("p_retailprice") / 7)
    return table(spark, sf_dir, "part").select("p_partkey", T.nutrient(x, F.when(F.col("p_size") % 2 == 0, "g")).alias("amount"))


@query("dietary_flags", """SELECT o_orderkey, list_filter([CASE WHEN o_custkey % 7 = 0 THEN 'gluten_free' END, CASE WHEN o_orderkey % 2 = 0 THEN 'organic' END,
    CASE WHEN o_orderkey % 3 = 0 OR o_custkey % 5 = 0 THEN 'vegan' END], lambda t: t IS NOT NULL) AS flags FROM orders""")  # fmt: skip
def dietary_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = F.array(F.when(F.col("o_orderkey") % 2 == 0, "en:usda-organic"), F.when(F.col("o_custkey") % 7 == 0, "en:gluten-free"), F.when(F.col("o_orderkey") % 3 == 0, "en:vegan"), F.lit("en:no-gluten"))
    analysis = F.array(F.when(F.col("o_custkey") % 5 == 0, "en:vegan"))
    return table(spark, sf_dir, "orders").select("o_orderkey", T.dietary(labels, analysis).alias("flags"))


@query("describe", """SELECT p_partkey, trim(CASE WHEN p_size % 3 = 0 THEN trim(p_name) || '. ' ELSE trim(p_name) || '. ' END || trim(p_type)) AS description FROM part""")
def describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit(" "), "p_name", F.lit(". "))).otherwise(F.col("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", T.describe(title, F.col("p_type")).alias("description"))


@query("image_url", """SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN NULL WHEN p_size % 4 = 1 THEN 'https://images.example.org/products/' || f || '/front_en.' || p_size || '.400.jpg'
    WHEN p_size % 4 = 2 THEN 'https://images.example.org/products/' || f || '/' || p_size || '.jpg' ELSE 'https://images.example.org/products/' || f || '/front_en.' || p_size || '.full.jpg' END AS url
    FROM (SELECT *, substr(c, 1, 3) || '/' || substr(c, 4, 3) || '/' || substr(c, 7, 3) || '/' || substr(c, 10) AS f FROM (SELECT *, lpad(CAST(p_partkey AS VARCHAR), 13, '0') AS c FROM part))""")  # fmt: skip
def image_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("p_size") % 4
    keys = F.when(kind == 0, F.array(F.lit("front_fr"), F.lit("1"))).otherwise(F.array(F.lit("front_en"), F.lit("front")))
    sizes = F.when(kind == 1, F.array(F.lit("100"), F.lit("400"))).otherwise(F.array().cast("array<string>"))
    url = T.image_url(F.col("p_partkey").cast("string"), T.front_key(keys, require="en"), F.when(kind != 2, F.col("p_size").cast("string")), F.col("p_size").cast("string"), sizes, sizes)
    return table(spark, sf_dir, "part").select("p_partkey", url.alias("url"))


@query("json_scan", """SELECT event_id, CASE WHEN event_id % 11 = 0 THEN 'bad_json' WHEN event_id % 13 = 0 THEN 'not_object' ELSE 'object' END AS kind,
    CASE WHEN event_id % 11 <> 0 AND event_id % 13 <> 0 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k FROM events WHERE event_id % 17 <> 0""")  # fmt: skip
def json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.when(F.col("event_id") % 17 == 0, "  ").when(F.col("event_id") % 11 == 0, F.concat("props", F.lit("}"))).when(F.col("event_id") % 13 == 0, "[1]").otherwise(F.col("props"))
    rows = products.parsed(table(spark, sf_dir, "events").withColumn("value", line))
    return rows.select("event_id", "kind", F.expr("try_variant_get(v, '$.k', 'long')").alias("k"))


_GATES = """SELECT CASE WHEN event_id % 11 = 0 THEN 'bad_json' WHEN user_id % 19 = 0 THEN 'missing_code' WHEN event_type = 'click' AND event_id % 2 = 0 THEN 'missing_title'
    WHEN value < 10 THEN 'missing_desc' WHEN event_id % 5 = 0 THEN 'missing_image' ELSE 'written' END AS reason FROM events"""


@query("gate_funnel", f"SELECT reason, count(*) AS products FROM ({_GATES}) GROUP BY reason")
def gate_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    code = F.when(F.col("user_id") % 19 != 0, F.col("user_id").cast("string"))
    rows = e.withColumns({
        "code": gates.key(F.lit("0"), code),
        "title": F.when(~((F.col("event_type") == "click") & (F.col("event_id") % 2 == 0)), F.col("event_type")),
        "desc": F.when(F.col("value") >= 10, F.col("event_type")),
        "image": F.when(F.col("event_id") % 5 != 0, F.lit("url")),
    })
    checks = {"bad_json": F.col("event_id") % 11 == 0, "missing_code": F.col("code").isNull(), "missing_title": F.col("title").isNull(), "missing_desc": F.col("desc").isNull(), "missing_image": F.col("image").isNull()}
    return gates.funnel(gates.gated(rows, checks))


@query("bounded_read", "SELECT event_id, n FROM (SELECT event_id, row_number() OVER (ORDER BY event_id) AS n, value FROM events) WHERE n <= 5000 AND value >= 50 QUALIFY row_number() OVER (ORDER BY n) <= 1000")
def bounded_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = products.numbered(table(spark, sf_dir, "events"), "event_id")
    return products.bounded(rows, F.col("value") >= 50, read=5000, written=1000).select("event_id", F.col("n").cast("long").alias("n"))
