"""Queries of pricing, documents, verification, reconciliation and publishing, with their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.functions import pricing as P
from shelfspark.functions import text as T
from shelfspark.operators import documents as D
from shelfspark.operators import publish, reconcile, verify
from shelfspark.operators.generations import Generations, local_diff
from shelfspark.plans.adapters import ctes, table
from shelfspark.session import cut, scratch

QUERIES: dict = {}
ORACLES: dict = {}
#: A small price list of our own for the driver's parts.
CONFIG = P.PricingConfig(
    endings=(0.99, 0.49, 0.29, 0.19, 0.09), multipliers={"en:organic": 1.25, "en:fair-trade": 1.15},
    buckets={"default": P.Bucket("kg", 10.0, 0.55, 250, 500), "olive_oil": P.Bucket("l", 26.0, 0.5, None, 500), "dairy": P.Bucket("kg", 6.0, 0.6, 500), "bakery": P.Bucket("kg", 8.0, 0.6, 400)},
)


def query(name: str, oracle: str | None = None):
    def add(f):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return add


_SIZES = """q AS (SELECT l_orderkey, l_linenumber, l_partkey, quantity, p_size, l_quantity, CASE l_orderkey % 4 WHEN 0 THEN p_size * 1.0 WHEN 2 THEN (p_size + 0.5) * 28.349523125 END AS grams,
    CASE WHEN l_orderkey % 4 = 1 THEN CAST(l_quantity AS INT) * (p_size * 1.0) END AS ml FROM quantities)"""


@query("parse_quantity", f"WITH {ctes('quantities')}, {_SIZES} SELECT l_orderkey, l_linenumber, l_partkey, quantity, grams::DOUBLE AS grams, ml::DOUBLE AS ml, CASE WHEN ml IS NOT NULL THEN CAST(l_quantity AS INT)::BIGINT END AS count FROM q")
def parse_quantity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "quantities").withColumn("q", P.quantity(F.col("quantity")))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "quantity", "q.grams", "q.ml", "q.count")


_HAY = "lower(CASE p_size % 6 WHEN 0 THEN 'Dark Chocolate' WHEN 1 THEN 'Extra virgin fine olive' WHEN 2 THEN 'boiled' WHEN 3 THEN 'Whole milk' WHEN 4 THEN 'rye bread' ELSE 'x' END || ' | ' || p_type || ' | ' || p_name)"
#: The oracle's own statement of the buckets in order and of their margins (fixed values).
_BUCKET = """CASE WHEN regexp_matches(h, 'snack|confection|candy|chocolate|sweet|biscuit|cookie|gummies') THEN 'snacks_sweets' WHEN regexp_matches(h, 'condiment|sauce|vinegar|dressing|marinade|ketchup|mustard') THEN 'condiments_sauces'
    WHEN h LIKE '%olive oil%' OR (h LIKE '%extra virgin%' AND h LIKE '%olive%') THEN 'olive_oil' WHEN regexp_matches(h, 'oil|fat') THEN 'oils_fats' WHEN regexp_matches(h, 'sweetener|syrup|maple|honey') THEN 'sweeteners_syrups'
    WHEN regexp_matches(h, 'meal|pasta|ravioli|frozen|ready|prepared|dish') THEN 'meals_chilled_frozen' WHEN regexp_matches(h, 'fruit|vegetable|produce|salad|lettuce|apple') THEN 'produce' WHEN regexp_matches(h, 'milk|cheese|yogurt|dairy|butter') THEN 'dairy'
    WHEN regexp_matches(h, 'beverage|drink|juice|soda|soft|water') THEN 'beverages_soft' WHEN regexp_matches(h, 'coffee|tea') THEN 'coffee_tea' WHEN regexp_matches(h, 'bread|bakery|croissant|cake|pastry') THEN 'bakery' ELSE 'default' END"""


def _primary() -> F.Column:
    n = F.col("p_size") % 6
    return F.when(n == 0, "Dark Chocolate").when(n == 1, "Extra virgin fine olive").when(n == 2, "boiled").when(n == 3, "Whole milk").when(n == 4, "rye bread").otherwise("x")


@query("price_bucket", f"SELECT p_partkey, {_BUCKET} AS bucket FROM (SELECT p_partkey, {_HAY} AS h FROM part)")
def price_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", P.bucket(_primary(), F.array("p_type"), F.col("p_name")).alias("bucket"))


def _u(key: str, salt: str) -> str:
    return f"((('0x' || substr(md5({key} || '|{salt}'), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE)"


def _noise(key: str, median: str, sigma: str) -> str:
    return f"exp(ln({median}) + {sigma} * sqrt(-2 * ln({_u(key, 'radius')})) * cos(2 * pi() * {_u(key, 'angle')}))"


@query("hash_noise", f"SELECT p_partkey, round({_noise('CAST(p_partkey AS VARCHAR)', '12.0::DOUBLE', '0.6::DOUBLE')}, 6) AS noise FROM part")
def hash_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", F.round(P.lognormal(F.col("p_partkey").cast("string"), F.lit(12.0), F.lit(0.6)), 6).alias("noise"))


def _rounded(x: str) -> str:
    ends = "[0.09, 0.19, 0.29, 0.49, 0.99]::DOUBLE[]"
    fit = f"list_max(list_filter({ends}, lambda e: e <= {x} - floor({x}) + 1e-9))"
    return f"CASE WHEN {x} <= 0 THEN 0.0 ELSE round(CASE WHEN {fit} IS NOT NULL THEN floor({x}) + {fit} ELSE greatest(floor({x}) - 1, 0) + 0.99::DOUBLE END, 2) END"


@query("retail_round", f"SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, {_rounded('(l_extendedprice / 37)')} AS price FROM lineitem")
def retail_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", P.retail_round(F.col("l_extendedprice") / 37, CONFIG.endings).alias("price"))


#: The oracle's own statement of CONFIG.
_VALUES = """('default', 'kg', 10.0::DOUBLE, 0.55::DOUBLE, 250::DOUBLE, 500::DOUBLE), ('olive_oil', 'l', 26.0::DOUBLE, 0.5::DOUBLE, NULL::DOUBLE, 500::DOUBLE), ('dairy', 'kg', 6.0::DOUBLE, 0.6::DOUBLE, 500::DOUBLE, NULL::DOUBLE),
    ('bakery', 'kg', 8.0::DOUBLE, 0.6::DOUBLE, 400::DOUBLE, NULL::DOUBLE)"""
_ESTIMATE = f"""WITH b(name, unit, median, sigma, dg, dm) AS (VALUES {_VALUES}),
p AS (SELECT *, {_BUCKET} AS raw FROM (SELECT *, {_HAY} AS h, CASE p_partkey % 3 WHEN 0 THEN p_size::DOUBLE END AS g, CASE WHEN p_partkey % 3 = 1 THEN p_size * 10.0::DOUBLE END AS m FROM part)),
j AS (SELECT p.*, b.*, CASE WHEN unit = 'kg' AND g IS NOT NULL THEN g / 1000 WHEN unit = 'l' AND m IS NOT NULL THEN m / 1000 WHEN unit = 'kg' THEN coalesce(dg / 1000, 0.25) ELSE coalesce(dm / 1000, 0.5) END AS amount,
    CASE WHEN unit = 'kg' AND g IS NOT NULL THEN g::INT || 'g' WHEN unit = 'l' AND m IS NOT NULL THEN m::INT || 'ml' WHEN unit = 'kg' THEN coalesce('default ' || dg::INT || 'g', 'fallback 250g') || ' (no package qty)'
    ELSE coalesce('default ' || dm::INT || 'ml', 'fallback 500ml') || ' (no package qty)' END AS shown FROM p JOIN b ON b.name = CASE WHEN raw IN (SELECT name FROM b) THEN raw ELSE 'default' END),
n AS (SELECT *, {_noise("(p_partkey || '|' || name || '|' || shown)", 'median', 'sigma')} AS noise, greatest(0.15, least(10, amount / CASE WHEN unit = 'kg' THEN 0.25 ELSE 0.5 END)) AS ratio FROM j),
u AS (SELECT *, CASE WHEN name = 'olive_oil' THEN greatest(noise, 0.6 * median) ELSE noise END * CASE WHEN g IS NULL AND m IS NULL THEN 1 ELSE greatest(0.55, least(1.35, CASE WHEN ratio >= 1 THEN power(ratio, -0.22) ELSE power(ratio, -0.10) END)) END
    * CASE WHEN p_size % 2 = 0 THEN 1.25 * 1.25 * 1.15 ELSE 1 END * CASE WHEN p_partkey % 4 = 0 THEN 0.97 ELSE 1.05 END AS unit_price FROM n)"""


def _estimated(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").withColumn("bucket", P.bucket(_primary(), F.array("p_type"), F.col("p_name")))
    n = F.col("p_partkey") % 3
    size = F.when(n == 0, F.concat("p_size", F.lit(" g"))).when(n == 1, F.concat(F.col("p_size") * 10, F.lit("ml")))
    labels = F.when(F.col("p_size") % 2 == 0, F.array(*map(F.lit, ("en:organic", "en:organic", "en:fair-trade", "en:other"))))
    brand = F.when(F.col("p_partkey") % 4 != 0, F.col("p_brand"))
    return P.estimated(rows.withColumns({"size": size, "labels": labels, "brand": brand}), F.col("p_partkey").cast("string"), F.col("bucket"), F.col("size"), F.col("labels"), F.col("brand"), CONFIG)


@query("estimate_price", f"{_ESTIMATE} SELECT p_partkey, name AS bucket, round(unit_price, 6) AS unit_price, {_rounded('greatest(0.49, least(99.99, unit_price * amount))')} AS price FROM u")
def estimate_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = F.when(F.col("bucket").isin(*CONFIG.buckets), F.col("bucket")).otherwise("default")
    return _estimated(spark, sf_dir).select("p_partkey", named.alias("bucket"), F.round("e.unit_price", 6).alias("unit_price"), "e.price")


@query("popularity", f"WITH {ctes('scans')} SELECT user_id, least(10000, round_even(1000 * ln(1 + scans), 0))::INT AS popularity FROM scans")
def popularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "scans").select("user_id", P.popularity(F.col("scans")).alias("popularity"))


_RATES = """CASE k WHEN 'bakery' THEN 42 WHEN 'snacks_sweets' THEN 38 WHEN 'coffee_tea' THEN 35 WHEN 'produce' THEN 35 WHEN 'beverages_soft' THEN 30 WHEN 'condiments_sauces' THEN 30 WHEN 'meals_chilled_frozen' THEN 28
    WHEN 'sweeteners_syrups' THEN 28 WHEN 'default' THEN 25 WHEN 'oils_fats' THEN 24 WHEN 'olive_oil' THEN 22 WHEN 'dairy' THEN 20 END"""


@query("margin", f"""WITH m AS (SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'default' ELSE raw END AS k, p_size, least(1.4, CASE WHEN p_size % 2 = 0 THEN 1.25 ELSE 1.0 END * CASE WHEN p_size % 5 = 0 THEN 1.15 ELSE 1.0 END) AS up
    FROM (SELECT *, {_BUCKET} AS raw FROM (SELECT *, {_HAY} AS h FROM part)))
    SELECT p_partkey, round_even({_RATES} * up::DOUBLE, 0)::INT AS margin, round_even({_RATES} * up::DOUBLE, 0)::INT || '% (bucket=' || k || ' base=' || {_RATES} || '%' ||
    CASE WHEN p_size % 10 = 0 THEN ', labels=organic+fair-trade x1.40' WHEN p_size % 2 = 0 THEN ', labels=organic x1.25' WHEN p_size % 5 = 0 THEN ', labels=fair-trade x1.15' ELSE '' END || ')' AS detail FROM m""")  # fmt: skip
def margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").withColumn("bucket", P.bucket(_primary(), F.array("p_type"), F.col("p_name")))
    labels = F.array_compact(F.array(F.when(F.col("p_size") % 2 == 0, "en:organic"), F.lit("en:other"), F.when(F.col("p_size") % 5 == 0, "en:fair-trade")))
    m = P.margin(F.when(F.col("p_size") % 3 == 0, "nameless").otherwise(F.col("bucket")), labels)
    return rows.select("p_partkey", m.alias("m")).select("p_partkey", "m.margin", "m.detail")


def _attributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _estimated(spark, sf_dir).withColumn("m", P.margin(F.col("bucket"), F.col("labels")))
    unit = F.when(F.col("p_size") % 2 == 0, "g")
    attrs = D.attributes({
        "Quantity": T.present(F.col("size")), "Nutri-Score": D.grade(F.when(F.col("p_size") % 3 == 0, "unknown").when(F.col("p_size") % 3 == 1, " b "), F.lit("c")),
        "NOVA group": D.whole(F.when(F.col("p_size") % 5 != 0, F.col("p_retailprice"))), "Labels": T.clean_tags(F.col("labels")), "Countries": T.present(F.lit("France, Chile")),
        "Category": D.category(F.when(F.col("p_size") % 7 == 0, "Unknown").otherwise(F.col("p_type"))), "Fat (g/100g)": T.nutrient(F.col("p_size") / 4, unit),
        "Dietary restrictions": T.dietary(F.col("labels"), F.lit(None).cast("array<string>")), "Pricing bucket": F.col("bucket"), "Estimated unit price": F.col("e.detail"), "Modelled margin": F.col("m.detail"),
        "Unique scans": F.coalesce(F.when(F.col("p_size") % 2 == 0, F.col("p_partkey")), F.lit(0)).cast("string"),
    })
    return rows.withColumn("attrs", attrs)


_ATTRS = """SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_size || ' g' WHEN 1 THEN p_size * 10 || 'ml' END AS qty, CASE p_size % 3 WHEN 0 THEN NULL WHEN 1 THEN 'B' ELSE 'C' END AS nutri,
    CASE WHEN p_size % 5 <> 0 THEN CAST(trunc(p_retailprice) AS BIGINT)::VARCHAR END AS nova, p_size % 2 = 0 AS even, CASE WHEN p_size % 7 <> 0 THEN p_type END AS category,
    format('{:g}', p_size / 4) || CASE WHEN p_size % 2 = 0 THEN ' g' ELSE '' END AS fat FROM part"""


@query("build_attrs", f"WITH a AS ({_ATTRS}) SELECT p_partkey, qty, nutri, nova, CASE WHEN even THEN 'organic,organic,fair-trade,other' END AS labels, category, fat, CASE WHEN even THEN 'organic' ELSE '' END AS dietary FROM a")
def build_attrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = F.col("attrs")
    return _attributed(spark, sf_dir).select(
        "p_partkey", a["Quantity"].alias("qty"), a["Nutri-Score"].alias("nutri"), a["NOVA group"].alias("nova"), F.array_join(a["Labels"], ",").alias("labels"), a["Category"].alias("category"),
        a["Fat (g/100g)"].alias("fat"), F.array_join(a["Dietary restrictions"], ",").alias("dietary"),
    )


@query("attr_keys", f"""WITH a AS ({_ATTRS}) SELECT p_partkey, CASE WHEN category IS NOT NULL THEN 'Category|' ELSE '' END || 'Countries|Dietary restrictions|Estimated unit price|Fat (g/100g)|' || CASE WHEN even THEN 'Labels|' ELSE '' END ||
    'Margin source|Modelled margin|' || CASE WHEN nova IS NOT NULL THEN 'NOVA group|' ELSE '' END || CASE WHEN nutri IS NOT NULL THEN 'Nutri-Score|' ELSE '' END || 'Popularity source|Price source|Pricing bucket|' ||
    CASE WHEN qty IS NOT NULL THEN 'Quantity|' ELSE '' END || 'Unique scans' AS keys FROM a""")  # fmt: skip
def attr_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _attributed(spark, sf_dir).select("p_partkey", F.array_join(D.attribute_keys(F.col("attrs")), "|").alias("keys"))


@query("promoted", f"WITH a AS ({_ATTRS}) SELECT p_partkey, CASE WHEN even THEN ['organic', 'organic', 'fair-trade', 'other'] END AS labels, 'France, Chile' AS countries, nutri AS nutri_score, nova AS nova_group FROM a")
def promoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _attributed(spark, sf_dir).select("p_partkey", *D.promoted(F.col("attrs")))
    return rows.select("p_partkey", "labels", "countries", "nutri_score", "nova_group")


@query("documents", f"{_ESTIMATE}, d AS (SELECT *, {_rounded('greatest(0.49, least(99.99, unit_price * amount))')} AS price FROM u) SELECT lpad(p_partkey::VARCHAR, 13, '0') AS id, p_name AS title, p_name || '. ' || p_type AS description, price, 'USD' AS currency FROM d")
def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast("array<string>")
    rows = _attributed(spark, sf_dir).withColumns({
        "id": T.gtin13(F.col("p_partkey").cast("string")), "title": T.deshout(F.col("p_name")), "description": T.describe(F.col("p_name"), F.col("p_type")), "image_url": F.lit(None).cast("string"), "price": F.col("e.price"),
        "margin": P.margin(F.col("bucket"), F.col("labels"))["margin"], "popularity": P.popularity(F.col("p_size")), "taxonomy_tags": none, "category_path": none, "category_path_primary": none, "dietary_restrictions": F.col("attrs.`Dietary restrictions`"),
    })
    return D.project(rows).select("id", "title", "description", "price", "currency")


# Verification: customers' addresses region/nation/name as a catalog, with planted defects by key.
_REGION, _NATION, _LEAF = "r_name", "r_name || '/' || n_name", "r_name || '/' || n_name || '/' || replace(c_name, '#', '')"
_JOINED = "customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"


def _planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    rows = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    a, b = F.col("r_name"), F.concat_ws("/", "r_name", "n_name")
    leaf = F.concat_ws("/", b, F.replace("c_name", F.lit("#"), F.lit("")))
    k = F.col("c_custkey")
    path = F.when(k % 50 == 1, F.array(a, b, b)).when(k % 50 == 2, F.array(a, leaf)).when(k % 50 == 3, F.array(a, b, F.concat(b, F.lit("/")))).when(k % 50 == 4, F.array().cast("array<string>")).when(k % 50 == 5, F.array(b, a)).otherwise(F.array(a, b, leaf))
    primary = F.when(k % 50 == 6, F.array(a, leaf)).when(k % 50 == 7, F.array(F.concat(F.lit("X"), a))).when(k % 50 == 4, F.array().cast("array<string>")).otherwise(F.array(a, b))
    tags = F.array(F.col("n_name"), F.when(k % 50 == 8, "foreign").otherwise(F.col("r_name")))
    ident = F.when(k % 50 == 9, F.lit(None)).when(k % 50 == 10, "same").otherwise(k.cast("string"))
    rows = rows.select(k.alias("key"), ident.alias("id"), tags.alias("taxonomy_tags"), path.alias("category_path"), primary.alias("category_path_primary"))
    return cut(verify.row_violations(rows), "checked")


_BAD = """v AS (SELECT c_custkey AS key, c_custkey % 50 AS m, r_name, n_name, c_name FROM """ + _JOINED + """),
bad AS (SELECT *, CASE m WHEN 1 THEN 'duplicate' WHEN 2 THEN 'missing_ancestor' WHEN 3 THEN 'trailing_separator' WHEN 5 THEN 'not_headed_by_primary' WHEN 6 THEN 'not_headed_by_primary' WHEN 7 THEN 'not_headed_by_primary' END AS union_bad,
    CASE m WHEN 6 THEN 'broken_chain' END AS chain_bad FROM v)"""


@query("verify_rows", f"WITH {_BAD} SELECT key, union_bad, chain_bad FROM bad")
def verify_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _planted(spark, sf_dir).select("key", "union_bad", "chain_bad")


def _measured(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = _planted(spark, sf_dir)
    roots = table(spark, sf_dir, "region").select(F.col("r_name").alias("label"))
    labels = roots.union(table(spark, sf_dir, "nation").select("n_name")).union(table(spark, sf_dir, "customer").select(F.replace("c_name", F.lit("#"), F.lit(""))))
    return rows, verify.segment_checks(rows, roots, labels)


@query("verify_segments", f"""WITH {_BAD}, vals AS (SELECT n_name AS label FROM bad UNION ALL SELECT CASE WHEN m = 8 THEN 'foreign' ELSE r_name END FROM bad
    UNION ALL SELECT r_name FROM bad WHERE union_bad IS NULL AND m <> 4 UNION ALL SELECT n_name FROM bad WHERE union_bad IS NULL AND m <> 4 UNION ALL SELECT replace(c_name, '#', '') FROM bad WHERE union_bad IS NULL AND m <> 4)
    SELECT 0::BIGINT AS several_primary_addresses, (SELECT count(*) FROM bad WHERE m = 7) AS unanchored_chains, count(DISTINCT label) AS values_checked,
    count(DISTINCT label) FILTER (label = 'foreign') AS values_outside, count(*) FILTER (label = 'foreign') AS instances_outside FROM vals""")  # fmt: skip
def verify_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _measured(spark, sf_dir)[1]


@query("verify_metrics", f"""WITH {_BAD}, i AS (SELECT *, CASE m WHEN 9 THEN '' WHEN 10 THEN 'same' ELSE key::VARCHAR END AS id, CASE m WHEN 1 THEN 3 WHEN 2 THEN 2 WHEN 3 THEN 3 WHEN 5 THEN 2 WHEN 4 THEN NULL ELSE 3 END AS n FROM bad)
    SELECT count(*) AS records, count(DISTINCT id) AS distinct_ids, count(*) - count(DISTINCT id) AS duplicate_ids, count(n) AS with_path, count(union_bad) AS union_violations, count(chain_bad) AS chain_violations,
    round(avg(n), 3) AS mean_values, max(n) AS max_values FROM i""")  # fmt: skip
def verify_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify.metrics(_planted(spark, sf_dir))


@query("depth_histogram", f"WITH {_BAD} SELECT CASE m WHEN 7 THEN 1 ELSE 2 END AS depth, count(*) AS rows FROM bad WHERE m <> 4 GROUP BY 1")
def depth_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify.depth_histogram(_planted(spark, sf_dir))


@query("verify_gate", f"WITH {_BAD}, n AS (SELECT count(*) FILTER (m = 6) AS a, count(union_bad) AS b, count(*) FILTER (m = 7) AS c, count(*) FILTER (m IN (9, 10)) AS d FROM bad) SELECT unnest(['nothing_verified', 'single_primary_chain', 'prefix_closed_union', 'one_primary_address', 'anchoring', 'vocabulary', 'unique_ids']) AS \"check\", unnest([false, a > 0, b > 0, false, c > 0, false, d > 2]) AS failed FROM n")
def verify_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, segments = _measured(spark, sf_dir)
    return verify.gate(verify.metrics(rows).join(segments), verify.Tolerance(fraction=0.01), unique_ids=True)


def _both(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return table(spark, sf_dir, "published"), table(spark, sf_dir, "built")


_PB = ctes("published", "built")


@query("schema_check", "SELECT f AS field, CASE WHEN f IN (SELECT replace(column_name, 'o_orderkey', 'id') FROM (DESCRIBE orders)) THEN 'pass' ELSE 'fail' END AS status FROM (SELECT unnest(['id', 'o_totalprice', 'o_orderstatus', 'absent']) AS f)")
def schema_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.schema_check(_both(spark, sf_dir)[0], ["id", "o_totalprice", "o_orderstatus", "absent"])


@query("identity_check", f"""WITH {_PB}, p(property, found, expected) AS (SELECT unnest(['ids', 'rows', 'commit']), unnest([(SELECT count(DISTINCT id) FROM published), (SELECT count(*) FROM built), NULL]),
    unnest([(SELECT count(DISTINCT id) FROM built), (SELECT count(*) FROM built), 0])) SELECT property, CASE WHEN found IS NULL THEN 'unverifiable' WHEN found = expected THEN 'pass' ELSE 'fail' END AS status FROM p""")
def identity_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    published, built = _both(spark, sf_dir)
    n = built.agg(F.count("*").cast("string").alias("n"), F.countDistinct("id").cast("string").alias("ids"))
    manifest = n.select(F.explode(F.map_from_arrays(F.array(F.lit("ids"), F.lit("rows"), F.lit("commit")), F.array("ids", "n", F.lit("abc")))).alias("property", "value"))
    return reconcile.identity_check({"ids": str(published.select("id").distinct().count()), "rows": str(built.count())}, manifest)


@query("count_coverage", f"""WITH {_PB}, n AS (SELECT 'published' AS side, (SELECT count(*) FROM published) AS n, (SELECT count(CASE WHEN o_custkey % 9 <> 0 THEN 1 END) FROM published) AS filled
    UNION ALL SELECT 'built', (SELECT count(*) FROM built), (SELECT count(o_orderpriority) FROM built)), e AS (SELECT count(DISTINCT id) AS expected FROM built)
    SELECT side, n AS published, expected, CASE WHEN n = expected AND n > 0 THEN 'pass' ELSE 'fail' END AS count_status, n AS rows, filled AS covered, CASE WHEN n > 0 AND filled = n THEN 'pass' ELSE 'fail' END AS coverage_status FROM n, e""")  # fmt: skip
def count_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, b = _both(spark, sf_dir)
    p = p.withColumn("o_orderpriority", F.when(F.col("o_custkey") % 9 != 0, F.col("o_orderpriority")))
    rows = [reconcile.count_check(x, b).withColumnRenamed("status", "count_status").join(reconcile.coverage_check(x, "o_orderpriority").withColumnRenamed("status", "coverage_status")).withColumn("side", F.lit(side)) for side, x in (("published", p), ("built", b))]
    return rows[0].unionByName(rows[1])


@query("value_counts", f"WITH {_PB} SELECT o_orderpriority AS value, count(*) AS rows FROM published GROUP BY 1")
def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.value_counts(_both(spark, sf_dir)[0], "o_orderpriority")


@query("vocab_diff", f"WITH {_PB}, p AS (SELECT DISTINCT o_custkey AS value FROM published), v AS (SELECT c_custkey AS value FROM customer WHERE c_custkey % 10 <> 3) SELECT value, 'outside' AS side FROM p WHERE value NOT IN (SELECT value FROM v) UNION ALL SELECT value, 'unused' FROM v WHERE value NOT IN (SELECT value FROM p)")
def vocab_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = table(spark, sf_dir, "customer").filter("c_custkey % 10 <> 3").select(F.col("c_custkey").alias("value"))
    return reconcile.vocabulary_diff(_both(spark, sf_dir)[0].select(F.col("o_custkey").alias("value")), vocab)


@query("orphan_addresses", f"SELECT DISTINCT r_name || '/' || n_name || '/' || replace(c_name, '#', '') AS path FROM {_JOINED} WHERE n_nationkey % 5 = 0")
def orphan_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    rows = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    b = F.concat_ws("/", "r_name", "n_name")
    paths = F.array_compact(F.array("r_name", F.when(F.col("n_nationkey") % 5 != 0, b), F.concat_ws("/", b, F.replace("c_name", F.lit("#"), F.lit("")))))
    return reconcile.orphan_addresses(rows.select(F.explode(paths).alias("path")))


_SHIFTED = "shifted AS (SELECT CASE WHEN id % 700 = 3 THEN -id ELSE id END AS id FROM published)"


@query("id_diff", f"WITH {_PB}, {_SHIFTED} SELECT id, 'missing' AS side FROM built WHERE id NOT IN (SELECT id FROM shifted) UNION ALL SELECT id, 'unexpected' FROM shifted WHERE id NOT IN (SELECT id FROM built)")
def id_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, b = _both(spark, sf_dir)
    return reconcile.id_diff(p.withColumn("id", F.when(F.col("id") % 700 == 3, -F.col("id")).otherwise(F.col("id"))), b)


_RUNS = f"""WITH {_PB}, m AS (SELECT row_number() OVER (ORDER BY id) - 1 AS n, id FROM built), g AS (SELECT n, n - row_number() OVER (ORDER BY n) AS i FROM m WHERE id NOT IN (SELECT id FROM published)),
    runs AS (SELECT min(n) AS first, max(n) AS last, count(*) AS ids FROM g GROUP BY i)"""


@query("missing_runs", f"{_RUNS} SELECT first, last, ids FROM runs")
def missing_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfspark.sources.products import numbered

    p, b = _both(spark, sf_dir)
    gone = numbered(b, "id").withColumn("n", F.col("n") - 1).join(p.select("id"), "id", "left_anti")
    return reconcile.missing_runs(gone, width=128)


@query("missing_run_summary", f"""{_RUNS} SELECT 'runs' AS metric, count(*)::BIGINT AS value FROM runs UNION ALL SELECT 'long_runs', count(*) FILTER (ids >= 100) FROM runs
    UNION ALL SELECT 'ids_in_long_runs', coalesce(sum(ids) FILTER (ids >= 100), 0)::BIGINT FROM runs UNION ALL SELECT 'run ' || first || '-' || last, ids FROM (SELECT * FROM runs ORDER BY ids DESC, first LIMIT 10)""")  # fmt: skip
def missing_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.run_summary(cut(missing_runs(spark, sf_dir), "runs"))


# Publishing: updates for orders and unknown ids; every 7th repeats what is there, every 11th is blank, every 13th comes twice.
_UPDATES = """u AS (SELECT CASE WHEN o_orderkey % 17 = 0 THEN -o_orderkey ELSE o_orderkey END AS id, CASE WHEN o_orderkey % 11 = 0 THEN ' ' WHEN o_orderkey % 7 = 0 THEN o_orderpriority ELSE 'new' END AS o_orderpriority,
    CASE WHEN o_orderkey % 7 = 0 THEN o_orderstatus ELSE 'Z' END AS o_orderstatus, o_orderkey AS k FROM orders WHERE o_orderkey % 3 = 0)"""
_OUTCOMES = _UPDATES + """, o AS (SELECT id, CASE WHEN k % 13 = 0 THEN 'conflict' WHEN k % 11 = 0 THEN 'empty' WHEN id < 0 OR k NOT IN (SELECT id FROM published) THEN 'not_found' WHEN k % 7 = 0 THEN 'noop' ELSE 'updated' END AS outcome, o_orderpriority, o_orderstatus FROM u)"""


def _updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").filter(k % 3 == 0).select(
        F.when(k % 17 == 0, -k).otherwise(k).alias("id"), F.when(k % 11 == 0, " ").when(k % 7 == 0, F.col("o_orderpriority")).otherwise("new").alias("o_orderpriority"),
        F.when(k % 7 == 0, F.col("o_orderstatus")).otherwise("Z").alias("o_orderstatus"), F.explode(F.sequence(F.lit(0), F.when(k % 13 == 0, 1).otherwise(0))).alias("n"),
    )
    return rows.drop("n")


_FIELDS = ["o_orderpriority", "o_orderstatus"]


@query("merge_update_only", f"WITH {ctes('published')}, {_OUTCOMES} SELECT p.id, CASE WHEN o.id IS NULL THEN p.o_orderpriority ELSE o.o_orderpriority END AS o_orderpriority, CASE WHEN o.id IS NULL THEN p.o_orderstatus ELSE o.o_orderstatus END AS o_orderstatus FROM published p LEFT JOIN (SELECT * FROM o WHERE outcome IN ('updated', 'noop')) o ON o.id = p.id")
def merge_update_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.merged(table(spark, sf_dir, "published"), _updates(spark, sf_dir), _FIELDS).select("id", *_FIELDS)


@query("merge_overwrite", f"WITH {ctes('published')}, {_UPDATES}, o AS (SELECT * FROM u WHERE k % 13 <> 0) SELECT p.id, coalesce(o.o_orderpriority, p.o_orderpriority) AS o_orderpriority, coalesce(o.o_orderstatus, p.o_orderstatus) AS o_orderstatus FROM published p LEFT JOIN o ON o.id = p.id")
def merge_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates with an empty value overwrite too."""
    return publish.merged(table(spark, sf_dir, "published"), _updates(spark, sf_dir), _FIELDS, skip_empty=False).select("id", *_FIELDS)


@query("merge_outcomes", f"WITH {ctes('published')}, {_OUTCOMES} SELECT id, outcome FROM o")
def merge_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.outcomes(table(spark, sf_dir, "published"), _updates(spark, sf_dir), _FIELDS)


@query("merge_gate", f"WITH {ctes('published')}, {_OUTCOMES}, c AS (SELECT count(*) FILTER (outcome = 'updated') AS updated, count(*) FILTER (outcome = 'noop') AS noop, count(*) FILTER (outcome = 'not_found') AS not_found, count(*) FILTER (outcome = 'conflict') AS conflict, count(*) FILTER (outcome = 'empty') AS empty FROM o) SELECT *, updated + noop + not_found + conflict AS sent, updated + noop AS applied, CASE WHEN updated + noop = 0 OR not_found + conflict > floor(0.05 * (updated + noop + not_found + conflict)) THEN 'fail' ELSE 'pass' END AS status FROM c")
def merge_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.merge_gate(merge_outcomes(spark, sf_dir), verify.Tolerance(fraction=0.05))


@query("generation_copy", "SELECT o_orderkey AS id, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, NULL::VARCHAR AS category FROM orders")
def generation_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "generation")
    publish.copy_generation(table(spark, sf_dir, "built"), path, "category", "string")
    return spark.read.parquet(path)


@query("copy_gate", f"""WITH {_PB}, c AS (SELECT (SELECT count(*) FROM built) AS source_rows, (SELECT count(*) FROM published) AS copied_rows, (SELECT count(*) FROM built WHERE id NOT IN (SELECT id FROM published)) AS missing)
    SELECT allowed, source_rows, copied_rows, missing, CASE WHEN missing > floor(allowed * source_rows) OR copied_rows > source_rows OR copied_rows = 0 THEN 'fail' ELSE 'pass' END AS status FROM c, (SELECT unnest([0.0, 0.5])::DOUBLE AS allowed)""")  # fmt: skip
def copy_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, b = _both(spark, sf_dir)
    rows = [publish.copy_gate(b, p, verify.Tolerance(fraction=x)).withColumn("allowed", F.lit(x)) for x in (0.0, 0.5)]
    return rows[0].union(rows[1])


_MERGED = f"""final AS (SELECT p.id, p.o_custkey, CASE WHEN o.id IS NULL THEN p.o_orderstatus ELSE o.o_orderstatus END AS o_orderstatus, p.o_totalprice, CASE WHEN o.id IS NULL THEN p.o_orderpriority ELSE o.o_orderpriority END AS o_orderpriority
    FROM published p LEFT JOIN (SELECT * FROM o WHERE outcome IN ('updated', 'noop')) o ON o.id = p.id),
last AS (SELECT id, o_custkey, o_orderstatus, o_totalprice, CASE WHEN id < 40 THEN 'late' ELSE o_orderpriority END AS o_orderpriority FROM final)"""


def _merged_twice(spark: SparkSession, sf_dir: str) -> Generations:
    """The published orders in generations: all updates, then those of a few ids."""
    table_ = Generations(spark, scratch(spark, "orders"), buckets=64)
    table_.create(table(spark, sf_dir, "published"))
    table_.merge(_updates(spark, sf_dir), _FIELDS, verify.Tolerance(fraction=1.0))
    table_.merge(table_.read().filter("id < 40").select("id", F.lit("late").alias("o_orderpriority")), ["o_orderpriority"])
    return table_


@query("merge_generations", f"WITH {ctes('published')}, {_OUTCOMES}, {_MERGED} SELECT 2 AS generation, id, o_orderpriority, o_orderstatus FROM last UNION ALL SELECT 1, id, o_orderpriority, o_orderstatus FROM final UNION ALL SELECT 0, id, o_orderpriority, o_orderstatus FROM published")
def merge_generations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each generation is there to read, whole, after the merges."""
    table_ = _merged_twice(spark, sf_dir)
    parts = [table_.read(g).select(F.lit(g).alias("generation"), "id", *_FIELDS) for g in (0, 1, 2)]
    return parts[0].union(parts[1]).union(parts[2])


@query("generation_diff", f"WITH {ctes('published', 'built')}, {_OUTCOMES}, {_MERGED} SELECT b.id, CASE WHEN l.id IS NULL THEN 'missing' ELSE 'changed' END AS side FROM built b LEFT JOIN last l ON l.id = b.id WHERE l.id IS NULL OR l.o_orderpriority IS DISTINCT FROM b.o_orderpriority OR l.o_orderstatus IS DISTINCT FROM b.o_orderstatus")
def generation_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged table against the build, each in generations."""
    built = Generations(spark, scratch(spark, "built"), buckets=64)
    built.create(table(spark, sf_dir, "built"))
    return _merged_twice(spark, sf_dir).diff(built)


@query("local_diff", f"WITH {_PB} SELECT id, 'missing' AS side FROM built WHERE id NOT IN (SELECT id FROM published) UNION ALL SELECT id, 'changed' FROM published WHERE id % 1000 = 7")
def local_diff_(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published orders, some with another price, against the built ones."""
    p, b = _both(spark, sf_dir)
    return local_diff(p.withColumn("o_totalprice", F.when(F.col("id") % 1000 == 7, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))), b)
