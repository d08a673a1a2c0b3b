"""Queries of the graph, curation, addressing and audits, with their oracles."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfspark.operators import address, audits, curate, graph
from shelfspark.plans.adapters import ctes, table, tag_count
from shelfspark.session import cut, parts_for

QUERIES: dict = {}
ORACLES: dict = {}
CAP = 6
#: Parts that only filter a written one.
FILTERS = ("accepted", "eligible")
#: Parts that lie in buckets of the product.
BY_PRODUCT = ("marked",)

_label = lambda names: f"replace(coalesce({', '.join(f'upper(left(nullif(trim({n}), {chr(39) * 2}), 1)) || substr(trim({n}), 2)' for n in names)}, CASE WHEN w = '' THEN id ELSE upper(left(w, 1)) || substr(w, 2) END), '/', ' ')"
GRAPH = ctes("nodes", "edges") + f""", labels AS (SELECT id, {_label(['en'])} AS label, {_label(['fr', 'en'])} AS label_fr
    FROM (SELECT *, trim(translate(regexp_replace(id, '^[^:]*:', ''), '-_', '  ')) AS w FROM nodes)),
roots AS (SELECT id FROM nodes WHERE id NOT IN (SELECT child FROM edges)),
walk AS (SELECT id, 0 AS depth, [id] AS path FROM roots UNION ALL SELECT child, depth + 1, list_append(path, child) FROM walk JOIN edges ON parent = walk.id),
depths AS (SELECT id, min(depth) AS depth FROM walk GROUP BY id),
canon AS (SELECT d.id, d.depth, (SELECT arg_min(p.id, (p.depth, p.id)) FROM edges e JOIN depths p ON e.parent = p.id WHERE e.child = d.id AND p.depth < d.depth) AS parent FROM depths d),
chains AS (SELECT id, [id] AS path FROM canon WHERE parent IS NULL UNION ALL SELECT c.id, list_append(chains.path, c.id) FROM canon c JOIN chains ON c.parent = chains.id),
addresses AS (SELECT w.id, w.path, w.path = c.path AS is_primary, row_number() OVER (PARTITION BY w.id ORDER BY w.path = c.path DESC, len(w.path), w.path) AS address_rank
    FROM (SELECT DISTINCT id, path FROM walk) w JOIN chains c USING (id)),
steps AS (SELECT id, address_rank, step, path[step + 1] AS node FROM (SELECT *, unnest(range(len(path))) AS step FROM addresses)),
rendered AS (SELECT s.id, address_rank, step, node, string_agg(label, '/') OVER (PARTITION BY s.id, address_rank ORDER BY step) AS path FROM steps s JOIN labels l ON l.id = s.node),
eligible AS (SELECT id FROM nodes WHERE split_part(id, ':', 1) IN ('en', 'xx'))"""  # fmt: skip
CURATED = ctes("tags", "alias", "drop_tags").removeprefix(ctes("edges").split("), edges")[0] + "), ") + """,
renamed AS (SELECT product, pos, tag AS raw, coalesce("to", t.tag) AS tag, sum(CASE WHEN "to" IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY product) AS aliased FROM tags t LEFT JOIN alias USING (tag)),
firsts AS (SELECT * FROM renamed QUALIFY row_number() OVER (PARTITION BY product, tag ORDER BY pos) = 1),
curated AS (SELECT product, pos, tag, raw, aliased, CASE WHEN tag IN (SELECT tag FROM drop_tags) THEN 'curated_drop' WHEN tag IN (SELECT id FROM eligible) THEN 'accepted'
    WHEN tag IN (SELECT id FROM nodes) THEN 'out_of_language' ELSE 'not_in_taxonomy' END AS status FROM firsts),
accepted AS (SELECT * FROM curated WHERE status = 'accepted')"""  # fmt: skip
ADDRESSED = """,
present AS (SELECT a.product, a.tag, c.path FROM (SELECT DISTINCT product, tag FROM accepted) a JOIN chains c ON c.id = a.tag),
covered AS (SELECT DISTINCT product, unnest(path[1:len(path) - 1]) AS tag FROM present),
open_ AS (SELECT p.*, c.tag IS NULL AS free FROM present p LEFT JOIN covered c USING (product, tag)),
leaves AS (SELECT product, tag, path, row_number() OVER (PARTITION BY product ORDER BY len(path) DESC, tag) AS leaf_rank FROM (SELECT *, bool_or(free) OVER (PARTITION BY product) AS any_free FROM open_) WHERE free OR NOT any_free),
pairs AS (SELECT product, node, r.path, min((leaf_rank, address_rank, step)) AS spot FROM leaves l JOIN rendered r ON r.id = l.tag GROUP BY ALL),
unions AS (SELECT product, node, path, spot[1] = 1 AND spot[2] = 1 AS is_primary, row_number() OVER (PARTITION BY product ORDER BY spot, node, path) AS ord FROM pairs),
strings AS (SELECT product, path, is_primary, row_number() OVER (PARTITION BY product ORDER BY o) AS ord FROM (SELECT product, path, min(ord) AS o, bool_or(is_primary) AS is_primary FROM unions GROUP BY ALL))"""  # fmt: skip
ENTRIES = """,
labelled AS (SELECT product, pos, tag, label FROM accepted JOIN labels ON labels.id = tag WHERE lower(trim(label)) NOT IN ('undefined', 'unknown', 'null', 'none', 'n/a', 'na', '') QUALIFY row_number() OVER (PARTITION BY product, label ORDER BY pos) = 1)"""  # fmt: skip
CAPPED = f""",
reserved AS (SELECT DISTINCT product, unnest(path) AS tag FROM leaves WHERE leaf_rank = 1 UNION SELECT product, arg_min(tag, pos) FROM accepted GROUP BY product),
marked AS (SELECT l.*, r.tag IS NOT NULL AS reserved FROM labelled l LEFT JOIN reserved r USING (product, tag)),
capped AS (SELECT product, pos, tag, label, reserved, eligible <= {CAP} OR reserved OR place <= {CAP} - held AS kept, eligible, greatest(0, held - {CAP}) AS chain_over_cap
    FROM (SELECT *, count(*) OVER (PARTITION BY product) AS eligible, sum(reserved::INT) OVER (PARTITION BY product) AS held,
          sum((NOT reserved)::INT) OVER (PARTITION BY product ORDER BY pos) AS place FROM marked))"""  # fmt: skip


def examples_sql(union: str, named: str, k: int) -> str:
    """``block, metric, value`` of the first ``k`` of each kind."""
    several = lambda block, key, value, rows: f"(SELECT '{block}' AS block, {key} AS metric, string_agg({value}, ' | ' ORDER BY {value}) AS value FROM (SELECT DISTINCT {key}, {value} FROM {rows}) GROUP BY {key} HAVING count(*) > 1 ORDER BY {key} LIMIT {k})"
    return " UNION ALL ".join([
        several("conflicting addresses", "node", "path", f"{union} WHERE is_primary"), several("conflicting labels", "node", "label", named),
        several("shared labels", "label", "node", named), several("several addresses", "node", "path", union),
    ])


def query(name: str, oracle: str | None = None):
    def add(f):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = "WITH RECURSIVE " + oracle
        return f

    return add


class Catalog:
    """What the queries share, each part built once when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir, self.made = spark, sf_dir, {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in self.made:
            made = getattr(self, f"_{name}")()
            self.made[name] = made if name in FILTERS else cut(made, name, by="product", buckets=self.parts) if name in BY_PRODUCT else cut(made, name)
        return self.made[name]

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    def _nodes(self):
        return self.table("nodes")

    def _edges(self):
        return self.table("edges")

    def _canon(self):
        return graph.canonical(self.nodes, self.edges)

    def _chains(self):
        return graph.ancestry(self.canon)

    def _places(self):
        return graph.intervals(self.chains)

    def _counts(self):
        return graph.address_counts(self.nodes, self.edges, self.canon)

    def _addresses(self):
        return graph.addresses(self.nodes, self.edges, self.canon, chains=self.chains)

    def _labels(self):
        return self.nodes.select("id", graph.display_label(F.col("id"), [F.col("en")]).alias("label"))

    def _forms(self):
        return graph.forms(self.addresses, self.labels)

    @cached_property
    def parts(self) -> int:
        """Partitions of tables with a row a tag."""
        return parts_for(self.spark, tag_count(self.spark, self.sf_dir))

    def _vocab(self):
        return curate.vocabulary(self.nodes)

    def _eligible(self):
        return self.vocab.filter("eligible").select("id")

    def _curated(self):
        return curate.curate(self.table("tags"), self.table("alias"), self.table("drop_tags"), self.vocab, partitions=self.parts)

    def _facts(self):
        return curate.facts(self.vocab, self.places, self.labels)

    def _marked(self):
        return curate.curate(self.table("tags"), self.table("alias"), self.table("drop_tags"), self.facts, partitions=self.parts)

    def _accepted(self):
        return self.marked.filter("status = 'accepted'")

    @property
    def placed(self) -> DataFrame:
        """Accepted tags with their facts, repeats among them, by product; not written, for a query that reads them once."""
        if "marked" in self.made:
            return self.accepted
        rows = curate.classified(self.table("tags"), self.table("alias"), self.table("drop_tags"), self.facts)
        return rows.filter("status = 'accepted'").repartition(self.parts, "product")

    def sharing(self) -> Catalog:
        """For a query that reads tags more than once: they are written, and ``placed`` reads them."""
        self.marked  # noqa: B018
        return self

    def _leaves(self):
        return address.placed_leaves(self.placed)

    @property
    def primary(self) -> DataFrame:
        return address.primary_leaves(self.placed)

    @property
    def heads(self) -> DataFrame:
        """``product, chain`` with the head of the primary chain alone."""
        return address.primary_chain(self.primary, self.chains.withColumn("path", F.slice("path", 1, 1)))

    def gathered(self, *facts: str) -> DataFrame:
        address.require_addresses(self.leaves, self.addresses)
        return address.gathered(self.leaves, self.forms.select("id", *facts), parts_for(self.spark, self.leaves.count(), address.LEAVES_A_TASK))

    def known(self, whole: Column | None = None) -> DataFrame:
        """The entries of all products' unions."""
        address.require_addresses(self.leaves, self.addresses)
        return cut(address.known(self.leaves if whole is None else self.leaves.withColumn("whole", whole), self.forms), "known")

    @property
    def entries(self) -> DataFrame:
        return curate.label_entries(self.placed).select("product", "pos", "tag", "label")

    @property
    def capped(self) -> DataFrame:
        return curate.capped_at_once(self.placed, CAP)


def catalog(f):
    return lambda spark, sf_dir: f(Catalog(spark, sf_dir))


query("valid_edges", f"{GRAPH} SELECT DISTINCT child, parent FROM edges")(catalog(lambda c: graph.valid_edges(c.nodes, c.edges)))
query("global_roots", f"{GRAPH} SELECT id FROM roots")(catalog(lambda c: graph.global_roots(c.nodes, c.edges)))
query("node_depth", f"{GRAPH} SELECT id, depth FROM depths")(catalog(lambda c: graph.depths(c.nodes, c.edges)))
query("canonical_parent", f"{GRAPH} SELECT id, depth, parent FROM canon")(catalog(lambda c: c.canon))
query("ancestry", f"{GRAPH} SELECT id, list_aggregate(path, 'string_agg', '>') AS path FROM chains")(catalog(lambda c: c.chains.select("id", F.array_join("path", ">").alias("path"))))
query("all_addresses", f"{GRAPH} SELECT id, address_rank, list_aggregate(path, 'string_agg', '>') AS path, is_primary FROM addresses")(
    catalog(lambda c: c.addresses.select("id", "address_rank", F.array_join("path", ">").alias("path"), "is_primary"))
)
query("address_breaker", f"{GRAPH} SELECT id, count(*) AS addresses FROM addresses GROUP BY id HAVING count(*) > 5")(catalog(lambda c: c.counts.filter("addresses > 5").select("id", "addresses")))
query("address_stats", f"""{GRAPH} SELECT count(*) AS nodes, count(*) FILTER (n > 1) AS multi_address_nodes, max(n) AS max_addresses, sum(n)::BIGINT AS addresses
    FROM (SELECT count(*) AS n FROM addresses GROUP BY id)""")(catalog(lambda c: graph.address_stats(c.counts)))  # fmt: skip
query("address_counts", f"{GRAPH} SELECT id, count(*) AS addresses, max(len(path)) - 1 AS longest FROM addresses GROUP BY id")(catalog(lambda c: c.counts))
query("path_bound", f"""{GRAPH} SELECT count(*) AS paths FROM addresses WHERE id IN (SELECT unnest(path) FROM addresses WHERE id IN (SELECT id FROM eligible))""")(
    catalog(lambda c: graph.path_bound(c.counts, graph.ancestors(c.edges, c.eligible)))
)
query("forest_places", f"""{GRAPH} SELECT c.id, row_number() OVER (ORDER BY c.path) AS enter, row_number() OVER (ORDER BY c.path) + size - 1 AS leave, len(c.path) AS length
    FROM chains c JOIN (SELECT unnest(path) AS id, count(*) AS size FROM chains GROUP BY 1) USING (id)""")(catalog(lambda c: c.places))  # fmt: skip
query("display_label", f"{GRAPH} SELECT id, label, label_fr FROM labels")(
    catalog(lambda c: c.nodes.select("id", graph.display_label(F.col("id"), [F.col("en")]).alias("label"), graph.display_label(F.col("id"), [F.col("fr"), F.col("en")]).alias("label_fr")))
)
query("path_ceiling", f"{GRAPH} SELECT count(DISTINCT path) AS distinct_paths FROM rendered WHERE id IN (SELECT id FROM eligible)")(catalog(lambda c: graph.path_ceiling(c.addresses, c.labels, c.eligible)))


@query("phantom_roots", f"{ctes('nodes', 'edges')} SELECT concat('en:n', n_nationkey) AS id FROM nation WHERE n_regionkey = 1")
@catalog
def phantom_roots(c: Catalog) -> DataFrame:
    kept = graph.without(c.nodes, ["en:r1"])
    return graph.phantom_roots(graph.canonical(kept, c.edges), c.nodes, c.edges)


@query("many_cycles", f"""ring AS (SELECT o_orderkey // 5 AS ring, o_orderkey % 5 AS k, concat('en:a', o_orderkey // 5, '-', o_orderkey % 5) AS id FROM orders),
    least AS (SELECT ring, min(id) AS top, arg_min(k, id) AS top_k, count(*) AS n FROM ring GROUP BY ring),
    step AS (SELECT *, row_number() OVER (PARTITION BY ring ORDER BY k) - 1 AS spot, lag(id) OVER (PARTITION BY ring ORDER BY k) AS before, last_value(id) OVER (PARTITION BY ring ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last FROM ring),
    placed AS (SELECT id, ring, (spot - (SELECT s.spot FROM step s WHERE s.id = top) + n) % n AS depth, coalesce(before, last) AS parent FROM step JOIN least USING (ring))
    SELECT id, depth::INT AS depth, CASE WHEN depth > 0 THEN parent END AS parent FROM placed
    UNION ALL SELECT concat('en:c', o_custkey, '-', o_orderkey), (depth + 1)::INT, id FROM orders JOIN placed ON id = concat('en:a', o_orderkey // 5, '-', o_orderkey % 5)""")  # fmt: skip
@catalog
def many_cycles(c: Catalog) -> DataFrame:
    """A ring for every five order keys, each with its least id on top, and a customer's node under each order."""
    ring = cut(c.table("orders").select(F.expr("o_orderkey div 5").alias("ring"), (F.col("o_orderkey") % 5).alias("k"), "o_custkey", "o_orderkey"), "ring")
    name = F.concat(F.lit("en:a"), "ring", F.lit("-"), "k")
    by = Window.partitionBy("ring").orderBy("k")
    last = F.last("id").over(by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    rows = ring.withColumn("id", name).withColumn("parent", F.coalesce(F.lag("id").over(by), last))
    edges = rows.select(F.col("id").alias("child"), "parent").union(rows.select(F.concat(F.lit("en:c"), "o_custkey", F.lit("-"), "o_orderkey"), "id"))
    edges = cut(edges, "edges")
    return graph.canonical(edges.select(F.col("child").alias("id")), edges)


@query("cycle_break", """a AS (SELECT concat('en:a', r_regionkey) AS id, (5 - r_regionkey) % 5 AS depth, concat('en:a', (r_regionkey + 1) % 5) AS parent, r_regionkey FROM region)
    SELECT id, depth, CASE WHEN depth > 0 THEN parent END AS parent FROM a
    UNION ALL SELECT concat('en:n', n_nationkey), depth + 1, id FROM nation JOIN a ON n_regionkey = r_regionkey
    UNION ALL SELECT concat('en:s', s_suppkey), depth + 2, concat('en:n', s_nationkey) FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN a ON n_regionkey = r_regionkey""")  # fmt: skip
@catalog
def cycle_break(c: Catalog) -> DataFrame:
    ring = c.table("region").select(F.concat(F.lit("en:a"), "r_regionkey").alias("id"), F.concat(F.lit("en:a"), (F.col("r_regionkey") + 1) % 5).alias("parent"))
    low = c.edges.filter("child LIKE 'en:n%' OR child LIKE 'en:s%'").withColumn("parent", F.regexp_replace("parent", "^en:r", "en:a"))
    edges = ring.select(F.col("id").alias("child"), "parent").union(low)
    return graph.canonical(edges.select(F.col("child").alias("id")), edges)


query("vocabulary", f"{GRAPH} SELECT id, split_part(id, ':', 1) IN ('en', 'xx') AS eligible FROM nodes")(catalog(lambda c: c.vocab))
query("curate_tags", f"{GRAPH}, {CURATED} SELECT product, pos, tag, raw, aliased::BIGINT AS aliased, status FROM curated")(catalog(lambda c: c.curated))
query("label_entries", f"{GRAPH}, {CURATED}{ENTRIES} SELECT product, pos, tag, label FROM labelled")(catalog(lambda c: c.entries))
query("tag_cap", f"{GRAPH}, {CURATED}{ADDRESSED}{ENTRIES}{CAPPED} SELECT product, pos, tag, label, reserved, kept, eligible, chain_over_cap::BIGINT AS chain_over_cap FROM capped")(catalog(lambda c: c.capped))
query("product_leaves", f"{GRAPH}, {CURATED}{ADDRESSED} SELECT product, tag, leaf_rank FROM leaves")(catalog(lambda c: address.placed_leaves(c.placed).select("product", "tag", "leaf_rank")))
query("primary_chain", f"{GRAPH}, {CURATED}{ADDRESSED} SELECT product, list_aggregate(path, 'string_agg', '>') AS chain FROM leaves WHERE leaf_rank = 1")(
    catalog(lambda c: address.primary_chain(c.primary, c.chains).select("product", F.array_join("chain", ">").alias("chain")))
)
query("address_union", f"""{GRAPH}, {CURATED}{ADDRESSED} SELECT product, count(*) AS entries, count(*) FILTER (is_primary) AS primary_entries,
    md5(string_agg(node || '=' || path, '|' ORDER BY ord)) AS entries_md5 FROM unions GROUP BY product""")(
    catalog(lambda c: address.unions(c.gathered("paths", "nodes")).select(
        "product", F.size("entries").cast("long").alias("entries"), F.col("lead").cast("long").alias("primary_entries"),
        F.md5(F.array_join(F.transform("entries", lambda x: F.concat(x["node"], F.lit("="), x["path"])), "|").cast("binary")).alias("entries_md5"),
    ))
)
query("address_forms", f"""{GRAPH}, {CURATED}{ADDRESSED} SELECT product, string_agg(path, '|' ORDER BY ord) AS category_path,
    string_agg(path, '|' ORDER BY ord) FILTER (is_primary) AS category_path_primary FROM strings GROUP BY product""")(
    catalog(lambda c: address.path_arrays(c.gathered("told", "lead")).select("product", *[F.array_join(x, "|").alias(x) for x in ("category_path", "category_path_primary")]))
)
query("unanchored", f"""{GRAPH}, {CURATED}{ADDRESSED} SELECT product, head FROM (SELECT product, path[1] AS head FROM leaves WHERE leaf_rank = 1)
    WHERE head NOT IN (SELECT id FROM roots WHERE id <> 'en:r2')""")(catalog(lambda c: address.unanchored(c.heads, graph.global_roots(c.nodes, c.edges).filter("id <> 'en:r2'"))))  # fmt: skip

query("audit_curation", f"""{GRAPH}, {CURATED}, per AS (SELECT product, any_value(aliased) AS aliased, count(*) AS n, count(*) FILTER (status = 'accepted') AS ok FROM curated GROUP BY product)
    SELECT count(*) AS products_with_tags, count(*) FILTER (ok < n) AS products_with_rejected_tags, count(*) FILTER (ok = 0) AS products_with_no_accepted_tag,
    sum(n)::BIGINT AS tag_instances, sum(ok)::BIGINT AS accepted_instances, sum(aliased)::BIGINT AS aliased_instances, (sum(n) - sum(ok))::BIGINT AS rejected_instances,
    round((sum(n) - sum(ok)) / sum(n), 6) AS rejected_rate, (SELECT count(DISTINCT tag) FROM curated WHERE status = 'not_in_taxonomy') AS distinct_unknown_tags FROM per""")(catalog(lambda c: audits.curation(c.curated)))  # fmt: skip
query("top_refused", f"""{GRAPH}, {CURATED} SELECT status, tag, instances, rank FROM (SELECT *, row_number() OVER (PARTITION BY status ORDER BY instances DESC, tag) AS rank
    FROM (SELECT status, tag, count(*) AS instances FROM curated WHERE status <> 'accepted' GROUP BY ALL)) WHERE rank <= 20""")(catalog(lambda c: audits.top_by(c.curated.filter("status <> 'accepted'"), "status", "tag", 20)))  # fmt: skip
query("audit_cap", f"""{GRAPH}, {CURATED}{ADDRESSED}{ENTRIES}{CAPPED} SELECT max(eligible) AS max_eligible, count(DISTINCT product) FILTER (NOT kept) AS products_truncated, count(*) FILTER (NOT kept) AS tags_dropped,
    count(DISTINCT product) FILTER (chain_over_cap > 0 AND eligible > {CAP}) AS products_with_chain_over_cap FROM capped""")(catalog(lambda c: audits.cap(c.capped, CAP)))  # fmt: skip
_OWN = "named AS (SELECT DISTINCT node, split_part(path, '/', -1) AS label FROM unions UNION SELECT tag, label FROM labelled)"
query("audit_conflicts", f"""{GRAPH}, {CURATED}{ADDRESSED}{ENTRIES}, {_OWN}
    SELECT (SELECT count(*) FROM (SELECT node FROM unions WHERE is_primary GROUP BY node HAVING count(DISTINCT path) > 1)) AS address_conflicts,
    (SELECT count(*) FROM (SELECT node FROM named GROUP BY node HAVING count(DISTINCT label) > 1)) AS label_conflicts,
    (SELECT count(*) FROM (SELECT label FROM named GROUP BY label HAVING count(DISTINCT node) > 1)) AS shared_labels""")(catalog(lambda c: audits.conflicts(c.sharing().known(), c.entries)))  # fmt: skip
query("audit_addresses", f"""{GRAPH}, {CURATED}{ADDRESSED}, per AS (SELECT product, count(*) AS n, count(*) FILTER (is_primary) AS p FROM strings GROUP BY product),
    nodes_ AS (SELECT node, count(DISTINCT path) AS n FROM unions GROUP BY node)
    SELECT (SELECT count(*) FROM nodes_ WHERE n > 1) AS nodes_at_several_addresses, (SELECT max(n) FROM nodes_) AS max_addresses, count(*) AS products, count(*) FILTER (n > p) AS products_at_several_addresses,
    (SELECT count(DISTINCT path) FROM strings) AS distinct_paths, round(avg(n), 3) AS mean_paths, max(n) AS max_paths FROM per""")(catalog(lambda c: audits.addresses(c.known(), address.path_arrays(c.gathered("told", "lead")))))  # fmt: skip
query("audit_anchor", f"""{GRAPH}, {CURATED}{ADDRESSED}, bad AS (SELECT product, path[1] AS head FROM leaves WHERE leaf_rank = 1 AND path[1] <> 'en:r0' AND path[1] <> 'en:r1')
    SELECT (SELECT count(*) FROM bad) AS products_unanchored, (SELECT count(DISTINCT head) FROM bad) AS distinct_heads, (SELECT count(*) FROM roots) AS roots,
    (SELECT string_agg(head || '=' || n, ',' ORDER BY n DESC, head) FROM (SELECT head, count(*) AS n FROM bad GROUP BY head ORDER BY n DESC, head LIMIT 20)) AS top_heads""")(
    catalog(lambda c: audits.anchoring(c.heads, c.spark.createDataFrame([("en:r0",), ("en:r1",)], "id string"), graph.global_roots(c.nodes, c.edges)))
)
query("audit_examples", f"""{GRAPH}, {CURATED}{ADDRESSED}{ENTRIES}, u AS (SELECT product, node, path, is_primary OR product % 50 = 0 AS is_primary FROM unions),
    named AS (SELECT DISTINCT node, split_part(path, '/', -1) AS label FROM u UNION SELECT tag, CASE WHEN tag LIKE '%3' THEN label || '!' ELSE label END FROM labelled)
    {examples_sql("u", "named", 5)}
    UNION ALL (SELECT 'unanchored', product::VARCHAR, path[1] FROM leaves WHERE leaf_rank = 1 AND path[1] <> 'en:r0' AND path[1] <> 'en:r1' ORDER BY product LIMIT 5)""")(
    catalog(lambda c: audits.examples(
        c.sharing().known(F.col("product") % 50 == 0), c.entries.withColumn("label", F.when(F.col("tag").endswith("3"), F.concat("label", F.lit("!"))).otherwise(F.col("label"))),
        address.unanchored(c.heads, c.spark.createDataFrame([("en:r0",), ("en:r1",)], "id string")),
    ))
)
