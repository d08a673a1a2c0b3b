"""The whole extraction: raw lines through gates, curation and addressing to documents, and the run's report.

Each part is written once and read by all that follow: lines are parsed once,
tags curated once, and eight audits read what the documents are made of.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from shelfspark.functions import pricing as P
from shelfspark.functions import text as T
from shelfspark.operators import address, audits, curate, gates, graph
from shelfspark.operators import documents as D
from shelfspark.session import cut, meet, parts_for
from shelfspark.sources import products

#: Nutrients by attribute (fixed values).
NUTRIENTS = {
    "Energy (kcal/100g)": "energy-kcal", "Fat (g/100g)": "fat", "Saturated fat (g/100g)": "saturated-fat", "Sugars (g/100g)": "sugars",
    "Salt (g/100g)": "salt", "Protein (g/100g)": "proteins", "Fiber (g/100g)": "fiber",
}
_IMAGES = "map<string, struct<rev: string, imgid: string, sizes: map<string, variant>>>"


@dataclass(frozen=True)
class Settings:
    lang: str = "en"
    max_tags: int = curate.MAX_TAGS
    require_category: bool = True
    require_path: bool = True
    exclude: tuple[str, ...] = ()
    inputs: tuple[tuple[str, str], ...] = ()  # what a run reads, by name, for its report
    pricing: P.PricingConfig = field(default_factory=P.PricingConfig)


@dataclass(frozen=True)
class Taxonomy:
    """The category graph with all that does not depend on a product, built once."""

    chains: DataFrame
    addresses: DataFrame
    labels: DataFrame
    roots: DataFrame
    facts: DataFrame

    @cached_property
    def forms(self) -> DataFrame:
        """Written when first asked for: a run that is only counted has no use for them."""
        return cut(graph.forms(self.addresses, self.labels), "forms")

    @cached_property
    def named(self) -> DataFrame:
        """``id``: the nodes that ``forms`` has, those with a label somewhere on an address."""
        if "forms" in self.__dict__:
            return self.forms.select("id")
        steps = self.addresses.select("id", F.explode("path").alias("node")).distinct()
        return cut(meet(steps, self.labels.select(F.col("id").alias("node")), "node", "left_semi").select("id").distinct(), "named")

    @classmethod
    def of(cls, nodes: DataFrame, edges: DataFrame, labels: DataFrame, settings: Settings) -> Taxonomy:
        """From ``nodes(id)``, ``edges(child, parent)`` and ``labels(id, label)`` in the language of the settings."""
        roots = cut(graph.global_roots(nodes, edges), "roots")
        kept = graph.without(nodes, list(settings.exclude))
        canon = cut(graph.canonical(kept, edges), "canon")
        chains = cut(graph.ancestry(canon), "chains")
        addresses = cut(graph.addresses(kept, edges, canon, chains=chains), "addresses")
        labels = cut(labels.select("id", "label"), "labels")
        facts = curate.facts(curate.vocabulary(nodes, settings.lang, list(settings.exclude)), graph.intervals(chains), labels)
        return cls(chains, addresses, labels, roots, cut(facts, "facts"))


def _number(v: Column) -> Column:
    """A variant if it is a number."""
    kind = F.schema_of_variant(v)
    return F.when((kind == "BIGINT") | (kind == "DOUBLE") | (kind == "FLOAT") | kind.startswith("DECIMAL"), F.try_variant_get(v, "$", "double"))


def _strings(v: Column) -> Column:
    """A list's elements that are strings; null if the variant is no list. Lists of strings alone, and of nulls, are
    cast at once."""
    items = F.filter(F.try_variant_get(v, "$", "array<variant>"), lambda x: F.coalesce(F.schema_of_variant(x) == "STRING", F.lit(False)))
    return F.when(F.schema_of_variant(v) == "ARRAY<STRING>", F.array_compact(F.try_variant_get(v, "$", "array<string>"))).otherwise(F.transform(items, lambda x: x.cast("string")))


_TEXTS = ("lang", "lc", "product_name", "generic_name", "ingredients_text", "brands", "quantity", "serving_size", "countries", "nutrition_grades", "nutriscore_grade", "ecoscore_grade", "environmental_score_grade")


def fields(rows: DataFrame, lang: str, seen: dict[str, Observation] | None = None) -> DataFrame:
    """All that is read of a record, of rows that are ``products.listed``.

    ``seen`` gets figures on the way: of records ``parsed``, ``shown`` by an image, ``told`` of by a text, and so on.
    There a plan's generated code is cut too; in one piece it would be too large to compile."""
    at = lambda df, point, **f: df if seen is None else df.observe(seen.setdefault(point, Observation()), *[c.alias(k) for k, c in f.items()])
    own = {f"{c}_own": f"{c}_{lang}" for c in ("product_name", "generic_name", "ingredients_text")}
    texts = {c: c for c in _TEXTS} | own
    lists = {c: f"{c}_tags" for c in ("categories", "labels", "allergens", "ingredients_analysis")}
    per = {f"{n}_{x}": f"{n}_100g" if x == "n" else f"{n}_unit" for n in NUTRIENTS.values() for x in "nu"}
    # The record becomes a structure in one walk over its fields: taken one by one, each would search them all.
    kinds = {c: "variant" for c in (*texts.values(), *lists.values(), "nova_group")} | {"code": "string", "_id": "string", "images": _IMAGES, "unique_scans_n": "long"}
    kinds["nutriments"] = f"struct<{', '.join(f'`{c}`: variant' for c in per.values())}>"
    rows = rows.select("row", "kind", F.try_variant_get("listed", "$[0]", f"struct<{', '.join(f'`{c}`: {k}' for c, k in kinds.items())}>").alias("r"))
    # Cut off here, so that it is made once, whatever the plan does with projections that follow each other.
    r = F.col("r")
    raw = {c: T.variant_text(r[f]) for c, f in texts.items()} | {c: _strings(r[f]) for c, f in lists.items()}
    raw |= {c: _number(r["nutriments"][f]) if c.endswith("_n") else T.variant_text(r["nutriments"][f]) for c, f in per.items()}
    raw |= {"code": gates.key(r["code"], r["_id"]), "images": r["images"], "nova": _number(r["nova_group"]), "scans": r["unique_scans_n"]}
    rows = at(rows.select("row", "kind", *[x.alias(c) for c, x in raw.items()]), "parsed", records=F.count(F.lit(1)))
    said = F.coalesce(F.nullif("lang", F.lit("")), "lc")
    rows = rows.withColumns({"said": said, "front": F.element_at("images", F.lit(f"front_{lang}"))})
    text = T.language_pick([(F.col(f"{x}_own"), F.col(x)) for x in ("generic_name", "ingredients_text")], F.col("said"), lang)
    title = T.language_pick([(F.col("product_name_own"), F.col("product_name"))], F.col("said"), lang)
    sizes = lambda x: F.coalesce(F.map_keys(x["sizes"]), F.array().cast("array<string>"))
    front = F.col("front")
    url = T.image_url(F.col("code"), T.front_key(F.map_keys("images"), require=lang), F.nullif(front["rev"], F.lit("")), front["imgid"], sizes(front), sizes(F.element_at("images", front["imgid"])), folder=F.col("folder"))
    # One expression for all of them: seven copies of the number format would not compile.
    pairs = F.array(*[F.struct(F.col(f"{n}_n").alias("n"), F.col(f"{n}_u").alias("u")) for n in NUTRIENTS.values()])
    nutrients = F.transform(pairs, lambda x: F.when(x["n"].isNotNull(), T.nutrient(x["n"], x["u"])))
    gone = [f"{n}_{x}" for n in NUTRIENTS.values() for x in "nu"]
    rows = at(rows.withColumns({"nutrients": nutrients, "folder": T.gtin13(F.col("code"))}).drop(*gone), "shown", with_front=F.count_if(front.isNotNull()))
    rows = at(rows.withColumns({"title": title, "text": F.substring(text, 1, T.DESCRIPTION_LENGTH)}), "told", with_title=F.count_if(F.col("title").isNotNull()), with_text=F.count_if(F.col("text").isNotNull()))
    rows = at(rows.withColumns({"title": T.deshout(F.col("title")), "text": T.deshout(F.col("text")), "folder": T.code_folder(F.col("folder"))}), "cased", with_title_and_text=F.count_if(F.col("title").isNotNull() & F.col("text").isNotNull()))
    return rows.select(
        "row", "kind", "code", "title", "text", url.alias("image_url"), F.coalesce("brands", F.lit("")).alias("brand"), "quantity", "serving_size", "countries",
        F.struct(F.col("nutrition_grades").alias("a"), F.col("nutriscore_grade").alias("b")).alias("nutri"), F.struct(F.col("ecoscore_grade").alias("a"), F.col("environmental_score_grade").alias("b")).alias("eco"),
        "nova", "scans", F.coalesce("categories", F.array().cast("array<string>")).alias("tags"), "labels", "allergens", F.col("ingredients_analysis").alias("analysis"),
        F.struct(*[F.col("nutrients")[i].alias(k) for i, k in enumerate(NUTRIENTS)]).alias("nutrients"),
    )


def described(s: Settings, has_taxonomy: bool) -> dict[str, str]:
    """What a run writes, in words: so a report tells its reader what the documents hold."""
    own, plain = f"in {s.lang}", f"in a record whose language is {s.lang}"
    return {
        "lang": s.lang, "category": "required" if s.require_category else "optional", "path": "disabled" if not has_taxonomy else "required" if s.require_path else "optional", "max_tags": str(s.max_tags),
        "title": f"the name {own}, or the plain name {plain}", "text": f"generic name, then ingredients, each {own} or plain {plain}, {T.DESCRIPTION_LENGTH} characters at most", "image": f"the front image {own} by its revision, else the upload",
        "tags": "renamed, then refused unless an eligible node of the taxonomy; records stay" if has_taxonomy else "renamed and dropped by list, not checked", "price": "unit price by bucket with noise by key, premiums by label, rounded to an ending",
        "dietary_restrictions": "words that labels or the analysis of ingredients affirm", "promoted": ", ".join(f"{v}={k}" for k, v in D.PROMOTED.items()),
    }


ROW_GATES = ("bad_json", "missing_code", "missing_title", "missing_desc", "missing_image")
LATER_GATES = ("missing_category", "empty_path", "unanchored_path")
#: How many times as many records as documents a run that stops goes through first, and how many times more after that.
PIECE = 8


class Staged:
    """Lines parsed once, past the gates on rows, and written: what all runs over them share.

    With ``in_order`` rows are numbered in file order, so that runs may be bounded."""

    def __init__(self, lines: DataFrame, settings: Settings = Settings(), in_order: bool = True) -> None:
        lines = products.in_file_order(lines) if in_order else lines.withColumn("row", F.monotonically_increasing_id())
        rows = products.listed(lines).filter("kind <> 'not_object'")
        first = {"bad_json": F.col("kind") == "bad_json", "missing_code": F.col("code").isNull(), "missing_title": F.col("title").isNull(), "missing_desc": F.col("text").isNull(), "missing_image": F.col("image_url").isNull()}
        self.seen: dict[str, Observation] = {"staged": Observation()}
        self.rows = cut(gates.gated(fields(rows, settings.lang, self.seen), first), "staged", self.seen["staged"], read=F.count(F.lit(1)), tags=F.sum(F.size("tags")), **_dropped(ROW_GATES))

    def figure(self, name: str) -> int:
        return int(self.seen["staged"].get[name] or 0)


def _dropped(names: tuple[str, ...]) -> dict[str, Column]:
    return {g: F.count_if(F.coalesce(F.col("drop_reason") == g, F.lit(False))) for g in names}


class Extraction:
    """``documents`` and ``report`` of one run over ``lines(value)``, or over lines that are ``Staged``; alias and drop
    tables as in ``curate``.

    Without a taxonomy tags are renamed and dropped only, there are no paths,
    and the gates on paths are off. ``read`` and ``written`` bound the run in
    file order: no more than the first ``read`` records count, and no record
    after the one that is the ``written``th document; zero is no bound. A run
    that stops at a document goes through the first records, then eight times
    as many, until it is found. Counters of runs that do not stop are observed
    while the tables are written, not read again.
    """

    def __init__(self, lines: DataFrame | Staged, taxonomy: Taxonomy | None, alias: DataFrame, drop: DataFrame, settings: Settings = Settings(), read: int | None = None, written: int | None = None) -> None:
        self.taxonomy, self.settings, self.alias, self.drop, self.bounds = taxonomy, settings, alias, drop, {"read": read, "written": written}
        staged = lines if isinstance(lines, Staged) else Staged(lines, settings, bool(read or written))
        every, self.rows, self.stopped = staged.figure("read"), staged.rows, False
        if read and read < every:
            self.rows, every, self.stopped = self.rows.filter(F.col("row") <= products.nth_row(self.rows.select("row"), read)), read, True
        self.seen = {**staged.seen, "gated": Observation(), "union": Observation()}
        last = None
        # The first pieces that may hold the document; then all.
        size = written * PIECE if written else every
        while size < every:
            piece = self._curated(self.rows.filter(F.col("row") <= products.nth_row(self.rows.select("row"), size)), None)
            if (last := products.nth_row(self._survivors(), written)) is not None:
                self.rows, self.stopped = piece, True
                break
            size *= PIECE
        else:
            self._curated(self.rows, None if self.stopped else staged.figure("tags"))
            if written and (last := products.nth_row(self._survivors(), written)) is not None:
                self.stopped = True
        if last is not None:
            self.rows = self.rows.filter(F.col("row") <= last)
            upto = F.col("product") <= last
            self.state, self.curated, self.accepted, self.leaves, self.chains = (x.filter(upto) for x in (self.state, self.curated, self.accepted, self.leaves, self.chains))
        self.written = self.state.filter("drop_reason IS NULL").drop("drop_reason")
        self.ids = self.written.select("product")

    def _survivors(self) -> DataFrame:
        return self.state.filter("drop_reason IS NULL").select(F.col("product").alias("row"))

    def _curated(self, rows: DataFrame, tags: int | None) -> DataFrame:
        """``rows``, of which curation, leaves, chains and the later gates are written."""
        taxonomy, settings, spark = self.taxonomy, self.settings, rows.sparkSession
        passed = rows.filter("drop_reason IS NULL").withColumnRenamed("row", "product")
        # A part of these holds so many tags, however many there are; all tables by product have as many buckets.
        if tags is None:
            tags = rows.agg(F.sum(F.size("tags"))).first()[0] or 0
        self.parts = parts = parts_for(spark, tags)
        self.curated = cut(curate.curate(curate.tag_rows(passed), self.alias, self.drop, taxonomy and taxonomy.facts, list(settings.exclude), parts).drop("raw"), "curated", by="product", buckets=parts)
        self.accepted = self.curated.filter("status = 'accepted'").drop("aliased", "status")
        some = self.accepted.groupBy("product").agg(F.lit(True).alias("has_category"))
        if taxonomy is None:
            none = spark.createDataFrame([], "product long, tag string, leaf_rank int, chain array<string>")
            self.leaves, self.chains = none.select("product", "tag", "leaf_rank"), none.select("product", "chain")
            self.heads = none.select("product", F.col("tag").alias("head"))
        else:
            self.leaves = cut(address.placed_leaves(self.accepted), "leaves", by="product", buckets=parts)
            address.require_addresses(self.leaves, taxonomy.addresses)
            chains = address.primary_chain(self.leaves, taxonomy.chains)
            past = chains.join(some, "product", "left_semi") if settings.require_category else chains
            self.chains = cut(past.repartition(parts, "product"), "chains", by="product", buckets=parts)
            self.heads = address.unanchored(self.chains, taxonomy.roots)
        later = {"missing_category": F.lit(settings.require_category) & F.col("has_category").isNull(), "empty_path": F.col("chain").isNull(), "unanchored_path": F.col("head").isNotNull()}
        later = gates.path_checks(later, taxonomy is not None and settings.require_path)
        # The records move by product once; what they meet here and later lies in buckets of it. They are wide and not
        # sorted: a bucket's products are hashed.
        dealt = passed.drop("tags").repartition(parts, "product")
        state = dealt.join(some.hint("shuffle_hash"), "product", "left").join(self.chains.hint("shuffle_hash"), "product", "left").join(self.heads.hint("shuffle_hash"), "product", "left")
        self.seen["gated"] = Observation()
        self.state = cut(gates.gated(state.drop("drop_reason"), later).drop("has_category", "head"), "gated", self.seen["gated"], by="product", buckets=parts, written=F.count_if(F.col("drop_reason").isNull()), **_dropped(LATER_GATES))
        return rows

    @cached_property
    def found(self) -> DataFrame:
        """The written products' addresses, gathered; written when first asked for."""
        if self.taxonomy is None:
            return self.rows.sparkSession.createDataFrame([], "product long, told string, lead int")
        own = self.leaves.join(self.ids, "product", "left_semi")
        return cut(address.told(address.gathered(own, self.taxonomy.forms.select("id", "told", "lead"), self.parts)), "found", self.seen["union"], by="product", buckets=self.parts, with_category_path=F.count(F.lit(1)))

    @cached_property
    def capped(self) -> DataFrame:
        """The written products' entries under the cap; written when first asked for."""
        accepted = self.accepted.join(self.ids, "product", "left_semi")
        if self.taxonomy is None:
            labels = accepted.select(F.col("tag").alias("id")).distinct().withColumn("label", graph.display_label(F.col("id"), []))
            capped = curate.capped(curate.label_entries(accepted, labels).repartition(self.parts, "product"), curate.reserved_tags(accepted, self.chains), self.settings.max_tags)
        else:
            capped = curate.capped_at_once(accepted, self.settings.max_tags)
        return cut(capped, "capped", by="product", buckets=self.parts)

    @property
    def documents(self) -> DataFrame:
        """The documents, one row a written product; all fields of the schema."""
        none = F.array().cast("array<string>")
        flat = self.capped.filter("kept").groupBy("product").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "label"))), lambda x: x["label"]).alias("taxonomy_tags"))
        rows = self.written.join(flat.hint("shuffle_hash"), "product", "left").join(address.listed_paths(self.found), "product", "left")
        rows = rows.withColumns({c: F.coalesce(c, none) for c in ("taxonomy_tags", "category_path", "category_path_primary")})
        rows = rows.withColumns({"id": T.gtin13(F.col("code")), "primary_label": F.get("taxonomy_tags", F.lit(0)), "dietary_restrictions": T.dietary(F.col("labels"), F.col("analysis"))})
        rows = rows.withColumn("hay", P.haystack(F.col("primary_label"), F.col("taxonomy_tags"), F.col("title"))).withColumn("bucket", P.bucket_of(F.col("hay"))).drop("hay")
        rows = P.estimated(rows, F.col("id"), F.col("bucket"), F.col("quantity"), F.col("labels"), F.col("brand"), self.settings.pricing).withColumn("m", P.margin(F.col("bucket"), F.col("labels")))
        attrs = D.attributes({
            "Quantity": T.present(F.col("quantity")), "Serving size": T.present(F.col("serving_size")), "Nutri-Score": D.grade(F.col("nutri.a"), F.col("nutri.b")), "Eco-Score": D.grade(F.col("eco.a"), F.col("eco.b")),
            "NOVA group": D.whole(F.col("nova")), "Allergens": T.clean_tags(F.col("allergens")), "Labels": T.clean_tags(F.col("labels")), "Ingredients analysis": T.clean_tags(F.col("analysis")),
            "Countries": T.present(F.col("countries")), "Category": D.category(F.col("primary_label")), **{k: F.col("nutrients")[k] for k in NUTRIENTS},
            "Dietary restrictions": F.when(F.size("dietary_restrictions") > 0, F.col("dietary_restrictions")), "Pricing bucket": F.col("bucket"), "Estimated unit price": F.col("e.detail"), "Modelled margin": F.col("m.detail"),
            "Unique scans": F.coalesce(F.col("scans"), F.lit(0)).cast("string"),
        })
        rows = rows.withColumns({"attrs": attrs, "description": T.describe(F.col("title"), F.col("text")), "price": F.col("e.price"), "margin": F.col("m.margin"), "popularity": P.popularity(F.col("scans"))})
        return D.project(rows, self.settings.pricing.currency)

    @cached_property
    def counters(self) -> DataFrame:
        """One row: records read, documents written, those with a path, and what each gate dropped."""
        names = ("read", "written", *ROW_GATES, *LATER_GATES, "with_category_path")
        if self.taxonomy is None:
            seen = {"with_category_path": 0}
        elif "found" in self.__dict__:
            seen = self.seen["union"].get
        else:
            # A product has a path if one of its leaves has an address; no union is made for that.
            known = self.taxonomy.named.select(F.col("id").alias("tag"))
            seen = {"with_category_path": meet(self.leaves, known, "tag", "left_semi").select("product").join(self.ids, "product", "left_semi").distinct().count()}
        if self.stopped:
            reasons = self.rows.filter("drop_reason IS NOT NULL").select("drop_reason").union(self.state.select("drop_reason"))
            counts = reasons.agg(F.count("*").alias("read"), F.count_if(F.col("drop_reason").isNull()).alias("written"), *[c.alias(g) for g, c in _dropped((*ROW_GATES, *LATER_GATES)).items()])
            seen = seen | counts.first().asDict()
        else:
            seen = seen | self.seen["staged"].get | self.seen["gated"].get
        return self.rows.sparkSession.range(1).select(*[F.lit(int(seen.get(k) or 0)).cast("long").alias(k) for k in names])

    def counted(self) -> DataFrame:
        """The report's block of counters alone: no union of addresses is made for it."""
        return _unpivoted("counters", self.counters)

    @property
    def report(self) -> DataFrame:
        """``block, metric, value``: counters, and the audits, each over the rows that it is about."""
        blocks = [self.counted(), _unpivoted("curation", audits.curation(self.curated))]
        blocks += [_listed(audits.top_by(self.curated.filter("status <> 'accepted'"), "status", "tag", 20).select(F.concat(F.lit("top "), "status").alias("block"), F.col("tag").alias("metric"), F.col("instances").alias("value")))]
        blocks += [_unpivoted("cap", audits.cap(self.capped, self.settings.max_tags)), _listed(audits.dropped_labels(self.capped))]
        if self.taxonomy is not None:
            entries = self.capped.filter("kept").select("tag", "label").distinct()
            known = cut(address.known(self.leaves.join(self.written.select("product"), "product", "left_semi"), self.taxonomy.forms), "known")
            blocks += [_unpivoted("addresses", audits.addresses(known, address.listed_paths(self.found))), _unpivoted("conflicts", audits.conflicts(known, entries)), _unpivoted("anchoring", audits.anchoring(self.chains, self.taxonomy.roots, self.taxonomy.roots))]
            blocks += [audits.examples(known, entries, address.unanchored(self.chains, self.taxonomy.roots))]
        out = blocks[0]
        for x in blocks[1:]:
            out = out.union(x)
        s = self.settings
        said = described(s, self.taxonomy is not None)
        filters = F.array(*[F.struct(F.lit("filters").alias("block"), F.lit(k).alias("metric"), F.lit(v).alias("value")) for k, v in said.items()])
        out = out.union(self.rows.sparkSession.range(1).select(F.inline(filters)))
        if not s.inputs:
            return out
        inputs = F.array(*[F.struct(F.lit("inputs").alias("block"), F.lit(k).alias("metric"), F.lit(v).alias("value")) for k, v in s.inputs])
        return out.union(self.rows.sparkSession.range(1).select(F.inline(inputs)))


def _listed(rows: DataFrame) -> DataFrame:
    return rows.select("block", "metric", F.col("value").cast("string").alias("value"))


def _unpivoted(block: str, one: DataFrame) -> DataFrame:
    """A row of figures as rows of names and figures."""
    pairs = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("string").alias("value")) for c in one.columns])
    return one.select(F.lit(block).alias("block"), F.inline(pairs))


def write_report(report: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object: metrics by block."""
    blocks = report.groupBy("block").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("metric", F.coalesce("value", F.lit("")))))).alias("m"))
    blocks.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("block", F.to_json("m")))))).alias("value")).write.mode(mode).text(path)
