"""Near duplicates: consistent weighted sampling over TF-IDF shingles, bands, verified links, components.

A text is the weighted set of its shingles of five words: one plus the logarithm
of times in the text, scaled by a damped inverse document frequency. Improved consistent weighted
sampling draws a sample that two texts share with the probability of their
weighted Jaccard similarity; bands of samples propose pairs, and the similarity
itself decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from shelfspark.llm import segment
from shelfspark.llm.rows import id_key, one_of_each
from shelfspark.session import cut, row_batches

WORDS, SIMILARITY = 5, 0.8
#: Bands are drawn from the samples, so that they overlap; a pair at 0.8 is missed about once in 10,000 times.
SAMPLES, BANDS, ROWS = 96, 32, 5
#: Document frequencies are counted in this many buckets; the table has this size at any scale.
BUCKETS, SLICES = 1 << 20, 64
#: Shingles in less than RARE of all documents weigh 1, those in all of them 1 - DAMP.
RARE, DAMP = 0.001, 0.2
#: How many times as many pivots a bucket may have in each round.
GROWTH = 8
ID_BITS = 44
#: Bits of the sketch that rules out pairs whose estimate is so many standard deviations below the similarity; at
#: 0.8 that errs about once in ten million pairs. Without a number there is no sketch and every pair is compared.
SKETCH, DEVIATIONS = 2048, 5.5
_DRAWS = 1 << 16
#: Rows that go to Python at once: executors hold a batch several times over, whole texts or features, and texts have any length.
BATCH = 512
U = np.uint64


def shingle_sets(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each distinct shingle of each text: the text's index, the shingle's hash and how often it is there.

    A text of fewer words has one shingle of all its words; one without words has none.
    """
    cp, at = segment.codepoints(texts)
    starts, _, h = segment.words(cp)
    doc = np.searchsorted(at, starts, side="right") - 1
    n = np.bincount(doc, minlength=len(texts))
    first = np.concatenate(([0], np.cumsum(n)))[:-1]
    factor = segment.mix(np.arange(1, WORDS + 1, dtype=U)) | U(1)
    m = max(0, len(h) - WORDS + 1)
    x = np.zeros(m, U)
    for k in range(WORDS):
        x += h[k : k + m] * factor[k]
    ok = doc[:m] == doc[WORDS - 1 :][:m]
    owner, x = doc[:m][ok], x[ok]
    short = np.flatnonzero((n > 0) & (n < WORDS))
    if len(short):
        y = np.array([np.sum(h[first[d] : first[d] + n[d]] * factor[: n[d]], dtype=U) + U(n[d]) for d in short], U)
        owner, x = np.concatenate((owner, short)), np.concatenate((x, y))
    key = owner.astype(U) << U(ID_BITS) | segment.mix(x) >> U(64 - ID_BITS)
    key.sort()
    if not len(key):
        return np.zeros(0, np.int64), key, np.zeros(0, np.int64)
    edge = np.concatenate(([0], np.flatnonzero(key[1:] != key[:-1]) + 1))
    times = np.diff(np.concatenate((edge, [len(key)])))
    key = key[edge]
    return (key >> U(ID_BITS)).astype(np.int64), key & U((1 << ID_BITS) - 1), times


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts, docs = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        docs += batch.num_rows
        for _, texts in segment.chunks(batch.column(0).to_pylist()):
            counts += np.bincount((shingle_sets(texts)[1] & U(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
    if docs:
        parts = [x.astype(np.int64).tobytes() for x in counts.reshape(SLICES, -1)]
        yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array([docs] * SLICES, pa.int64()), pa.array(parts, pa.binary())], names=["slice", "docs", "counts"])


def _add(rows: pa.Table) -> pa.Table:
    total = np.zeros(BUCKETS // SLICES, np.int64)
    for x in rows["counts"]:
        total += np.frombuffer(x.as_buffer(), np.int64)
    return pa.table([rows["slice"][:1].combine_chunks(), pa.array([sum(rows["docs"].to_pylist())], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["slice", "docs", "counts"])


def weight_table(docs: DataFrame, damp: float = DAMP) -> np.ndarray:
    """The weight of one occurrence by a shingle's bucket, from its document frequency over all documents.

    A bucket's count less the mean count estimates how many documents have its
    commonest shingle; both grow with the corpus, so the table means the same
    at every size.
    """
    schema = "slice int, docs long, counts binary"
    rows = docs.select("text").mapInArrow(_count, schema).groupBy("slice").applyInArrow(_add, schema).orderBy("slice").collect()
    if not rows:
        return np.ones(BUCKETS, np.float32)
    counts, n = np.concatenate([np.frombuffer(r.counts, np.int64) for r in rows]), rows[0].docs
    share = np.clip((counts - counts.mean()) / n, RARE, 1)
    return (1 - damp * (1 - np.log(share) / np.log(RARE))).astype(np.float32)


class Sampler:
    """Improved consistent weighted sampling; r, c and beta come from fixed tables by the shingle's hash."""

    def __init__(self, weights: np.ndarray) -> None:
        rng = np.random.default_rng(20240229)
        self.weights = weights
        self.r, self.c = rng.gamma(2, 1, _DRAWS), rng.gamma(2, 1, _DRAWS)
        self.beta = rng.random(_DRAWS)
        self.usual = self.key(1.0, np.arange(_DRAWS))
        self.factors = segment.mix(np.arange(1, SAMPLES + SKETCH + 1, dtype=U) << U(20)) | U(1)

    def key(self, weight, draw: np.ndarray) -> np.ndarray:
        """The sampling value as the high half of a number that sorts like it."""
        r, beta = self.r[draw], self.beta[draw]
        t = np.floor(np.log(weight) / r + beta)
        a = np.exp(np.log(self.c[draw]) - r * (t - beta + 1))
        return a.astype(np.float32).view(np.uint32).astype(U) << U(32)

    def of(self, ids: np.ndarray, times: np.ndarray) -> np.ndarray:
        return (1 + np.log(times)) * self.weights[(ids & U(BUCKETS - 1)).astype(np.int64)]

    def samples(self, owner: np.ndarray, ids: np.ndarray, weight: np.ndarray, first: int = 0, last: int = SAMPLES) -> tuple[np.ndarray, np.ndarray]:
        """The texts that have shingles, and a row of samples for each: value and shingle in one number."""
        edge = np.concatenate(([0], np.flatnonzero(owner[1:] != owner[:-1]) + 1))
        h = segment.mix(ids)
        low = h & U(0xFFFFFFFF)
        odd = np.flatnonzero(weight != 1)
        out = np.empty((len(edge), last - first), U)
        for k, f in enumerate(self.factors[first:last]):
            draw = (h * f >> U(48)).astype(np.int64)
            key = self.usual[draw]
            if len(odd):
                key[odd] = self.key(weight[odd], draw[odd])
            key |= low
            out[:, k] = np.minimum.reduceat(key, edge)
        return owner[edge], out


def bands(samples: np.ndarray) -> np.ndarray:
    """One number a band: equal where all its samples are. Each sample is in as many bands as any other, or one more."""
    rng = np.random.default_rng(5)
    drawn = np.concatenate([rng.permutation(SAMPLES) for _ in range(-(-BANDS * ROWS // SAMPLES) + 1)])
    which = [drawn[k * ROWS : (k + 1) * ROWS] for k in range(BANDS)]
    out = segment.mix(np.arange(1, BANDS + 1, dtype=U))[None, :].repeat(len(samples), 0)
    for k in range(ROWS):
        out = segment.mix(out + samples[:, [w[k] for w in which]])
    return out.view(np.int64)


def _signatures(weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(weights.value)
        for batch in batches:
            nodes, found = np.zeros(batch.num_rows, np.int64), [None] * batch.num_rows
            has = np.zeros(batch.num_rows, bool)
            for at, texts in segment.chunks(batch.column(2).to_pylist()):
                owner, ids, times = shingle_sets(texts)
                if not len(ids):
                    continue
                docs, samples = sampler.samples(owner, ids, sampler.of(ids, times))
                edge = np.searchsorted(owner, docs)
                nodes[at + docs] = np.add.reduceat(segment.mix(ids * U(0x2545F4914F6CDD1D) + times.astype(U)), edge).view(np.int64)
                has[at + docs] = True
                for d, b in zip(docs.tolist(), bands(samples), strict=True):
                    found[at + d] = b
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(nodes, mask=~has), pa.array(found, pa.list_(pa.int64()))], names=["doc_id", "th", "node", "bands"])

    return run


def _features(weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(weights.value)
        for batch in batches:
            for at, texts in segment.chunks(batch.column(1).to_pylist()):
                owner, ids, times = shingle_sets(texts)
                w = sampler.of(ids, times).astype(np.float32)
                short = (ids >> U(ID_BITS - 32)).astype(np.uint32)  # sorted as the ids are
                edge = np.searchsorted(owner, np.arange(len(texts) + 1))
                parts = [slice(edge[d], edge[d + 1]) for d in range(len(texts))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), pa.array([short[x].tobytes() for x in parts], pa.binary()), pa.array([w[x].tobytes() for x in parts], pa.binary()), pa.array([float(w[x].sum(dtype=float)) for x in parts], pa.float64())], names=["node", "ids", "w", "total"])

    return run


def similarity(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Weighted Jaccard similarity of two sets with sorted ids."""
    if not len(a) or not len(b):
        return 0.0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = b[at] == a
    least = np.minimum(wa[both], wb[at[both]]).sum(dtype=float)
    return float(least / (wa.sum(dtype=float) + wb.sum(dtype=float) - least))


def _verify(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for ia, wa, ib, wb in zip(*(batch.column(k) for k in range(2, 6)), strict=True):
                wa, wb = (np.frombuffer(x.as_buffer(), np.float32) for x in (wa, wb))
                sa, sb = wa.sum(dtype=float), wb.sum(dtype=float)
                fits = min(sa, sb) >= threshold * max(sa, sb)
                out.append(similarity(np.frombuffer(ia.as_buffer(), np.uint32), wa, np.frombuffer(ib.as_buffer(), np.uint32), wb) if fits else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.float64())], names=["a", "b", "similarity"])

    return run


def components(links: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """``node, label`` for every node of ``links(a, b)`` and of ``before``, an earlier result that they extend.

    A node's label is the smallest node that it is joined to. Each round takes
    the smallest label among neighbours and the label's label, so chains halve;
    hubs are combined before they move. Labels only fall, so an unchanged sum
    ends it.
    """
    edges = links.select("a", "b").union(links.select("b", "a"))
    if before is not None:
        edges = edges.union(before.select("node", "label")).union(before.select("label", "node"))

    def written(labels: DataFrame) -> tuple[DataFrame, int | None]:
        """The labels, and their sum as they are written; of no rows there may be none."""
        seen = Observation()
        labels = cut(labels, "labels", seen, total=F.sum(F.col("label").cast("decimal(38,0)")))
        return labels, seen.get.get("total")

    now, total = written(edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node"))
    while total is not None:
        wider = edges.union(now.select("node", "label")).union(now.select("node", "node")).toDF("a", "b")
        last = total
        now, total = written(wider.join(now.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("label")).withColumnRenamed("a", "node"))
        if total == last:
            break
    return now


def pivots_of(now: DataFrame, parts: int) -> DataFrame:
    """By bucket of ``now(key, node, ...)`` its pivots ``ps``: the smallest node of each of ``parts`` parts by hash."""
    best = F.min(F.struct(*[c for c in now.columns if c != "key"])).alias("p")
    if parts == 1:
        return now.groupBy("key").agg(best, F.count("*").alias("n")).filter("n > 1").select("key", F.array("p").alias("ps"))
    some = now.groupBy("key", F.pmod(F.xxhash64("node", F.lit(parts)), F.lit(parts)).alias("part")).agg(best)
    return some.groupBy("key").agg(F.collect_list("p").alias("ps"))


def _explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, 64):
            part, step = batch.slice(k, 64), 1 << 18
            ids = [np.frombuffer(x.as_buffer(), np.int32) for x in part.column(1)]
            w = np.concatenate([np.frombuffer(x.as_buffer(), np.float32) for x in part.column(2)])
            node, ids = np.repeat(part.column(0).to_numpy(), [len(x) for x in ids]), np.concatenate(ids)
            for i in range(0, len(node), step):
                yield pa.RecordBatch.from_arrays([pa.array(node[i : i + step], pa.int64()), pa.array(ids[i : i + step], pa.int32()), pa.array(w[i : i + step], pa.float32())], names=["node", "id", "w"])


def shared_weights(feats: DataFrame) -> DataFrame:
    """``node, total, shared``: a text's weight, and that of its shingles that another of these texts has too."""
    once = feats.select("node", "ids", "w").mapInArrow(_explode, "node long, id int, w float")
    once = once.groupBy("id").agg(F.count("*").alias("n"), F.min("node").alias("node"), F.min("w").alias("w")).filter("n = 1")
    alone = once.groupBy("node").agg(F.sum("w").alias("alone"))
    return feats.select("node", "total").join(alone, "node", "left").select("node", "total", (F.col("total") - F.coalesce("alone", F.lit(0.0))).alias("shared"))


def _sketch(weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(weights.value)
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                ids, w = ([np.frombuffer(x.as_buffer(), kind) for x in part.column(k)] for k, kind in ((1, np.uint32), (2, np.float32)))
                owner = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
                _, samples = sampler.samples(owner, np.concatenate(ids).astype(U), np.concatenate(w).astype(float), SAMPLES, SAMPLES + SKETCH)
                bits = np.packbits((segment.mix(samples) & U(1)).astype(np.uint8), axis=1).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(list(bits), pa.list_(pa.int64()))], names=["node", "sketch"])

    return run


def _alike(p, threshold: float, deviations: float | None):
    """Whether what is known of a row and a pivot allows the similarity: weights, shared weights, and sketches if asked for."""
    near, share = threshold - 1e-6, threshold / (1 + threshold) - 1e-6
    weighs = F.least(p["total"], F.col("total")) >= near * F.greatest(p["total"], F.col("total"))
    weighs = weighs & (F.least(p["shared"], F.col("shared")) >= share * (p["total"] + F.col("total")))
    if deviations is None:
        return weighs
    differ = SKETCH * (1 - threshold) / 2
    most = differ + deviations * float(np.sqrt(differ * (1 - differ / SKETCH)))
    apart = F.aggregate(F.zip_with("sketch", p["sketch"], lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    return weighs & (apart <= most)


def labels_of(members: DataFrame, texts, weights, threshold: float, deviations: float | None = DEVIATIONS) -> DataFrame | None:
    """``node, label`` for all nodes that verified links join, from ``members(key, node)``, the bands' buckets.

    In a round each bucket's pivots are compared with its other members that
    are not joined to them yet; then pivots leave, and so do buckets whose
    members are all joined. A bucket has one pivot first, then up to GROWTH
    times as many in each round, until every pair of a bucket was compared,
    joined or ruled out, and a group of near copies takes about as many pairs
    as it has members.

    After the first round pairs are ruled out by what bounds their similarity,
    the weights of both and how much of it lies on shingles that any other text
    still in a bucket has, which is exact, and by sketches ``deviations`` away,
    which err as said there; None leaves the sketches out. ``texts(nodes)``
    gives the texts of some nodes.
    """
    now, parts, labels, feats = members.withColumn("label", F.col("node")), 1, None, None
    while True:
        pivots = cut(pivots_of(now, parts), "pivots")
        both = now.join(pivots, "key")
        if feats is None:
            both = cut(both, "buckets")
            feats = cut(texts(both.select("node").distinct()).mapInArrow(_features(weights), "node long, ids binary, w binary, total double"), "features")
        fits = lambda p: (p["node"] != F.col("node")) & (p["label"] != F.col("label"))
        met = F.filter("ps", fits if parts == 1 else lambda p: fits(p) & _alike(p, threshold, deviations))
        # A node meets most pivots in several bands; its list, of at most BANDS buckets' pivots, has each once.
        lists = both.select("node", F.transform(met, lambda p: p["node"]).alias("m")).filter(F.size("m") > 0)
        pairs = lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("m"))).alias("m")).select("node", F.explode("m").alias("p"))
        pairs = cut(pairs.select(F.least("node", "p").alias("a"), F.greatest("node", "p").alias("b")).distinct(), "pairs")
        a, b = (feats.select(F.col("node").alias(x), F.col("ids").alias(f"i{x}"), F.col("w").alias(f"w{x}")) for x in "ab")
        found = pairs.join(a, "a").join(b, "b").select("a", "b", "ia", "wa", "ib", "wb")
        links = cut(found.mapInArrow(_verify(threshold), "a long, b long, similarity double").filter(F.col("similarity") >= threshold), "links")
        if not links.isEmpty():
            labels = components(links, labels)
        met_all = pivots.select("key", F.explode("ps").alias("p")).select("key", F.col("p.node").alias("node"))
        rest = (both.drop("ps") if parts == 1 else now).join(met_all, ["key", "node"], "left_anti")
        if labels is not None:
            rest = rest.drop("label").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        open_ = rest.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo != hi").select("key")
        rest = cut(rest.join(open_, "key"), "open")
        if rest.isEmpty():
            return labels
        if parts == 1:
            some = cut(feats.join(rest.select("node").distinct(), "node", "left_semi"), "left")
            able = cut(shared_weights(some).filter(F.col("shared") >= (threshold - 1e-6) * F.col("total")), "weights")
            if deviations is None:
                able = able.withColumn("sketch", F.array().cast("array<long>"))
            else:
                able = able.join(some.join(able.select("node"), "node", "left_semi").select("node", "ids", "w").mapInArrow(_sketch(weights), "node long, sketch array<long>"), "node")
            rest = cut(rest.join(able, "node"), "open")
        now, parts = rest.select("key", "node", "label", "total", "shared", "sketch"), parts * GROWTH


def near_classes(docs: DataFrame, threshold: float = SIMILARITY, damp: float = DAMP, deviations: float | None = DEVIATIONS) -> DataFrame:
    """One row per document: ``doc_id, class_id, class_size, kept`` (and ``th``, the text's hash).

    Texts of one class are joined by links of weighted Jaccard similarity of at
    least ``threshold`` between different texts, or have equal shingles.
    ``class_id`` is the smallest doc_id in the class, null ids last; ``kept``
    marks its row, one of repeated rows. Texts without words, null too, are
    classes of their own. An empty table gives an empty result. Words are
    ``[^\\x20\\x09-\\x0D]+`` as they stand; texts are read whole.

    ``damp`` is how much less a shingle weighs that is in every document, up to
    1 for plain inverse document frequencies. ``deviations`` is that of the
    sketches (see ``DEVIATIONS``); with None every link between members of one
    bucket is found.

    Equal shingle sets are one node from the start, combined before they move;
    64-bit node hashes would merge two of 10^9 texts with a probability of 3 %.
    """
    with row_batches(docs.sparkSession, BATCH):
        return _classes(docs, threshold, damp, deviations)


def _classes(docs: DataFrame, threshold: float, damp: float, deviations: float | None) -> DataFrame:
    """``near_classes``; all that runs in Python is written when it returns."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string")).alias("th"), F.col("text").cast("string"))
    weights = spark.sparkContext.broadcast(weight_table(rows, damp))
    signed = rows.mapInArrow(_signatures(weights), "doc_id long, th long, node long, bands array<long>")
    signed = cut(signed.withColumn("uid", F.monotonically_increasing_id()), "signatures")
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid")
    nodes = cut(signed.filter("node is not null").groupBy("node").agg(F.min(F.struct(row.alias("r"), "doc_id", "th", "bands")).alias("m")).select("node", "m.doc_id", "m.th", "m.bands"), "nodes")
    members = nodes.select(F.explode("bands").alias("key"), "node")

    def texts(wanted: DataFrame) -> DataFrame:
        # One text a node: the smallest row's. Repeated rows have the same text, so any will do.
        key = id_key()
        one = nodes.select("node", *[c.alias(n) for n, c in key.items()], "th").join(wanted, "node", "left_semi")
        return rows.select(*[c.alias(n) for n, c in key.items()], "th", "text").join(one, [*key, "th"]).select("node", "text").dropDuplicates(["node"])

    labels = labels_of(members, texts, weights, threshold, deviations)
    of = signed.select("uid", "doc_id", "th", "node")
    if labels is not None:
        of = of.join(labels, "node", "left")
    else:
        of = of.withColumn("label", F.lit(None).cast("long"))
    alone = F.col("node").isNull()
    of = cut(of.select("uid", "doc_id", "th", F.struct(alone.alias("alone"), F.when(alone, F.col("uid")).otherwise(F.coalesce("label", "node")).alias("c")).alias("c")), "labelled")
    # A written side leaves both of the join's inputs plain, so that Spark can split a class with thousands of rows.
    classes = cut(of.groupBy("c").agg(F.min(row).alias("first"), F.count("*").alias("class_size")), "classes")
    return of.join(classes, "c").select("doc_id", F.col("first.doc_id").alias("class_id"), "class_size", (F.col("uid") == F.col("first.uid")).alias("kept"), "th")


def deduplicated(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that ``near_classes`` keeps, with all their columns.

    Rows equal in id and text count as one; where they differ in something
    else, one is kept by a hash of its values, the same in every run. A null id
    is an id of its own.
    """
    kept = near_classes(docs, threshold).filter("kept").select(*[c.alias(n) for n, c in id_key().items()], "th").distinct()
    return one_of_each(docs, id_key() | {"th": F.xxhash64(F.col("text").cast("string"))}, kept)
