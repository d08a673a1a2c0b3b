"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word enters as the sum of what its hash and its character trigrams have
learned. Windows of words overlap by half; two gated recurrent layers read each
from both sides, attention pools their states, and the document's score is its
highest window's.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.llm import segment
from shelfspark.llm.langid import held_out
from shelfspark.llm.rows import free_names
from shelfspark.session import cut

#: Toxic documents to learn from, about, and how many times as many clean ones; whole texts of any length.
SAMPLE, CLEAN = 1000, 3
WINDOW, STRIDE = 32, 16
WORD_BITS, CHAR_BITS = 17, 13
#: Words in fewer documents of the sample have no embedding of their own; their trigrams speak for them.
COMMON = 6
D, H, A = 8, 8, 8
ROUNDS, STEPS, BATCH, RATE, DECAY = 8, 40, 192, 0.01, 1e-4
BLOCK = 4096
#: Tasks that read the sample, about.
PARTS = 32


def hashed(texts: list[str]) -> tuple[np.ndarray, ...]:
    """The words of all texts as indices of their distinct ones; those's hashes, trigram buckets and lengths; words a text."""
    cp, _, inside, starts, ends, doc = segment.letter_words(texts)
    n = np.bincount(doc, minlength=len(texts))
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, np.zeros(0, np.uint64), none, none, n
    h, first, of = np.unique(segment.hash_runs(cp, inside, starts), return_index=True, return_inverse=True)
    size = (ends - starts)[first]
    tri = (segment.trigrams(cp, inside)[_flat(starts[first], size)] >> (segment.TRIGRAM_BITS - CHAR_BITS)).astype(np.int64)
    return of, h, tri, size, n


def bucket(h: np.ndarray) -> np.ndarray:
    """The word bucket of each hash."""
    return (h >> np.uint64(64 - WORD_BITS)).astype(np.int64)


def windows(n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts of ``n`` words: each window's text, and first and last word (exclusive) among all words."""
    count = np.where(n > 0, 1 + np.maximum(0, -(-(n - WINDOW) // STRIDE)), 0)
    doc = np.repeat(np.arange(len(n)), count)
    base = np.concatenate(([0], np.cumsum(n)[:-1])) if len(n) else np.zeros(0, np.int64)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    return doc, base[doc] + k * STRIDE, (base + n)[doc]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Net:
    """``p`` holds word and trigram embeddings, per direction W, U, b, and attention and output weights."""

    def __init__(self, seed: int = 7) -> None:
        g = np.random.default_rng(seed)
        f = lambda *s, by=0.3: (g.standard_normal(s) * by).astype(np.float32)
        self.row = np.zeros(1 << WORD_BITS, np.int32)
        self.p = {"word": np.zeros((1, D), np.float32), "tri": f(1 << CHAR_BITS, D, by=0.05), "v": f(A), "Wa": f(2 * H, A), "ba": np.zeros(A, np.float32), "w": f(2 * H), "b": np.zeros(1, np.float32)}
        for d in "fb":
            self.p |= {f"W{d}": f(D, 3 * H), f"U{d}": f(H, 3 * H), f"c{d}": np.zeros(3 * H, np.float32)}

    def inputs(self, word: np.ndarray, tri: np.ndarray, size: np.ndarray) -> np.ndarray:
        x = self.p["word"][self.row[word]]
        if len(size):
            x = x + np.add.reduceat(self.p["tri"][tri], np.concatenate(([0], np.cumsum(size)[:-1]))) / size[:, None].astype(np.float32)
        return x

    def projected(self, x: np.ndarray, d: str) -> np.ndarray:
        """Each distinct word's share of the gates, and last the padding's, which leaves a state as it is."""
        pad = np.zeros((1, 3 * H), np.float32)
        pad[:, :H] = 30
        return np.concatenate((x @ self.p[f"W{d}"] + self.p[f"c{d}"], pad))

    def _forward(self, idx: np.ndarray, pf: np.ndarray, pb: np.ndarray, keep: bool = False):
        n, steps = idx.shape
        hs = np.empty((steps, n, 2 * H), np.float32)
        kept: dict = {}
        for d, proj, order, part in (("f", pf, range(steps), slice(0, H)), ("b", pb, range(steps - 1, -1, -1), slice(H, 2 * H))):
            h, u = np.zeros((n, H), np.float32), self.p[f"U{d}"]
            for t in order:
                g, a = proj[idx[:, t]], h @ u
                zr = g[:, : 2 * H] + a[:, : 2 * H]
                np.negative(zr, out=zr)
                np.exp(zr, out=zr)
                zr += 1
                np.reciprocal(zr, out=zr)
                m = zr[:, H:] * a[:, 2 * H :]
                m += g[:, 2 * H :]
                np.tanh(m, out=m)
                if keep:
                    kept[d, t] = h, zr, m, a[:, 2 * H :]
                h = m + zr[:, :H] * (h - m)
                hs[t, :, part] = h
        e = np.tanh(hs @ self.p["Wa"] + self.p["ba"])
        s = e @ self.p["v"]
        s[idx.T < 0] = -1e9
        s -= s.max(0)
        alpha = np.exp(s)
        alpha /= alpha.sum(0)
        pooled = np.einsum("tn,tnh->nh", alpha, hs)
        return pooled @ self.p["w"] + self.p["b"], hs, e, alpha, pooled, kept

    def gradients(self, idx: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[dict, np.ndarray]:
        """Of the mean log loss: by parameter, and by distinct word's input."""
        p, (n, steps) = self.p, idx.shape
        pf, pb = self.projected(x, "f"), self.projected(x, "b")
        logit, hs, e, alpha, pooled, kept = self._forward(idx, pf, pb, keep=True)
        dl = (_sigmoid(logit) - y) / n
        g = {"w": pooled.T @ dl, "b": dl.sum(keepdims=True)}
        dp = dl[:, None] * p["w"]
        da = np.einsum("nh,tnh->tn", dp, hs)
        ds = alpha * (da - (alpha * da).sum(0))
        g["v"] = np.einsum("tn,tna->a", ds, e)
        de = ds[:, :, None] * p["v"] * (1 - e * e)
        g["Wa"], g["ba"] = np.einsum("tnh,tna->ha", hs, de), de.sum((0, 1))
        dh = alpha[:, :, None] * dp + de @ p["Wa"].T
        dx = np.zeros((len(x) + 1, D), np.float32)
        for d, order, part in (("f", range(steps - 1, -1, -1), slice(0, H)), ("b", range(steps), slice(H, 2 * H))):
            u, carry = p[f"U{d}"], np.zeros((n, H), np.float32)
            du, dproj = np.zeros_like(u), np.zeros((len(x) + 1, 3 * H), np.float32)
            for t in order:
                h, zr, m, an = kept[d, t]
                z, r = zr[:, :H], zr[:, H:]
                o = carry + dh[t, :, part]
                dm = o * (1 - z) * (1 - m * m)
                dz, dr = o * (h - m) * z * (1 - z), dm * an * r * (1 - r)
                back = np.concatenate((dz, dr, dm * r), 1)
                du += h.T @ back
                carry = o * z + back @ u.T
                np.add.at(dproj, idx[:, t], np.concatenate((dz, dr, dm), 1))
            dproj[-1] = 0
            g[f"U{d}"], g[f"c{d}"], g[f"W{d}"] = du, dproj.sum(0), x.T @ dproj[:-1]
            dx[:-1] += dproj[:-1] @ p[f"W{d}"].T
        return g, dx[:-1]


def _odds(pos: np.ndarray, neg: np.ndarray, share: float) -> np.ndarray:
    """How much more often documents of class 1, a ``share`` of all, have each bucket, in standard deviations, squashed."""
    return np.tanh((pos * (1 - share) - neg * share) / np.sqrt((pos + neg) * share * (1 - share) + 1) / 4).astype(np.float32)


def _flat(starts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of runs, one run after the other."""
    return np.repeat(starts - (np.cumsum(size) - size), size) + np.arange(size.sum())


def seen(texts: list[str], y: np.ndarray) -> np.ndarray:
    """By class: the documents that have each word bucket and each trigram bucket, and last all documents."""
    out = np.zeros((2, (1 << WORD_BITS) + (1 << CHAR_BITS) + 1), np.int64)
    for at, part in segment.chunks(texts):
        of, h, tri, size, n = hashed(part)
        own = y[at : at + len(part)]
        out[:, -1] += np.bincount(own, minlength=2)
        if not len(of):
            continue
        pair = np.unique(np.repeat(np.arange(len(n)), n) * len(h) + of)  # each document's distinct words
        doc, its = pair // len(h), pair % len(h)
        flat = _flat((np.cumsum(size) - size)[its], size[its])
        for d, b, base, width in ((doc, bucket(h)[its], 0, 1 << WORD_BITS), (np.repeat(doc, size[its]), tri[flat], 1 << WORD_BITS, 1 << CHAR_BITS)):
            pair = np.unique(d * width + b)
            np.add.at(out, (own[pair // width], base + pair % width), 1)
    return out


def highest(net: Net, texts: list[str], y: np.ndarray) -> Iterator[tuple]:
    """The highest window of each whole text, and of clean ones the second highest: text, place, and its words' hashes, lengths and trigrams."""
    for at, part in segment.chunks(texts):
        of, h, tri, size, n = hashed(part)
        if not len(of):
            continue
        doc, first, end = windows(n)
        logit = np.concatenate([x for _, x in _logits(net, of, h, tri, size, first, end)])
        order = np.lexsort((-logit, doc))
        place = np.arange(len(order)) - np.searchsorted(doc[order], doc[order])
        starts = np.cumsum(size) - size
        for w, k in zip(order, place, strict=True):
            if k == 0 or k == 1 and y[at + doc[w]] == 0:
                its = of[first[w] : min(first[w] + WINDOW, end[w])]
                yield at + int(doc[w]), int(k), h[its], size[its], tri[_flat(starts[its], size[its])]


def train(texts: list[str], y: np.ndarray, seed: int = 7) -> Net | None:
    """A network from labelled texts; None where one class is missing."""
    y = np.asarray(y, np.int64)

    def pick(net: Net) -> tuple[np.ndarray, ...]:
        of, _, h, size, tri = zip(*highest(net, texts, y), strict=True)
        return (y[list(of)], np.array([len(x) for x in h]), *map(np.concatenate, (h, size, tri)))

    return learn(seen(texts, y), pick, seed)


def learn(found: np.ndarray, pick: Callable[[Net], tuple[np.ndarray, ...]], seed: int = 7, seeded: bool = False) -> Net | None:
    """A network from what ``seen`` tells of the documents; None where one class is missing.

    If ``seeded``, one input dimension starts as the class odds of common words and trigrams.
    In each round every document gives its highest window, and clean ones their
    second highest too; those train the network by Adam. ``pick`` finds them:
    their classes and numbers of words, and the words' hashes, lengths and trigrams.
    """
    if not found[:, -1].all() or not found[:, :-1].any():
        return None
    net, g = Net(seed), np.random.default_rng(seed)
    share = found[1, -1] / found[:, -1].sum()
    odds = _odds(found[1, :-1], found[0, :-1], share)
    common = np.flatnonzero(found[:, : 1 << WORD_BITS].sum(0) >= COMMON)
    net.row[common] = np.arange(1, len(common) + 1)
    net.p["word"] = np.zeros((len(common) + 1, D), np.float32)
    if seeded:
        net.p["word"][1:, 0] = odds[common]
        net.p["tri"][:, 0] = odds[1 << WORD_BITS :]
        for d in "fb":
            net.p[f"W{d}"][0, 2 * H :] = 1
        net.p["w"][:] = np.abs(net.p["w"])
    state = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    step = 0
    for _ in range(ROUNDS):
        y, n, h, size, tri = pick(net)
        h, at, of = np.unique(h, return_index=True, return_inverse=True)
        starts, size, word = (np.cumsum(size) - size)[at], size[at], bucket(h)
        idx = np.full((len(n), WINDOW), -1, np.int32)
        idx[np.arange(WINDOW) < n[:, None]] = of
        for _ in range(STEPS):
            part = g.choice(len(n), min(BATCH, len(n)), replace=False)
            used, local = np.unique(idx[part], return_inverse=True)
            local = local.reshape(len(part), WINDOW)
            if used[0] < 0:
                used, local = used[1:], local - 1
            at = _flat(starts[used], size[used])
            grads, dx = net.gradients(local, net.inputs(word[used], tri[at], size[used]), y[part].astype(np.float32))
            grads["word"], grads["tri"] = np.zeros_like(net.p["word"]), np.zeros_like(net.p["tri"])
            np.add.at(grads["word"], net.row[word[used]], dx)
            grads["word"][0] = 0
            np.add.at(grads["tri"], tri[at], np.repeat(dx / size[used, None], size[used], axis=0))
            step += 1
            for k, v in grads.items():
                m, s = state[k]
                m += 0.1 * (v - m)
                s += 0.001 * (v * v - s)
                net.p[k] -= (RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-6) + DECAY * net.p[k]).astype(np.float32)
    return net


def _logits(net: Net, of: np.ndarray, h: np.ndarray, tri: np.ndarray, size: np.ndarray, first: np.ndarray, end: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Scores of windows, block by block, each with the number of its first window."""
    x = net.inputs(bucket(h), tri, size)
    pf, pb = net.projected(x, "f"), net.projected(x, "b")
    for i in range(0, len(first), BLOCK):
        at = first[i : i + BLOCK, None] + np.arange(WINDOW)
        idx = np.where(at < end[i : i + BLOCK, None], of[np.minimum(at, len(of) - 1)], -1)
        yield i, net._forward(idx, pf, pb)[0]


def score(net: Net | None, texts: list[str]) -> np.ndarray:
    """The highest window's probability of each whole text; 0 for texts without words."""
    out = np.zeros(len(texts))
    if net is None:
        return out
    of, h, tri, size, n = hashed(texts)
    if not len(of):
        return out
    doc, first, end = windows(n)
    for i, logit in _logits(net, of, h, tri, size, first, end):
        np.maximum.at(out, doc[i : i + BLOCK], _sigmoid(logit.astype(float)))
    return out


def _seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = np.zeros((2, 1), np.int64)
    for batch in batches:
        found = found + seen(batch.column(3).to_pylist(), batch.column(2).to_numpy().astype(np.int64))
    toxic, at = np.nonzero(found)
    yield pa.RecordBatch.from_arrays([pa.array(toxic, pa.int32()), pa.array(at, pa.int32()), pa.array(found[toxic, at], pa.int64())], names=["toxic", "at", "n"])


_PICKED = "doc_id long, h long, toxic int, place int, words array<long>, size array<int>, tri array<int>"


def _highest(net):
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32())]
    names = [x.split()[0] for x in _PICKED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, th, y = (batch.column(k).to_numpy() for k in range(3))
            rows = [(ids[i], th[i], y[i], k, h.view(np.int64), size.astype(np.int32), tri.astype(np.int32)) for i, k, h, size, tri in highest(net.value, batch.column(3).to_pylist(), y)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * len(kinds), kinds, strict=True)], names=names)

    return run


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, seeded: bool = False) -> Net | None:
    """A network from the documents whose labels are not held out, a sample by hash of about
    ``sample`` toxic ones and CLEAN times as many others, of those that are there and have words.

    A document labelled more than once is toxic if one label says so. Tasks read the
    sampled texts whole; what comes back is a count by bucket, and in each round two windows a document at most.
    """
    spark = docs.sparkSession
    known = labels.filter(~held_out(5, 0)).filter("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter(F.col("doc_id").isNotNull() & F.col("text").rlike(r"\p{L}"))
    texts = texts.select("doc_id", F.xxhash64("doc_id", "text").alias("h"), "text")
    both = cut(texts.select("doc_id", "h").join(known, "doc_id"), "labelled")
    found = {r.toxic: r.n for r in both.groupBy("toxic").agg(F.count_distinct("doc_id", "h").alias("n")).collect()}
    if not {0, 1} <= set(found):
        return None
    share = F.when(F.col("toxic") == 1, F.lit(min(1.0, sample / found[1]))).otherwise(F.lit(min(1.0, CLEAN * sample / found[0])))
    taken = both.filter(F.pmod("h", F.lit(1 << 30)) < share * (1 << 30)).distinct()  # about (1 + CLEAN) * sample rows
    rows = texts.join(F.broadcast(taken), ["doc_id", "h"]).repartition(PARTS, "doc_id", "h").dropDuplicates(["doc_id", "h"])
    rows = cut(rows.select("doc_id", "h", "toxic", "text"), "sample")
    t = rows.mapInArrow(_seen, "toxic int, at int, n long").groupBy("toxic", "at").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((2, (1 << WORD_BITS) + (1 << CHAR_BITS) + 1), np.int64)
    counts[t["toxic"].to_numpy(), t["at"].to_numpy()] = t["n"].to_numpy()

    def pick(net: Net) -> tuple[np.ndarray, ...]:
        sent = spark.sparkContext.broadcast(net)
        t = rows.mapInArrow(_highest(sent), _PICKED).toArrow().sort_by([(c, "ascending") for c in ("doc_id", "h", "place")]).combine_chunks()
        sent.destroy()
        words, size, tri = (np.concatenate([c.flatten().to_numpy() for c in t[k].chunks]).astype(np.int64) for k in ("words", "size", "tri"))
        return t["toxic"].to_numpy(), pc.list_value_length(t["words"]).to_numpy(), words.view(np.uint64), size, tri

    return learn(counts, pick, seeded=seeded)


def _run(net, columns: list[str], names: tuple[str, str] = ("score", "predicted")):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = net.value
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            scores = [score(model, part) for _, part in segment.chunks(texts)]
            s = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=[*columns, *names])

    return run


def score_documents(docs: DataFrame, labels: DataFrame, seeded: bool = False) -> DataFrame:
    """One row per row: ``doc_id, held_out, score, predicted``.

    Texts are read whole, in all overlapping windows. Null and empty texts, and
    all texts where a class has no labels, score 0. A null doc_id is not held
    out. Repeated rows give repeated rows. Nothing of the documents is shuffled.
    """
    net = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, seeded=seeded))
    rows = docs.select(F.col("doc_id").cast("long"), held_out(5, 0).alias("held_out"), F.col("text").cast("string"))
    return rows.mapInArrow(_run(net, ["doc_id", "held_out"]), "doc_id long, held_out boolean, score double, predicted int")


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""
    net = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    score_, predicted, text = free_names(docs, "score", "predicted", "whole_text")
    kinds = T.StructType([*docs.schema.fields, T.StructField(score_, T.DoubleType()), T.StructField(predicted, T.IntegerType())])
    rows = docs.select("*", F.col("text").cast("string").alias(text)).mapInArrow(_run(net, docs.columns, (score_, predicted)), kinds)
    return rows.filter(F.col(predicted) == 0).drop(score_, predicted)
