"""Largest inner products by score-aware quantisation, four-bit table scans and exact reranking.

Vectors are coded in subspaces of two dimensions, sixteen centroids each. Codes
and codebooks minimise a loss in which the part of the residual parallel to the
vector weighs more than the rest, as that part is what changes large inner
products. A scan adds up sixteen-entry tables; its best candidates are scored
anew with the original vectors in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.session import cut

#: Vectors that the codebooks are fitted on, about; all vectors are indexed.
SAMPLE = 6000
#: Rows that one tile of the scan holds, about: at least, and at most where there are TILES blocks and more; and queries.
ROWS, MOST_ROWS, TILES, QUERIES = 8192, 1 << 16, 64, 8192
#: Candidates of each tile that are scored exactly, for each result wanted.
RERANK = 6
#: Inner products from this share of the norm up are what the loss is made for.
THRESHOLD = 0.2
SUB, CENTROIDS, SWEEPS, STEPS = 2, 16, 3, 5
#: Where a solution for the centroids is good enough, and the most rounds for one.
TOLERANCE, ROUNDS = 1e-6, 200


def solved(column: np.ndarray, value: np.ndarray, weight: float, left: np.ndarray, right: np.ndarray, start: np.ndarray) -> np.ndarray:
    """``b`` with ``weight V'V b + left * b = right``, where row i of V has ``value[i]`` in the columns ``column[i]``.

    By conjugate gradients from ``start``, each column scaled by its own diagonal: V is never made, and what is held
    grows with the dimension and not with its square."""

    def times(b: np.ndarray) -> np.ndarray:
        ahead = (value * b[column]).sum(1)
        return weight * np.bincount(column.ravel(), weights=(value * ahead[:, None]).ravel(), minlength=len(left)) + left * b

    scale = 1 / (weight * np.bincount(column.ravel(), weights=(value * value).ravel(), minlength=len(left)) + left)
    b = start.astype(float)
    rest = right - times(b)
    ahead = way = scale * rest
    size, least = rest @ ahead, (right @ (scale * right)) * TOLERANCE**2
    for _ in range(ROUNDS):
        if size <= least:
            break
        step = times(way)
        far = size / (way @ step)
        b, rest = b + far * way, rest - far * step
        ahead = scale * rest
        size, before = rest @ ahead, size
        way = ahead + size / before * way
    return b


class Quantiser:
    """``books`` holds, by subspace, sixteen centroids."""

    def __init__(self, dim: int) -> None:
        self.dim, self.m = dim, -(-dim // SUB)
        self.weight = max(1.0, (dim - 1) * THRESHOLD**2 / (1 - THRESHOLD**2))
        self.books = np.zeros((self.m, CENTROIDS, SUB))

    def parts(self, x: np.ndarray) -> np.ndarray:
        if self.m * SUB > self.dim:
            x = np.concatenate((x, np.zeros((len(x), self.m * SUB - self.dim))), 1)
        return x.reshape(len(x), self.m, SUB)

    def encode(self, x: np.ndarray, codes: np.ndarray | None = None) -> np.ndarray:
        """Codes by coordinate descent on the loss: each subspace in turn takes its best centroid given the others."""
        parts, n = self.parts(x), len(x)
        norm2 = np.maximum((x * x).sum(1), 1e-300)
        if codes is None:
            codes = np.stack([((parts[:, k, None, :] - self.books[k]) ** 2).sum(2).argmin(1) for k in range(self.m)], 1) if n else np.zeros((0, self.m), np.int64)
        at = np.arange(n)
        along = np.zeros(n)
        for k in range(self.m):
            along += ((parts[:, k] - self.books[k][codes[:, k]]) * parts[:, k]).sum(1)
        for _ in range(SWEEPS):
            for k in range(self.m):
                rest = parts[:, k, None, :] - self.books[k]
                dot = (rest * parts[:, k, None, :]).sum(2)
                along -= dot[at, codes[:, k]]
                loss = (rest * rest).sum(2) + (self.weight - 1) * (along[:, None] + dot) ** 2 / norm2[:, None]
                codes[:, k] = loss.argmin(1)
                along += dot[at, codes[:, k]]
        return codes

    def fit(self, x: np.ndarray, seed: int = 11) -> Quantiser:
        """Codebooks by turns of encoding and of solving for all centroids at once."""
        if not len(x):
            return self
        rng = np.random.default_rng(seed)
        parts = self.parts(x)
        self.books = np.stack([parts[rng.choice(len(x), CENTROIDS, replace=len(x) < CENTROIDS), k] for k in range(self.m)])
        norm = np.maximum(np.sqrt((x * x).sum(1)), 1e-150)
        size, codes = self.m * CENTROIDS * SUB, None
        along = (parts / norm[:, None, None]).reshape(len(x), -1)
        for _ in range(STEPS):
            codes = self.encode(x, codes)
            column = ((np.arange(self.m) * CENTROIDS + codes)[:, :, None] * SUB + np.arange(SUB)).reshape(len(x), -1)
            left = np.bincount(column.ravel(), minlength=size) + 1e-3
            right = self.weight * np.bincount(column.ravel(), weights=parts.ravel(), minlength=size) + 1e-3 * self.books.ravel()
            self.books = solved(column, along, self.weight - 1, left, right, self.books.ravel()).reshape(self.books.shape)
        return self

    def tables(self, q: np.ndarray) -> np.ndarray:
        """By subspace, centroid and query: what a code adds to the inner product."""
        return np.einsum("qms,mcs->mcq", self.parts(q), self.books).astype(np.float32)


def pack(codes: np.ndarray) -> np.ndarray:
    """Two codes a byte."""
    if codes.shape[1] % 2:
        codes = np.concatenate((codes, np.zeros((len(codes), 1), codes.dtype)), 1)
    return (codes[:, 0::2] << 4 | codes[:, 1::2]).astype(np.uint8)


def unpack(packed: np.ndarray, m: int) -> np.ndarray:
    return np.stack((packed >> 4, packed & 15), 2).reshape(len(packed), -1)[:, :m]


def _encode(quantiser):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = quantiser.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(1).flatten().to_numpy().reshape(-1, q.dim)
            codes = pack(q.encode(x))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([v.tobytes() for v in x], pa.binary()), pa.array([c.tobytes() for c in codes], pa.binary())], names=["vec_id", "vec", "codes"])

    return run


def best(score: np.ndarray, k: int) -> np.ndarray:
    """The places of the ``k`` largest of one row; of those equal to the last, the first ones."""
    if k >= len(score):
        return np.arange(len(score))
    edge = np.partition(score, len(score) - k)[len(score) - k]
    above = np.flatnonzero(score > edge)
    return np.concatenate((above, np.flatnonzero(score == edge)[: k - len(above)]))


def _scan(quantiser, k: int, exact_scan: bool = False):
    def run(tile: pd.DataFrame) -> pd.DataFrame:
        q = quantiser.value
        rows, asked = (tile[tile["query"] == x].sort_values(["vec_id"], kind="stable") for x in (False, True))
        none = pd.DataFrame({"query_id": pd.Series([], dtype="int64"), "qh": pd.Series([], dtype="int64"), "vec_id": pd.Series([], dtype="int64"), "score": pd.Series([], dtype="float64")})
        if not len(rows) or not len(asked):
            return none
        ids, marks = rows["vec_id"].to_numpy(), rows["qh"].to_numpy()
        vecs, qs = (np.frombuffer(b"".join(x["vec"]), np.float64).reshape(-1, q.dim) for x in (rows, asked))
        codes = unpack(np.frombuffer(b"".join(rows["codes"]), np.uint8).reshape(len(rows), -1), q.m)
        out = []
        for i in range(0, len(qs), 256):
            part, own, own_mark = qs[i : i + 256], asked["vec_id"].to_numpy()[i : i + 256], asked["qh"].to_numpy()[i : i + 256]
            if exact_scan:
                score = vecs @ part.T
            else:
                tables = q.tables(part)
                score = np.zeros((len(ids), len(part)), np.float32)
                for m in range(q.m):
                    score += tables[m][codes[:, m]]
            for j, first in enumerate(np.searchsorted(ids, own)):
                # The query's own row, one of them if it is there more than once; it is in this tile or in none.
                same = first + np.flatnonzero(marks[first : np.searchsorted(ids, own[j], side="right")] == own_mark[j])
                score[same[:1], j] = -np.inf
                at = best(np.ascontiguousarray(score[:, j]), RERANK * k)
                at = at[score[at, j] > -np.inf]
                exact = (vecs[at] * part[j]).sum(1)
                top = np.lexsort((ids[at], -exact))[:k]
                out.append((np.full(len(top), own[j]), np.full(len(top), own_mark[j]), ids[at][top], exact[top]))
        return pd.DataFrame({c: np.concatenate(x) for c, x in zip(none.columns, zip(*out, strict=True), strict=True)})

    return run


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, vec`` in double precision: no nulls, all components finite, one not zero, of the commonest length."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("vec")).filter("vec_id is not null and vec is not null")
    rows = rows.filter(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0))
    length = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).select("n").first()
    return rows.filter(F.size("vec") == (length.n if length else 0))


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, exact: bool = False) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose vec_id is divisible by ``every`` its ``k`` nearest others.

    Nearest is the largest inner product in double precision, ties to the
    smaller vec_id; fewer rows than ``k`` are all returned. Unusable vectors
    take no part (see ``usable``). Every row but the query's own is a candidate,
    one with the same vec_id too; rows equal in both are one query. The scan is
    approximate in which candidates it finds, never in their scores; with
    ``exact`` it scans the vectors themselves and finds all.

    The stated queries meet all rows, in tiles: every row is in one tile with
    every block of queries. Equal vectors spread over tiles by id, and no tile
    grows beyond MOST_ROWS by QUERIES, about.
    """
    spark = vectors.sparkSession
    rows = usable(vectors).withColumn("qh", F.xxhash64("vec"))
    n = rows.count()
    first = rows.first()
    if first is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    # Chosen by the vector's hash and each vector once, so that no common vector or id makes the sample large.
    sample = rows.filter(F.pmod(F.xxhash64("qh", F.lit("fit")), F.lit(1 << 30)) < min(1.0, SAMPLE / n) * (1 << 30)).groupBy("qh").agg(F.min("vec").alias("vec")).collect()
    x = np.array([r.vec for r in sorted(sample, key=lambda r: r.qh)] or [first.vec], float)
    quantiser = spark.sparkContext.broadcast(Quantiser(len(first.vec)).fit(x))
    index = cut(rows.select("vec_id", "vec").mapInArrow(_encode(quantiser), "vec_id long, vec binary, codes binary").withColumn("qh", F.xxhash64("vec")), "index")
    asked = index.filter(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "qh"])
    blocks, groups = math.ceil(n / min(MOST_ROWS, max(ROWS, n // TILES))), max(1, math.ceil(asked.count() / QUERIES))
    h = F.xxhash64("vec_id", "qh")
    data = index.select(F.pmod(h, F.lit(blocks)).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), F.lit(False).alias("query"), "vec_id", "qh", "vec", "codes")
    queries = asked.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.pmod(h, F.lit(groups)).cast("int").alias("group"), F.lit(True).alias("query"), "vec_id", "qh", "vec", "codes")
    found = data.union(queries).groupBy("block", "group").applyInPandas(_scan(quantiser, k, exact), "query_id long, qh long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id", "qh").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
