"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source has the same fractional number of copies. Pairs of
fractional parts move mass at random, the words kept constant, until one of
the two is whole. In a chunk of a source the largest document is paired with
all smaller ones together, then the next largest: so what is left fractional
is small. It meets again, level by level, in a tree of reductions, and a
source's words miss its target by less than one document. No draw is judged
by its outcome, so every document keeps its expected number of copies.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.llm import segment
from shelfspark.llm.rows import id_key, packed, row_hash
from shelfspark.session import cut
from shelfspark.sources.products import numbered

WEIGHTS = (5, 2, 1)
MOST = 3.0
#: Documents that one fold takes, about, and residuals that one fold of the tree takes.
CHUNK, FAN = 4096, 64
#: Sources whose table may be sent to all tasks; beyond, the join is salted.
SENT, SALTS = 20_000, 64


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The number of ``[^\\x20\\x09-\\x0D]+`` in each text; null has none."""
    for batch in batches:
        n = [segment.word_counts(texts) for _, texts in segment.chunks(batch.column(3).to_pylist(), empty=b"")]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(np.concatenate(n) if n else [], pa.int64())], names=["doc_id", "source", "h", "size"])


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """``source, source_size, n, target`` from ``source, source_size, n``: one row a source.

    Sources by code point, null last, take the weights in turn and share the
    sum of all sizes; a target stops at ``most`` times its source's size and
    the excess goes to the others by weight. So every target is its cap or the
    same level times its weight; the level rises until no more caps are under
    it, each time by one sum over the sources.
    """
    rows = numbered(sizes.withColumnRenamed("n", "rows"), F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("n") - 1) % len(weights) + 1).cast("int"))
    rows = cut(rows.select("source", "source_size", F.col("rows").alias("n"), weight.alias("w"), (F.lit(float(most)) * F.col("source_size")).alias("cap")), "weights")
    under = F.col("cap") <= F.col("w") * F.col("level")
    level, capped = 0.0, -1
    while True:
        x = rows.withColumn("level", F.lit(level)).agg(F.sum("source_size").alias("all"), F.sum(F.when(under, F.col("cap"))).alias("cap"), F.sum(F.when(~under, F.col("w"))).alias("w"), F.count_if(under).alias("n")).first()
        if not x.w or x.n == capped:
            break
        level, capped = (x.all - (x.cap or 0.0)) / x.w, x.n
    level = level if x.w else float("inf")
    return rows.select("source", "source_size", "n", F.least(F.col("cap"), F.lit(level) * F.col("w")).alias("target"))


def with_targets(rows: DataFrame, of: DataFrame) -> DataFrame:
    """Each row with its source's columns; a source with a third of the rows is no problem either way."""
    of = of.withColumnRenamed("source", "s")
    if of.count() <= SENT:
        return rows.join(F.broadcast(of), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    salted = of.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.withColumn("salt_", F.pmod(F.col("h"), F.lit(SALTS)).cast("int"))
    return rows.join(salted, F.col("source").eqNullSafe(F.col("s")) & (F.col("salt_") == F.col("salt"))).drop("s", "salt", "salt_")


def pivot(size_a: float, a: float, size_b: float, b: float, u: float) -> tuple[float, float]:
    """Fractions ``a`` and ``b`` after one transfer: one becomes whole, ``size_a a + size_b b`` and both means stay."""
    up, down = min(1 - a, b * size_b / size_a), min(a, (1 - b) * size_b / size_a)
    a, b = (a + up, b - up * size_a / size_b) if u * (up + down) < down else (a - down, b + down * size_a / size_b)
    return _snap(a), _snap(b)


def _snap(x: float) -> float:
    return float(round(x)) if abs(x - round(x)) < 1e-9 else x


def _uniform(h: np.ndarray, salt: int) -> list[float]:
    """A number from 0 to 1 for each hash."""
    x = segment.mix(h.view(np.uint64) + np.uint64((salt + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    return ((x >> np.uint64(11)) / float(1 << 53)).tolist()


def bundled(size: list[float], part: float, u: list[float]) -> list[float]:
    """The fractions of documents, largest first, that all begin with ``part``: each is paired with all after it.

    What the pair moves from or to the rest, it moves from or to each of them alike, so they keep one fraction.
    """
    rest, f, out = sum(size), part, []
    for i, s in enumerate(size):
        rest -= s
        if not 0 < f < 1 or i == len(size) - 1:
            out.append(f)
            continue
        own, f = pivot(s, f, rest, f, u[i])
        out.append(own)
    return out


def _fold(level: int, seed: int = 0):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "h", "doc_id"], ascending=[False, True, True], na_position="last", kind="stable").reset_index(drop=True)
        part, size, u = rows["part"].tolist(), rows["size"].astype(float).tolist(), _uniform(rows["h"].to_numpy(np.int64), level + 64 * seed)
        if level == 0:
            return rows.assign(part=bundled(size, part[0], u))
        r = -1
        for i in range(len(part)):
            if r >= 0 and 0 < part[i] < 1:
                part[r], part[i] = pivot(size[r], part[r], size[i], part[i], u[i])
                r = r if 0 < part[r] < 1 else -1
            if 0 < part[i] < 1:
                r = i
        return rows.assign(part=part)

    return run


def _units(docs: DataFrame, weights: tuple[float, ...], most: float, seed: int) -> DataFrame:
    """One row for rows equal in everything: ``doc_id, source, h, size, source_size, target``, their number ``m``
    and ``copies``, how often they are taken together."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), row_hash(docs).alias("h"), F.col("text").cast("string").cast("binary").alias("text"))
    sized = rows.mapInArrow(_sizes, "doc_id long, source string, h long, size long")
    base = cut(sized.groupBy("doc_id", "source", "h", "size").agg(F.count("*").alias("m")), "sizes")
    of = targets(base.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"), F.count("*").alias("n")), weights, most)
    of = cut(of.withColumn("chunks", F.greatest(F.lit(1), F.ceil(F.col("n") / CHUNK)).cast("long")), "targets")
    copies = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(most))).otherwise(0.0) * F.col("m")
    rows = with_targets(base, of).withColumn("copies", copies).withColumn("whole", F.floor(F.col("copies") + 1e-12))
    part = F.when(F.col("size") > 0, F.greatest(F.col("copies") - F.col("whole"), F.lit(0.0))).otherwise(0.0)
    rows = rows.withColumn("part", F.when(part < 1e-9, 0.0).otherwise(part)).withColumn("bucket", F.pmod(F.shiftright("h", 8), F.col("chunks"))).drop("copies", "chunks", "n")
    most_chunks = of.agg(F.max("chunks")).first()[0] or 1
    loose = (F.col("part") > 0) & (F.col("part") < 1)
    rows = cut(rows, "parts")
    done, now = [rows.filter(~loose)], rows.filter(loose)
    for level in range(2 + math.ceil(math.log(most_chunks, FAN))):
        # Rows of one source that are there equally often begin with one fraction.
        by = ["source", "bucket", "m"] if level == 0 else ["source", "bucket"]
        now = cut(now.groupBy(*by).applyInPandas(_fold(level, seed), now.schema), "folded")
        done.append(now.filter(~loose))
        now = now.filter(loose).withColumn("bucket", F.expr(f"bucket div {FAN if level else 1}"))
    u = F.pmod(F.xxhash64("h", F.lit(f"last {seed}")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    out = now.withColumn("part", F.when(u < F.col("part"), 1.0).otherwise(0.0))
    for x in done:
        out = out.unionByName(x)
    return out.withColumn("copies", (F.col("whole") + F.col("part")).cast("long"))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST, seed: int = 0) -> DataFrame:
    """Every row as ``doc_id, size, source_size, target, taken, copies, source, h``; ``h`` hashes all of its values.

    Null text has size 0; rows of size 0 are copied as often as their source's
    whole part says and take no words. A null source is a source. An empty
    table gives an empty result. Rows equal in everything are rounded together
    and share their copies as evenly as whole numbers can. Random numbers hash
    the row and ``seed``, and folds are made of rows chosen by hash, so reruns
    agree whatever the partitions.

    A fold takes about ``CHUNK`` rows of one source and leaves one fractional
    row at most; those of one chunk meet, then ``FAN`` chunks in each further
    fold. So a source with a third of all rows spreads over as many tasks as it
    has chunks, and a row that is there a million times is one row here.
    """
    units = _units(docs, weights, most, seed)
    block = 1 << 16
    each = units.withColumn("b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1, F.lit(block).cast("long"))))
    each = each.withColumn("i", F.explode(F.sequence(F.col("b"), F.least(F.col("b") + block, F.col("m")) - 1)))
    each = each.withColumn("copies", F.expr("copies div m") + F.when(F.col("i") < F.col("copies") % F.col("m"), 1).otherwise(0))
    return each.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "source", "h")


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST, seed: int = 0) -> DataFrame:
    """The mix itself: the columns of ``docs``, each row as often as it is taken; rows not taken are gone.

    The text moves once, to meet its number of copies.
    """
    key = id_key()
    times = _units(docs, weights, most, seed).filter("copies > 0").select(*[c.alias(n) for n, c in key.items()], F.col("h").alias("hash"), F.col("copies").alias("times"))
    rows = packed(docs, key).join(times, [*key, "hash"]).groupBy(*key, "hash").agg(F.any_value("times").alias("times"), F.any_value("row").alias("row"))
    return rows.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "times"))).select("row.*")
