"""A table in written generations: merges write what they touch, readers never see half of one.

A generation is a small table that names, for each bucket of ids, the version
of the files that hold it, with their rows and a fingerprint. A merge writes
new files for the buckets with changed rows, then the next such table, and
last a row of the pointer; until that is there, readers are on the generation
before. Two tables with the same buckets are compared by their fingerprints
first, and only buckets that differ are read.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.operators import publish
from shelfspark.operators.verify import Tolerance
from shelfspark.session import cut

#: Buckets of a table. What the driver holds is a row for each.
BUCKETS = 256


class MergeRefusedError(ValueError):
    """The gate on a merge's outcomes failed; nothing was written."""


class ConcurrentMergeError(RuntimeError):
    """Another merge came first; this one's files are not part of any generation."""


def marks(rows: DataFrame, bucket: Column) -> DataFrame:
    """``bucket, rows, mark``: two sums of 64-bit hashes of whole rows, the same in any order."""
    of = [F.col("`" + c + "`") for c in sorted(rows.columns)]
    sums = [F.coalesce(F.sum(h.cast("decimal(20,0)")), F.lit(0)).cast("string") for h in (F.xxhash64(*of), F.xxhash64(F.lit(1), *of))]
    return rows.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("rows"), F.concat_ws(":", *sums).alias("mark"))


def bucket_of(id_: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(id_), F.lit(buckets)).cast("int")


class Generations:
    """The table at ``base``, keyed by ``id``; ``create`` it once, then ``merge``, ``read`` and ``diff``."""

    def __init__(self, spark: SparkSession, base: str, buckets: int = BUCKETS) -> None:
        self.spark, self.base, self.buckets = spark, base.rstrip("/"), buckets

    def history(self) -> DataFrame:
        """``generation, map``: all generations that were finished."""
        try:
            return self.spark.read.schema("generation long, map string").parquet(f"{self.base}/pointer")
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return self.spark.createDataFrame([], "generation long, map string")
            raise

    def current(self) -> int | None:
        return self.history().agg(F.max("generation")).first()[0]

    def versions(self, generation: int | None = None) -> DataFrame:
        """``bucket, version, rows, mark`` of a generation, the newest unless another is asked for."""
        found = self.history().orderBy(F.desc("generation")) if generation is None else self.history().filter(F.col("generation") == generation)
        row = found.first()
        if row is None:
            raise ValueError(f"no generation {'yet' if generation is None else generation} at {self.base}")
        return self.spark.read.schema("bucket int, version string, rows long, mark string").parquet(f"{self.base}/maps/{row.map}")

    def read(self, generation: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        """The rows, of some buckets only if they are listed; no other file is opened."""
        return self._rows(self.versions(generation).filter(F.col("bucket").isin(buckets) if buckets is not None else F.lit(True)))

    def _rows(self, versions: DataFrame) -> DataFrame:
        paths = [f"{self.base}/data/version={r.version}/bucket={r.bucket}" for r in versions.orderBy("bucket").collect()]
        empty = self.spark.read.parquet(f"{self.base}/schema")
        return self.spark.read.schema(empty.schema).parquet(*paths) if paths else empty

    def create(self, rows: DataFrame) -> None:
        """Generation 0. An empty table is refused, and one where there is a generation already."""
        if self.current() is not None:
            raise ValueError(f"there is a generation at {self.base} already")
        if rows.isEmpty():
            raise ValueError("the table is empty: nothing to publish")
        rows.limit(0).write.parquet(f"{self.base}/schema")
        self._commit(None, self._written(rows))

    def _written(self, rows: DataFrame) -> DataFrame:
        """Files of a new version, and their ``bucket, version, rows, mark``."""
        version = uuid.uuid4().hex
        path = f"{self.base}/data/version={version}"
        rows.withColumn("bucket", bucket_of(F.col("id"), self.buckets)).hint("rebalance", "bucket").write.partitionBy("bucket").parquet(path)
        back = self.spark.read.schema(rows.schema).option("recursiveFileLookup", True).parquet(path)
        return marks(back, bucket_of(F.col("id"), self.buckets)).select("bucket", F.lit(version).alias("version"), "rows", "mark")

    def _commit(self, before: int | None, versions: DataFrame) -> None:
        name = f"map-{uuid.uuid4().hex}"
        versions.coalesce(1).write.parquet(f"{self.base}/maps/{name}")
        if self.current() != before:
            raise ConcurrentMergeError(f"generation {before} is no longer the newest")
        next_ = 0 if before is None else before + 1
        self.spark.range(1).select(F.lit(next_).cast("long").alias("generation"), F.lit(name).alias("map")).coalesce(1).write.mode("append").parquet(f"{self.base}/pointer")

    def merge(self, updates: DataFrame, columns: list[str], tolerance: Tolerance = Tolerance(), skip_empty: bool = True) -> DataFrame:
        """Applies updates of ids that the table has and returns the row of ``publish.merge_gate``.

        Buckets without an update's id are not read, and those without a changed row not written. A failed gate is
        refused; where nothing changes there is no new generation.
        """
        before = self.current()
        updates = cut(updates.select("id", *columns), "updates")
        asked = [r.b for r in updates.filter("id IS NOT NULL").select(bucket_of(F.col("id"), self.buckets).alias("b")).distinct().collect()]
        outcome = cut(publish.outcomes(self.read(before, asked), updates, columns, skip_empty), "outcomes")
        gate = cut(publish.merge_gate(outcome, tolerance), "gate")
        if gate.first().status != "pass":
            raise MergeRefusedError(str(gate.first().asDict()))
        changed = [r.b for r in outcome.filter("outcome = 'updated'").select(bucket_of(F.col("id"), self.buckets).alias("b")).distinct().collect()]
        if changed:
            fresh = self._written(publish.merged(self.read(before, changed), updates, columns, skip_empty))
            self._commit(before, self.versions(before).filter(~F.col("bucket").isin(changed)).union(fresh))
        return gate

    def differing(self, other: Generations, mine: int | None = None, theirs: int | None = None) -> list[int]:
        """Buckets whose rows differ, by their fingerprints; no file of the data is opened."""
        if other.buckets != self.buckets:
            raise ValueError("the tables have different buckets")
        a, b = self.versions(mine), other.versions(theirs)
        both = a.join(b.withColumnsRenamed({"rows": "rows_", "mark": "mark_", "version": "version_"}), "bucket", "full")
        return [r.bucket for r in both.filter(~(F.col("rows").eqNullSafe(F.col("rows_")) & F.col("mark").eqNullSafe(F.col("mark_")))).select("bucket").orderBy("bucket").collect()]

    def diff(self, built: Generations, mine: int | None = None, theirs: int | None = None) -> DataFrame:
        """``id, side`` as ``row_diff`` has it, of this table against ``built``; only differing buckets are read."""
        buckets = self.differing(built, mine, theirs)
        return row_diff(self.read(mine, buckets), built.read(theirs, buckets))


def row_diff(published: DataFrame, built: DataFrame) -> DataFrame:
    """``id, side``: missing from the published table, unexpected there, or changed. An id with several rows counts once;
    it is changed if the rows are not the same, as often as they are there."""
    of = lambda df, n: df.groupBy(F.col("id").alias(f"{n}_id")).agg(F.struct(F.count("*"), F.sum(F.xxhash64(*[F.col("`" + c + "`") for c in sorted(df.columns)]).cast("decimal(20,0)"))).alias(n))
    both = of(published, "p").join(of(built, "b"), F.col("p_id").eqNullSafe(F.col("b_id")), "full")
    side = F.when(F.col("p").isNull(), "missing").when(F.col("b").isNull(), "unexpected").when(F.col("p") != F.col("b"), "changed")
    return both.select(F.coalesce("p_id", "b_id").alias("id"), side.alias("side")).filter("side IS NOT NULL")


def local_diff(published: DataFrame, built: DataFrame, buckets: int = 1 << 12) -> DataFrame:
    """``row_diff`` of two tables that have no stored fingerprints: one aggregation each finds the buckets that differ,
    and only their rows are shuffled. What is broadcast has a row a bucket at most."""
    at = bucket_of(F.col("id"), buckets)
    a, b = marks(published, at), marks(built, at).withColumnsRenamed({"rows": "rows_", "mark": "mark_"})
    both = a.join(b, "bucket", "full").filter(~(F.col("rows").eqNullSafe(F.col("rows_")) & F.col("mark").eqNullSafe(F.col("mark_"))))
    odd = F.broadcast(cut(both.select(F.col("bucket").alias("odd_")), "differing"))
    of = lambda df: df.join(odd, at == F.col("odd_"), "left_semi")
    return row_diff(of(published), of(built))
