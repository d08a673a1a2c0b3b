"""Session and shared-storage helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int = 8, app: str = "shelfspark") -> SparkSession:
    """A local session for tests and benchmarks."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


#: Rows that one task sorts at most, as far as their number is known.
ROWS_A_TASK = 1 << 20


def parts_for(spark: SparkSession, rows: int, a_task: int = ROWS_A_TASK) -> int:
    """As many partitions as a shuffle has, or more where a task would get more than ``a_task`` of ``rows``."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // a_task))


#: Rows of a table that goes to all tasks, at most.
BROADCAST_ROWS = 1 << 16


def meet(rows: DataFrame, facts: DataFrame, on: str, how: str = "left") -> DataFrame:
    """``rows`` joined to ``facts``, which are counted: few go to all tasks; of many each task gets some and hashes them,
    so that ``rows`` are not sorted, and a task's memory goes with its facts and not with its rows."""
    n = facts.count()
    if n <= BROADCAST_ROWS:
        return rows.join(F.broadcast(facts), on, how)
    parts = parts_for(rows.sparkSession, n)
    if parts > parts_for(rows.sparkSession, 0):
        facts = facts.repartition(parts, on)
    return rows.join(facts.hint("shuffle_hash"), on, how)


@contextmanager
def row_batches(spark: SparkSession, most: int) -> Iterator[None]:
    """Rows go to Python ``most`` at a time, or fewer if the session has less, in what runs inside."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = int(spark.conf.get(name))
    spark.conf.set(name, str(min(before, most) if before > 0 else most))
    try:
        yield
    finally:
        spark.conf.set(name, str(before))


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a temporary one is set only where that is unset, on one machine."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


#: Of the thread or task that asks, so that scopes of others are not mixed up with it.
_scopes: ContextVar[tuple[str, ...]] = ContextVar("scopes", default=())
#: Names of bucketed tables by the scope that they go with.
_tables: dict[tuple[str, ...], list[str]] = {}


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Tables written inside go when it ends; what is to stay must be written elsewhere by then."""
    inside = (*_scopes.get(), f"scope-{uuid.uuid4().hex}")
    token = _scopes.set(inside)
    try:
        yield
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/tables/{'/'.join(inside)}")
        _scopes.reset(token)
        for table in _tables.pop(inside, []):
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def scratch(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder."""
    return "/".join([shared_dir(spark), "tables", *_scopes.get(), f"{name}-{uuid.uuid4().hex}"])


def cut(df: DataFrame, name: str = "stage", seen: Observation | None = None, by: str | None = None, buckets: int | None = None, **figures: Column) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here and survives lost executors. ``seen``
    gets ``figures``, aggregates of the rows as they are written. With ``by`` the files are buckets of that column, ``buckets``
    or as many as a shuffle has partitions, and later joins and groups on it need no exchange."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    writer = (df.observe(seen, *[c.alias(k) for k, c in figures.items()]) if seen is not None else df).write.option("compression", "zstd")
    if by is None:
        writer.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    table = f"bucketed_{uuid.uuid4().hex}"
    writer.format("parquet").option("path", path).bucketBy(buckets or parts_for(spark, 0), by).saveAsTable(table)
    if _scopes.get():
        _tables.setdefault(_scopes.get(), []).append(table)
    return spark.table(table)


def laid(df: DataFrame, name: str, by: str, buckets: int, seen: Observation | None = None, **figures: Column) -> DataFrame:
    """``cut`` into ``buckets`` of a column, by which ``df`` lies already."""
    return cut(df, name, seen, by, buckets, **figures)
