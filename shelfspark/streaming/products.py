"""The row-local part of the catalog as a stream: new lines are parsed and gated as they come."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from shelfspark.operators import gates
from shelfspark.sources import products


def stream(spark: SparkSession, folder: str, checks: dict[str, Column], files: int = 16) -> DataFrame:
    """Lines of new files with ``v``, ``kind`` and ``drop_reason``; bad JSON fails the first gate. Nothing is kept as state."""
    lines = spark.readStream.option("maxFilesPerTrigger", files).text(folder)
    rows = products.parsed(lines).filter("kind <> 'not_object'")
    return gates.gated(rows, {"bad_json": rows["kind"] == "bad_json"} | checks)


def write(rows: DataFrame, survivors: str, audit: str, checkpoint: str) -> StreamingQuery:
    """Each batch's survivors as Parquet, and its count by reason. A batch run again replaces its own folders."""

    def batch(df: DataFrame, n: int) -> None:
        df = df.persist()
        df.filter("drop_reason IS NULL").selectExpr("to_json(v) AS value").write.mode("overwrite").parquet(f"{survivors}/batch={n}")
        gates.funnel(df).write.mode("overwrite").parquet(f"{audit}/batch={n}")
        df.unpersist()

    return rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
