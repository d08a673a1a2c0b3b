"""Product dumps as JSON lines, document sinks, catalog reads, and bounds in file order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfspark.session import cut


def read_lines(spark: SparkSession, path: str, partitions: int | None = None, until: str | None = None) -> DataFrame:
    """Lines of plain or gzip files. A gzip file is read by one task; ``partitions`` deals its lines out after.

    ``file``, ``start`` and ``at`` say where a line stood: the file, where in it the part that one task read begins,
    and a number that grows with the lines of that part. ``until`` ends lines in place of a line feed.
    """
    place = {"file": F.col("_metadata.file_path"), "start": F.col("_metadata.file_block_start"), "at": F.monotonically_increasing_id()}
    lines = (spark.read.option("lineSep", until) if until else spark.read).text(path).select("value", *[c.alias(k) for k, c in place.items()])
    return lines.repartition(partitions) if partitions else lines


#: Rows are numbered by their part in the high bits and their place in it in the low ones.
_IN_PART = 33


def in_file_order(lines: DataFrame) -> DataFrame:
    """``row``, a number that grows from line to line and from file to file, by path. Lines that did not come from
    ``read_lines`` go by their partitions. The table of parts has a row for each task's share of a file."""
    if not {"file", "start", "at"} <= set(lines.columns):
        return lines.withColumn("row", F.monotonically_increasing_id())
    parts = lines.groupBy("file", "start").agg(F.min("at").alias("first_")).withColumn("part_", F.row_number().over(Window.orderBy("file", "start")).cast("long"))
    rows = lines.join(F.broadcast(parts), ["file", "start"])
    return rows.withColumn("row", F.shiftleft("part_", _IN_PART) + F.col("at") - F.col("first_")).drop("file", "start", "at", "part_", "first_")


def part_of(row: str) -> Column:
    return F.shiftright(row, _IN_PART)


def nth_row(rows: DataFrame, n: int) -> int | None:
    """The ``row`` of the ``n``th of ``rows`` in order, null if there are fewer: counts by part are added up, one
    number a part, and rows of the part that holds it, alone, are numbered."""
    part = part_of("row")
    counts = rows.groupBy(part.alias("part")).agg(F.count("*").alias("c")).withColumn("upto", F.sum("c").over(Window.orderBy("part")))
    hit = counts.filter(F.col("upto") >= n).orderBy("part").first()
    if hit is None:
        return None
    inside = rows.filter(part == hit.part).select("row", F.row_number().over(Window.partitionBy(part).orderBy("row")).alias("k"))
    return inside.filter(F.col("k") == n - (hit.upto - hit.c)).first().row


def listed(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines that are not blank, with ``listed``, a variant that holds the line's value as the one element of a list, so
    that anything after the value is an error too, null for bad JSON, and ``kind``: object, bad_json, or not_object.

    Only the first two count as read. Each line is parsed once, and an object is told by its brace, not by the schema
    of all that it holds. NaN and Infinity are bad JSON here.
    """
    rows = lines.filter(F.col(column).rlike(r"\S"))
    rows = rows.withColumn("listed", F.try_parse_json(F.concat(F.lit("["), column, F.lit("]"))))
    first = F.substring(F.ltrim(column, F.lit(" \t\r\n")), 1, 1)
    one = F.col("listed").isNotNull() & F.try_variant_get("listed", "$[1]", "variant").isNull() & (first != "]")
    rows = rows.withColumn("kind", F.when(~one, "bad_json").when(first == "{", "object").otherwise("not_object"))
    return rows.withColumn("listed", F.when(F.col("kind") != "bad_json", F.col("listed")))


def parsed(lines: DataFrame, column: str = "value") -> DataFrame:
    """``listed`` with the value itself as ``v``, a variant, in place of the list; null for bad JSON. Fields are taken
    from ``v`` where needed."""
    return listed(lines, column).withColumn("v", F.try_variant_get("listed", "$[0]", "variant")).drop("listed")


def read_catalog(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A finished catalog; a line that is no JSON object of that schema fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def write_documents(docs: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object a line: null keys are left out, empty lists stay."""
    docs.select(F.to_json(F.struct("*")).alias("value")).write.mode(mode).text(path)


def numbered(rows: DataFrame, *order: str | Column) -> DataFrame:
    """``n``, the place in ``order`` from 1. Rows are sorted once; the places inside sorted partitions come with the
    write, and what is before a partition from a table of one row for each."""
    rows = cut(rows.orderBy(*order).withColumn("n", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("n", 33)
    starts = rows.groupBy(part.alias("part_")).agg(F.count("*").alias("c"))
    before = F.coalesce(F.sum("c").over(Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("part_", part).join(F.broadcast(starts.select("part_", before.alias("before_"))), "part_")
    return rows.withColumn("n", F.col("n") - F.shiftleft("part_", 33) + F.col("before_") + 1).drop("part_", "before_")


def bounded(rows: DataFrame, survives: Column, read: int | None = None, written: int | None = None) -> DataFrame:
    """The survivors among the first ``read`` rows by ``n``, the first ``written`` of them."""
    rows = (rows.filter(F.col("n") <= read) if read is not None else rows).filter(survives)
    return rows.orderBy("n").limit(written) if written is not None else rows
