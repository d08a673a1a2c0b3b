"""One large JSON object in files, read and written in parts: no task holds the whole of it.

The text is cut at closing braces, so that the parts of a file go to different
tasks. What a piece does to the state of the text (whether a string is open,
how deep objects and lists are nested) depends on what comes before it only by
that state, so running sums over pieces, in two levels, give the state at each
of them, and pieces are put together to entries where the nesting returns to
the depth asked for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfspark.session import cut
from shelfspark.sources.products import in_file_order, numbered, part_of, read_lines


def _before(rows: DataFrame, **sums: str) -> DataFrame:
    """Each column's sum over all rows before, in order of ``row``: inside parts by a window, and of whole parts from a
    table with a row for each."""
    part = part_of("row")
    inside = Window.partitionBy("part_").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("part_", part)
    totals = rows.groupBy("part_").agg(*[F.sum(c).alias(f"{n}_t") for n, c in sums.items()])
    upto = Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("part_", *[F.coalesce(F.sum(f"{n}_t").over(upto), F.lit(0)).alias(f"{n}_t") for n in sums])
    rows = rows.withColumns({n: F.coalesce(F.sum(c).over(inside), F.lit(0)) for n, c in sums.items()}).join(F.broadcast(totals), "part_")
    return rows.withColumns({n: F.col(n) + F.col(f"{n}_t") for n in sums}).drop("part_", *[f"{n}_t" for n in sums])


def _ends_marked(spark: SparkSession, path: str) -> DataFrame:
    """Lines that end at braces, with ``brace``: whether one does. The last of a file may not, which shows only in the
    number of braces that the file has, so these are counted in a second read; the table of files has a row for each."""
    lines = read_lines(spark, path, until="}")
    last = lines.groupBy("file").agg(F.count("*").alias("pieces_"), F.max(F.struct("start", "at")).alias("last_"))
    braces = read_lines(spark, path, until='"').groupBy("file").agg(F.sum(F.length("value") - F.length(F.translate("value", "}", ""))).alias("braces_"))
    files = cut(last.join(braces, "file").select("file", F.when(F.col("pieces_") > F.col("braces_"), F.col("last_")).alias("open_")), "files")
    marked = lines.join(F.broadcast(files), "file").withColumn("brace", F.coalesce(F.struct("start", "at") != F.col("open_"), F.lit(True)))
    return marked.drop("open_")


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """``row, value, brace, depth``: text up to a closing brace or the end of a file, and the depth after that."""
    rows = in_file_order(_ends_marked(spark, path))
    parts = F.split(F.regexp_replace("value", r"(?s)\\.", ""), '"')
    count = lambda which, x: F.aggregate(F.filter(parts, lambda _, i: i % 2 == which), F.lit(0), lambda n, p: n + F.length(p) - F.length(F.translate(p, x, "")))
    rows = rows.select("row", "value", "brace", (F.size(parts) - 1).alias("quotes"), *[(count(k, "{[") - count(k, "]")).alias(f"step_{k}") for k in (0, 1)])
    rows = _before(rows, said="quotes").withColumns({"open_": F.col("said") % 2, "open_after": (F.col("said") + F.col("quotes")) % 2})
    # Where a string is open at its begin, what is outside of strings is every other part from the second on.
    step = F.when(F.col("open_") == 0, F.col("step_0")).otherwise(F.col("step_1")) - F.when(F.col("brace"), 1 - F.col("open_after")).otherwise(0)
    rows = _before(rows.withColumn("step", step), depth="step")
    return cut(rows.select("row", "value", "brace", (F.col("depth") + F.col("step")).alias("depth"), (F.col("brace") & (F.col("open_after") == 0)).alias("closed")), "pieces")


def entries(spark: SparkSession, path: str, key: str | None = None) -> DataFrame:
    """``key, value``, a variant: the entries of the object in the files at ``path``, or of the object under its ``key``.

    Several files are one text, in order of their paths. Another top level, text after the object, and an object that
    does not end are errors; so is an entry that is no JSON. Blank files count as none.
    """
    pieces = _pieces(spark, path)
    first = pieces.filter(F.trim("value") != "").orderBy("row").select(F.substring(F.regexp_replace("value", r"^\s+", ""), 1, 1).alias("c")).first()
    if first is None or first.c != "{":
        raise ValueError(f"the top level of {path} is not an object")
    end = pieces.agg(F.max_by("depth", "row").alias("depth"), F.coalesce(F.max((F.col("depth") < 0) | ((F.col("depth") == 0) & ~F.col("brace") & (F.regexp_replace("value", r"\s+", "") != ""))), F.lit(False)).alias("more"), F.count_if((F.col("depth") == 0) & F.col("closed")).alias("ends")).first()
    if end.more or end.depth > 0 or end.ends != 1:
        raise ValueError(f"the object in {path} {'is followed by more text' if end.more or end.ends > 1 else 'does not end'}")
    depth = 1 if key is None else 2
    ends = F.col("closed") & (F.col("depth") <= depth) & (F.col("depth") >= 0)
    rows = _before(pieces.withColumns({"end": ends.cast("int"), "top": (F.col("closed") & (F.col("depth") <= 1)).cast("int")}), entry="end", place="top")
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("row", "value", "brace"))), lambda x: F.concat(x["value"], F.when(x["brace"], "}").otherwise(""))), "")
    text = F.substr(text, F.lit(1), F.length(text) - 1)
    whole = rows.groupBy("place", "entry").agg(text.alias("text"), F.max_by("depth", "row").alias("depth"), F.max("end").alias("end")).filter("end = 1")
    body = F.concat("text", F.when(F.col("depth") >= depth, "}").otherwise(""))
    if key is not None:
        # The first entry of an inner object comes with what stands before it; entries of other inner objects go.
        head = rf'(?s)^\s*[,{{](?:\s*"(?:[^"\\]|\\.)*"\s*:\s*[^{{}}"]*(?:"(?:[^"\\]|\\.)*")?[^{{}}"]*,)*\s*"{key}"\s*:\s*\{{'
        wanted = whole.filter(F.col("text").rlike(head)).select("place").distinct()
        whole = whole.join(F.broadcast(cut(wanted, "wanted")), "place").withColumn("text", F.regexp_replace("text", head, ""))
    inner = F.regexp_replace(body, r"^\s*[,{]?\s*", "") if key is None else F.regexp_replace(body, r"^\s*,?\s*", "")
    found = whole.select(inner.alias("body")).filter(F.trim("body") != "")
    parsed = found.select(F.parse_json(F.concat(F.lit("{"), "body", F.lit("}"))).alias("v"))
    return parsed.select(F.explode(F.variant_get("v", "$", "map<string, variant>")).alias("key", "value"))


def write_object(rows: DataFrame, path: str, before: str = "{", after: str = "}", mode: str = "errorifexists") -> None:
    """``rows(key, value)``, values as JSON, as one object over text files in order of keys, an entry a line; no row
    gives an empty object. ``before`` and ``after`` may hold what stands around the entries."""
    placed = numbered(rows.select("key", "value"), "key")
    total = placed.count()
    line = F.concat(F.when(F.col("n") == 1, before).otherwise(","), F.to_json(F.array("key")).substr(F.lit(2), F.length(F.to_json(F.array("key"))) - 2), F.lit(":"), "value", F.when(F.col("n") == total, after).otherwise(""))
    lines = placed.orderBy("n").select(line.alias("value")) if total else rows.sparkSession.range(1).select(F.lit(before + after).alias("value"))
    lines.write.mode(mode).text(path)
