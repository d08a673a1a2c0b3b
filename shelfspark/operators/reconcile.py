"""A published table against the build it came from."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def field_names(kind: T.DataType, at: str = "") -> list[str]:
    """All dotted names, inner ones too."""
    if isinstance(kind, T.ArrayType):
        return field_names(kind.elementType, at)
    if not isinstance(kind, T.StructType):
        return []
    return [n for f in kind for n in (f"{at}{f.name}", *field_names(f.dataType, f"{at}{f.name}."))]


def schema_check(table: DataFrame, wanted: list[str]) -> DataFrame:
    """``field, status`` for every field that will be read."""
    have = set(field_names(table.schema))
    rows = F.array(*[F.struct(F.lit(w).alias("field"), F.lit("pass" if w in have else "fail").alias("status")) for w in wanted])
    return table.sparkSession.range(1).select(F.explode(rows).alias("r")).select("r.*")


def identity_check(found: dict[str, str], manifest: DataFrame) -> DataFrame:
    """``property, status`` of ``manifest(property, value)``: pass, fail, or unverifiable where the table records nothing."""
    none = F.create_map().cast("map<string,string>")
    have = F.element_at(F.create_map(*[F.lit(x) for kv in found.items() for x in kv]) if found else none, F.col("property"))
    return manifest.select("property", F.when(have.isNull() | F.col("value").isNull(), "unverifiable").when(have == F.col("value"), "pass").otherwise("fail").alias("status"))


def count_check(published: DataFrame, built: DataFrame) -> DataFrame:
    """Published rows against the build's distinct ids; nothing against nothing is no success."""
    p, b = published.agg(F.count("*").alias("published")), built.agg(F.countDistinct("id").alias("expected"))
    return p.join(b).withColumn("status", F.when((F.col("published") == F.col("expected")) & (F.col("expected") > 0), "pass").otherwise("fail"))


def coverage_check(published: DataFrame, column: str) -> DataFrame:
    kind = published.schema[column].dataType
    filled = F.size(column) > 0 if isinstance(kind, T.ArrayType) else F.col(column).isNotNull()
    out = published.agg(F.count("*").alias("rows"), F.count_if(filled).alias("covered"))
    return out.withColumn("status", F.when((F.col("rows") > 0) & (F.col("covered") == F.col("rows")), "pass").otherwise("fail"))


def value_counts(rows: DataFrame, column: str) -> DataFrame:
    """Every value with its rows; exact, nothing is cut off."""
    return rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("rows"))


def vocabulary_diff(published: DataFrame, vocab: DataFrame) -> DataFrame:
    """``value, side``: outside the vocabulary, or unused, which only informs."""
    p, v = published.select("value").distinct(), vocab.select("value").distinct()
    return p.join(v, "value", "left_anti").withColumn("side", F.lit("outside")).union(v.join(p, "value", "left_anti").withColumn("side", F.lit("unused")))


def orphan_addresses(paths: DataFrame, separator: str = "/") -> DataFrame:
    """Addresses whose parent address is not there."""
    known = paths.select("path").distinct()
    inner = known.filter(F.col("path").contains(separator)).withColumn("parent", F.regexp_replace("path", f"{separator}[^{separator}]*$", ""))
    return inner.join(known.select(F.col("path").alias("parent")), "parent", "left_anti").select("path")


def id_diff(published: DataFrame, built: DataFrame) -> DataFrame:
    """``id, side``: missing from the published table, or unexpected there."""
    p, b = published.select("id").distinct(), built.select("id").distinct()
    return b.join(p, "id", "left_anti").withColumn("side", F.lit("missing")).union(p.join(b, "id", "left_anti").withColumn("side", F.lit("unexpected")))


def missing_runs(positions: DataFrame, width: int = 1 << 20) -> DataFrame:
    """``first, last, ids``: runs of consecutive missing positions ``n``.

    Islands are found inside ranges of ``width`` positions and stitched where
    they touch, so no window holds all positions.
    """
    block = F.floor(F.col("n") / width)
    rows = positions.select("n").distinct().withColumn("block", block)
    rows = rows.withColumn("island", F.col("n") - F.row_number().over(Window.partitionBy("block").orderBy("n")))
    islands = rows.groupBy("block", "island").agg(F.min("n").alias("first"), F.max("n").alias("last"))
    # Only islands at a block's edge can go on; a block with a full island links its neighbours.
    by = Window.orderBy("first")
    edge = (F.col("first") % width == 0) | ((F.col("last") + 1) % width == 0)
    starts = islands.filter(edge).withColumn("new", F.when(F.lag("last").over(by) == F.col("first") - 1, 0).otherwise(1)).withColumn("run", F.sum("new").over(by))
    joined = starts.groupBy("run").agg(F.min("first").alias("first"), F.max("last").alias("last")).select("first", "last")
    return islands.filter(~edge).select("first", "last").union(joined).withColumn("ids", F.col("last") - F.col("first") + 1)


def run_summary(runs: DataFrame, least: int = 100, k: int = 10) -> DataFrame:
    """``metric, value``: how many runs there are, how many of ``least`` ids and more, the ids in those, and the ``k`` largest runs."""
    long = F.col("ids") >= least
    counts = runs.agg(F.count("*").alias("runs"), F.count_if(long).alias("long_runs"), F.coalesce(F.sum(F.when(long, F.col("ids"))), F.lit(0)).alias("ids_in_long_runs"))
    pairs = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("long").alias("value")) for c in counts.columns])
    top = runs.orderBy(F.desc("ids"), "first").limit(k).select(F.concat(F.lit("run "), "first", F.lit("-"), "last").alias("metric"), F.col("ids").cast("long").alias("value"))
    return counts.select(F.inline(pairs)).union(top)


def vocabulary_check(paths: DataFrame, labels: DataFrame, roots: DataFrame, declared: bool = True, separator: str = "/") -> DataFrame:
    """One row: values, segments outside ``labels``, heads that are no root, labels unused, orphan addresses, ``status``.

    ``paths(path)`` are the published addresses. Without the field declared the
    check is ``blind``: no value says nothing then. No value at all fails.
    Unused labels only inform.
    """
    known = paths.select("path").filter("path IS NOT NULL").distinct()
    segments = known.select(F.explode(F.split("path", separator)).alias("label")).distinct()
    heads = known.select(F.substring_index("path", separator, 1).alias("label")).distinct()
    of = lambda df, other: df.join(other.select("label").distinct(), "label", "left_anti").agg(F.count("*").alias("n"))
    out = known.agg(F.count("*").alias("values")).join(of(segments, labels).withColumnRenamed("n", "outside")).join(of(heads, roots).withColumnRenamed("n", "heads_outside_roots"))
    out = out.join(of(labels.select("label").distinct(), segments).withColumnRenamed("n", "unused")).join(orphan_addresses(known, separator).agg(F.count("*").alias("orphans")))
    bad = (F.col("values") == 0) | (F.col("outside") > 0) | (F.col("heads_outside_roots") > 0) | (F.col("orphans") > 0)
    return out.withColumn("status", F.lit("blind") if not declared else F.when(bad, "fail").otherwise("pass"))


def identity_sets(published: DataFrame, built: DataFrame) -> DataFrame:
    """One row: ids missing from the published table and unexpected there, ``status``; an empty read fails."""
    sides = id_diff(published, built).agg(F.count_if(F.col("side") == "missing").alias("missing"), F.count_if(F.col("side") == "unexpected").alias("unexpected"))
    out = sides.join(published.agg(F.count("*").alias("read")))
    return out.withColumn("status", F.when((F.col("missing") + F.col("unexpected") > 0) | (F.col("read") == 0), "fail").otherwise("pass"))


def verdicts(**checks: DataFrame | None) -> DataFrame:
    """``check, status`` over frames with a status column; a check fails with any of its rows, and passes if none fails.

    A check that was not run (None) is ``skipped``; one that could not see, blind or without records, is unverifiable.
    """
    out = None
    for name, df in checks.items():
        if df is None:
            continue
        bad, unknown = F.coalesce(F.max((F.col("status") == "fail").cast("int")), F.lit(1)), F.max(F.col("status").isin("unverifiable", "blind").cast("int"))
        row = df.agg(F.when(bad == 1, "fail").when(unknown == 1, "unverifiable").otherwise("pass").alias("status")).select(F.lit(name).alias("check"), "status")
        out = row if out is None else out.union(row)
    skipped = [k for k, df in checks.items() if df is None]
    if skipped and out is not None:
        rows = F.array(*[F.struct(F.lit(k).alias("check"), F.lit("skipped").alias("status")) for k in skipped])
        out = out.union(out.sparkSession.range(1).select(F.inline(rows)))
    return out


def reconciled(published: DataFrame, built: DataFrame, paths: DataFrame, labels: DataFrame, roots: DataFrame, wanted: list[str], covered: str, found: dict[str, str], manifest: DataFrame, ids: bool = True) -> DataFrame:
    """All six checks in order: schema, identity, count, coverage, vocabulary, ids. Those that read a field which the
    schema does not declare are skipped, and the comparison of ids unless ``ids`` asks for it."""
    have = set(field_names(published.schema))
    return verdicts(
        schema=schema_check(published, wanted), identity=identity_check(found, manifest), count=count_check(published, built), coverage=coverage_check(published, covered) if covered in have else None,
        vocabulary=vocabulary_check(paths, labels, roots), ids=identity_sets(published, built) if ids else None,
    )
