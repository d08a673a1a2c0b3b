"""Publishing: update-only merges, generation copies, and the manifest, with every row accounted for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.operators.verify import Tolerance


def outcomes(target: DataFrame, updates: DataFrame, columns: list[str], skip_empty: bool = True) -> DataFrame:
    """``id, outcome`` for each update id: empty, conflict, not_found, noop or updated. Records without id are not counted.

    An update is empty if its first column is null, blank or an empty list;
    ids with more than one update are conflicts and change nothing.
    """
    one = _single(updates, columns)
    found = one.join(target.select("id", F.lit(True).alias("there"), *[F.col(c).alias(f"old_{c}") for c in columns]), "id", "left")
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"old_{c}"))
    kind = F.when(F.col("n") > 1, "conflict")
    if skip_empty:
        kind = kind.when(_empty(updates, columns[0]), "empty")
    return found.select("id", kind.when(F.col("there").isNull(), "not_found").when(same, "noop").otherwise("updated").alias("outcome"))


def _single(updates: DataFrame, columns: list[str]) -> DataFrame:
    both = F.min(F.struct(*columns)).alias("u")
    return updates.filter("id IS NOT NULL").groupBy("id").agg(F.count("*").alias("n"), both).select("id", "n", *[F.col(f"u.{c}").alias(c) for c in columns])


def _empty(updates: DataFrame, column: str) -> Column:
    return F.coalesce(F.size(column) == 0 if updates.schema[column].dataType.typeName() == "array" else F.trim(F.col(column).cast("string")) == "", F.lit(True))


def merged(target: DataFrame, updates: DataFrame, columns: list[str], skip_empty: bool = True) -> DataFrame:
    """``target`` with the updates of ids it has; the columns move together, nothing is inserted."""
    one = _single(updates, columns).filter("n = 1")
    one = one.filter(~_empty(updates, columns[0])) if skip_empty else one
    new = one.select("id", F.struct(*columns).alias("new_"))
    rows = target.join(new, "id", "left")
    return rows.withColumns({c: F.when(F.col("new_").isNotNull(), F.col(f"new_.{c}")).otherwise(F.col(c)) for c in columns}).drop("new_").select(*target.columns)


def merge_gate(outcome: DataFrame, tolerance: Tolerance = Tolerance()) -> DataFrame:
    """One row of counts with ``status``: nothing sent and nothing applied fail whatever is tolerated."""
    count = {k: F.count_if(F.col("outcome") == k).alias(k) for k in ("updated", "noop", "not_found", "conflict", "empty")}
    out = outcome.agg(*count.values()).withColumn("sent", F.col("updated") + F.col("noop") + F.col("not_found") + F.col("conflict")).withColumn("applied", F.col("updated") + F.col("noop"))
    bad = (F.col("sent") == 0) | (F.col("applied") == 0) | (F.col("not_found") + F.col("conflict") > tolerance.column(F.col("sent")))
    return out.withColumn("status", F.when(bad, "fail").otherwise("pass"))


def next_generation(source: DataFrame, column: str, kind: str) -> DataFrame:
    """The rows of the next generation: with a null column of that type where it is absent."""
    return source if column in source.columns else source.withColumn(column, F.lit(None).cast(kind))


def copy_generation(source: DataFrame, path: str, column: str, kind: str, overwrite: bool = False) -> None:
    """Writes the next generation; an empty source is refused, and an existing destination unless asked for."""
    if source.isEmpty():
        raise ValueError("the source is empty: nothing to copy")
    next_generation(source, column, kind).write.mode("overwrite" if overwrite else "errorifexists").parquet(path)


def copy_gate(source: DataFrame, copy: DataFrame, tolerance: Tolerance = Tolerance()) -> DataFrame:
    """One row: rows in both, ids missing from the copy, ``status``. More rows than the source, or none, fail."""
    counts = source.agg(F.count("*").alias("source_rows")).join(copy.agg(F.count("*").alias("copied_rows"))).join(source.join(copy, "id", "left_anti").agg(F.count("*").alias("missing")))
    bad = (F.col("missing") > tolerance.column(F.col("source_rows"))) | (F.col("copied_rows") > F.col("source_rows")) | (F.col("copied_rows") == 0)
    return counts.withColumn("status", F.when(bad, "fail").otherwise("pass"))


def fingerprint(name: str, df: DataFrame) -> DataFrame:
    """``entry, rows, fingerprint``: the same for the same rows in any order; a repeated row counts each time.

    The sum of the first 52 bits of every row's MD5, taken over its JSON text.
    """
    mark = F.conv(F.substring(F.md5(F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"}).cast("binary")), 1, 13), 16, 10).cast("decimal(20,0)")
    out = df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(mark), F.lit(0)).cast("decimal(38,0)").cast("string").alias("fingerprint"))
    return out.select(F.lit(name).alias("entry"), "rows", "fingerprint")


def manifest(tables: dict[str, DataFrame], nodes: DataFrame | None = None, roots: DataFrame | None = None) -> DataFrame:
    """``entry, rows, fingerprint``: a row for each table of a build, and the taxonomy's nodes and global roots."""
    rows = [fingerprint(name, df) for name, df in tables.items()]
    rows += [fingerprint(name, df.select("id")) for name, df in (("taxonomy nodes", nodes), ("taxonomy roots", roots)) if df is not None]
    out = rows[0]
    for x in rows[1:]:
        out = out.union(x)
    return out


def pin_check(found: DataFrame, pinned: DataFrame) -> DataFrame:
    """``check, status, reason`` for each entry of ``found``, a manifest: pass or fail by the fingerprint that
    ``pinned(entry, fingerprint)`` has; a null there waives the check on purpose, a missing entry fails."""
    rows = found.join(pinned.select("entry", F.col("fingerprint").alias("expected"), F.lit(True).alias("there")), "entry", "left")
    waived = F.col("there") & F.col("expected").isNull()
    status = F.when(waived | (F.col("fingerprint") == F.col("expected")), "pass").otherwise("fail")
    reason = F.when(waived, "waived").when(F.col("there").isNull(), "not pinned").when(F.col("fingerprint") == F.col("expected"), "as pinned").otherwise("differs")
    return rows.select(F.col("entry").alias("check"), status.alias("status"), reason.alias("reason"))
