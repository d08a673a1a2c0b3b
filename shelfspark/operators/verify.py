"""Checks of a finished catalog: rows, segments, metrics, and the verdict."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.operators.graph import SEPARATOR


@dataclass(frozen=True)
class Tolerance:
    """How many failures are agreed to: a count, else a share of what was counted, else none."""

    count: int | None = None
    fraction: float | None = None

    def problem(self) -> str | None:
        if self.count is not None and self.count < 0:
            return "the count must not be negative"
        if self.fraction is not None and not 0 <= self.fraction <= 1:
            return "the fraction must be between 0 and 1"
        return None

    def permitted(self, counted: int) -> int:
        if problem := self.problem():
            raise ValueError(problem)
        return self.count if self.count is not None else math.floor((self.fraction or 0) * counted)

    def column(self, counted: Column) -> Column:
        """``permitted`` for a counted column."""
        self.permitted(0)
        return F.lit(self.count).cast("long") if self.count is not None else F.floor(F.lit(self.fraction or 0.0) * counted).cast("long")

    def describe(self, counted: int) -> str:
        if self.count is not None:
            return f"count {self.count}"
        return f"fraction {self.fraction:g} ({self.permitted(counted)} of {counted})" if self.fraction is not None else "0 (none)"


def parent_path(p: Column) -> Column:
    return F.regexp_replace(p, f"{SEPARATOR}[^{SEPARATOR}]*$", "")


def union_violation(path: Column) -> Column:
    """Why a path list is no union closed under prefixes: the first of duplicate, empty, trailing separator, missing ancestor."""
    return (
        F.when(F.size(path) != F.size(F.array_distinct(path)), "duplicate")
        .when(F.exists(path, lambda p: p == ""), "empty")
        .when(F.exists(path, lambda p: p.endswith(SEPARATOR)), "trailing_separator")
        .when(F.exists(path, lambda p: p.contains(SEPARATOR) & ~F.array_contains(path, parent_path(p))), "missing_ancestor")
    )


def chain_violation(primary: Column) -> Column:
    """Why a primary is no single chain: each value must be the one before it and one segment more."""
    broken = F.exists(F.sequence(F.lit(0), F.size(primary) - 1), lambda i: F.when(i == 0, F.get(primary, i).contains(SEPARATOR) | (F.get(primary, i) == "")).otherwise(
        (parent_path(F.get(primary, i)) != F.get(primary, i - 1)) | ~F.get(primary, i).contains(SEPARATOR) | F.get(primary, i).endswith(SEPARATOR)))
    return F.when(F.size(primary) == 0, "no_chain").when(broken, "broken_chain")


def row_violations(docs: DataFrame) -> DataFrame:
    """``docs`` with ``union_bad``, ``chain_bad``: null where the row is fine; rows without any path are not judged."""
    path, primary = F.col("category_path"), F.coalesce("category_path_primary", F.array().cast("array<string>"))
    has = F.coalesce(F.size(path) > 0, F.lit(False))
    head = F.when(F.size(primary) == 0, "no_primary").when(F.slice(path, 1, F.greatest(F.size(primary), F.lit(1))) != primary, "not_headed_by_primary")
    return docs.withColumn("union_bad", F.when(has, F.coalesce(union_violation(path), head))).withColumn("chain_bad", F.when(has & (F.size(primary) > 0), chain_violation(primary)))


def segment_checks(checked: DataFrame, roots: DataFrame, labels: DataFrame) -> DataFrame:
    """One row: segments at several primary addresses, unanchored chains, values outside the vocabulary.

    Chains count where they parsed; tags of all rows are values, segments only
    those of rows whose union parsed.
    """
    chains = checked.filter("size(category_path) > 0 AND chain_bad IS NULL AND size(category_path_primary) > 0")
    steps = chains.select(F.explode("category_path_primary").alias("address")).withColumn("segment", F.substring_index("address", SEPARATOR, -1))
    several = steps.groupBy("segment").agg(F.countDistinct("address").alias("n")).agg(F.count_if(F.col("n") > 1).alias("several_primary_addresses"))
    heads = chains.select(F.get("category_path_primary", F.lit(0)).alias("label")).join(roots.select("label").distinct(), "label", "left_anti").agg(F.count("*").alias("unanchored_chains"))
    counted = _values(checked).groupBy("label").agg(F.count("*").alias("n"))
    outside = counted.join(labels.select("label").distinct(), "label", "left_anti").agg(F.count("*").alias("values_outside"), F.coalesce(F.sum("n"), F.lit(0)).alias("instances_outside"))
    return several.join(heads).join(counted.agg(F.count("*").alias("values_checked"))).join(outside)


def _values(checked: DataFrame) -> DataFrame:
    """Tags of all rows, and segments of those whose union parsed."""
    paths = checked.filter("size(category_path) > 0 AND union_bad IS NULL").select(F.explode("category_path").alias("p"))
    return checked.select(F.explode("taxonomy_tags").alias("label")).union(paths.select(F.substring_index("p", SEPARATOR, -1)))


def outside_values(checked: DataFrame, labels: DataFrame, k: int = 5) -> DataFrame:
    """``label, instances``: the ``k`` commonest values that are no label, ties by value."""
    counted = _values(checked).groupBy("label").agg(F.count("*").alias("instances"))
    return counted.join(labels.select("label").distinct(), "label", "left_anti").orderBy(F.desc("instances"), "label").limit(k)


def metrics(checked: DataFrame) -> DataFrame:
    """One row: records, ids, coverage, violations, path sizes. A missing id counts as empty text."""
    has = F.coalesce(F.size("category_path") > 0, F.lit(False))
    n = F.when(has, F.size("category_path"))
    ids = F.countDistinct(F.coalesce("id", F.lit("")))
    return checked.agg(
        F.count("*").alias("records"), ids.alias("distinct_ids"), (F.count("*") - ids).alias("duplicate_ids"), F.count_if(has).alias("with_path"),
        F.count("union_bad").alias("union_violations"), F.count("chain_bad").alias("chain_violations"), F.coalesce(F.round(F.avg(n), 3), F.lit(0.0)).alias("mean_values"), F.coalesce(F.max(n), F.lit(0)).alias("max_values"),
    )


def depth_histogram(docs: DataFrame) -> DataFrame:
    return docs.filter("size(category_path_primary) > 0").groupBy(F.size("category_path_primary").alias("depth")).agg(F.count("*").alias("rows"))


def gate(measured: DataFrame, tolerance: Tolerance = Tolerance(), unique_ids: bool = False) -> DataFrame:
    """``check, failed``, one row a check; where nothing was verified that alone is said."""
    nothing = (F.col("records") == 0) | (F.col("values_checked") == 0)
    checks = {
        "nothing_verified": nothing, "single_primary_chain": F.col("chain_violations") > 0, "prefix_closed_union": F.col("union_violations") > 0,
        "one_primary_address": F.col("several_primary_addresses") > 0, "anchoring": F.col("unanchored_chains") > 0, "vocabulary": F.col("values_outside") > tolerance.column(F.col("values_checked")),
    } | ({"unique_ids": F.col("duplicate_ids") > 0} if unique_ids else {})
    rows = F.array(*[F.struct(F.lit(k).alias("check"), v.alias("failed")) for k, v in checks.items()])
    return measured.select(nothing.alias("nothing"), F.explode(rows).alias("c")).filter("NOT nothing OR c.check = 'nothing_verified'").select("c.check", "c.failed")
