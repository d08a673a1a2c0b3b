"""Taxonomy and pricing files, and the gate that pins a snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.functions.pricing import Bucket, PricingConfig
from shelfspark.session import cut
from shelfspark.sources import objects



def read_taxonomy(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``nodes(id, name)`` and ``edges(child, parent)`` of a JSON object by node id; another top level is an error.
    Files of any size: they are read in parts."""
    rows = objects.entries(spark, path).filter(F.schema_of_variant("value").startswith("OBJECT"))
    field = lambda p, kind: F.try_variant_get("value", p, kind)
    rows = cut(rows.select(F.col("key").alias("id"), field("$.name", "map<string, string>").alias("name"), field("$.parents", "array<string>").alias("parents")), "taxonomy")
    return rows.select("id", "name"), rows.select(F.col("id").alias("child"), F.explode("parents").alias("parent"))


def snapshot_verdict(spark: SparkSession, path: str, expected: str | None) -> DataFrame:
    """``check, status, reason``: whether the file's SHA-256 is the expected one; ``None`` waives that on purpose."""
    found = spark.read.format("binaryFile").load(path).select(F.sha2("content", 256).alias("digest"))
    status = F.lit("pass") if expected is None else F.when(F.col("digest") == expected, "pass").otherwise("fail")
    reason = F.lit("waived") if expected is None else F.concat(F.lit("sha256 "), "digest")
    return found.select(F.lit("snapshot").alias("check"), status.alias("status"), reason.alias("reason"))


def read_pricing(spark: SparkSession, path: str) -> PricingConfig:
    """A pricing file of a few dozen numbers; missing fields take their defaults, and ``default`` always exists."""
    import json

    x = json.loads(spark.read.option("wholetext", True).text(path).first().value)
    base = PricingConfig()
    buckets = {k: Bucket(b.get("unit", "kg"), float(b.get("median_unit_price", 10)), float(b.get("sigma", 0.55)), b.get("default_qty_g"), b.get("default_qty_ml")) for k, b in (x.get("buckets") or {}).items()}
    return PricingConfig(
        x.get("currency", base.currency), tuple(map(float, x.get("rounding_endings", base.endings))), float(x.get("min_price", base.least)), float(x.get("max_price", base.most)),
        {k: float(v) for k, v in (x.get("premium_multipliers") or {}).items()}, {"default": Bucket(grams=250, ml=500)} | buckets,
    )


def read_price_buckets(spark: SparkSession, path: str) -> DataFrame:
    """``bucket, unit, median, sigma, grams, ml``: the buckets of a pricing file of any size, as rows; missing fields
    take their defaults, and ``default`` always exists."""
    base = Bucket()
    number = lambda p: F.try_variant_get("value", p, "double")
    rows = objects.entries(spark, path, key="buckets").select(
        F.col("key").alias("bucket"), F.coalesce(F.try_variant_get("value", "$.unit", "string"), F.lit(base.unit)).alias("unit"), F.coalesce(number("$.median_unit_price"), F.lit(float(base.median))).alias("median"),
        F.coalesce(number("$.sigma"), F.lit(float(base.sigma))).alias("sigma"), number("$.default_qty_g").alias("grams"), number("$.default_qty_ml").alias("ml"),
    )
    rows = cut(rows, "buckets")
    own = spark.range(1).select(F.lit("default").alias("bucket"), F.lit(base.unit).alias("unit"), F.lit(float(base.median)).alias("median"), F.lit(float(base.sigma)).alias("sigma"), F.lit(250.0).alias("grams"), F.lit(500.0).alias("ml"))
    return rows.union(own.join(rows.filter("bucket = 'default'").select("bucket"), "bucket", "left_anti"))
