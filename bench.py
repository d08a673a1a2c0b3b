"""Headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import Observation
from pyspark.sql import functions as F

from shelfspark.plans import registry
from shelfspark.session import local_session, scope

HEADLINE = ["gate_funnel", "json_scan", "deshout_text", "canonical_parent", "all_addresses", "curate_tags", "address_union", "tag_cap", "estimate_price", "parse_quantity", "verify_metrics", "id_diff", "merge_update_only", "missing_runs", "extract_documents"]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf}/lineitem.parquet").selectExpr("sum(l_quantity)").collect()
    took, rows = {}, {}
    for name in HEADLINE:
        began, seen = time.time(), Observation()
        with scope(spark):
            # Into the sink that drops its input: every column of every row is computed.
            registry.QUERIES[name](spark, sf).observe(seen, F.count(F.lit(1)).alias("rows")).write.format("noop").mode("overwrite").save()
        rows[name] = seen.get["rows"]
        took[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "rows": rows, "cpus": cpus, "sf": os.path.basename(sf)}))


if __name__ == "__main__":
    main()
