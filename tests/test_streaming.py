from __future__ import annotations

from pyspark.sql import functions as F

from shelfspark.streaming import products


def test_stream_gates_each_line_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text('{"code": "1", "t": "x"}\n{"code": "2"}\nbad\n[]\n')
    (tmp_path / "in/b.json").write_text('{"code": "3", "t": "y"}\n')
    missing = F.expr("try_variant_get(v, '$.t', 'string')").isNull()
    rows = products.stream(spark, str(tmp_path / "in"), {"missing_title": missing}, files=1)
    products.write(rows, str(tmp_path / "out"), str(tmp_path / "audit"), str(tmp_path / "check")).awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    counts = {r.reason: r.n for r in spark.read.parquet(str(tmp_path / "audit")).groupBy("reason").agg(F.sum("products").alias("n")).collect()}
    assert counts == {"written": 2, "missing_title": 1, "bad_json": 1}
