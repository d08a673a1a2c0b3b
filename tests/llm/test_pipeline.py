"""The pipeline's stages, each on what the one before it kept."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from shelfspark.llm import bpe, exact, near
from shelfspark.session import cut
from tests.conftest import SF


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(cut(stage(spark, kept[-1], SF), "test"))
        if name != "bpe":
            assert kept[-1].columns == columns
    ids = [Counter(r.doc_id for r in x.select("doc_id").collect()) for x in kept]
    assert ids[1].keys() <= ids[0].keys()
    assert set(ids[2]) == {r.doc_id for r in exact.exact_groups(kept[1]).filter("kept").collect()}
    assert set(ids[3]) == {r.doc_id for r in near.near_classes(kept[2]).filter("kept").collect()}
    assert max(ids[4].values()) <= 3 and ids[5] == ids[4]
    codec, texts = bpe.Codec(bpe.default_path()), {r.doc_id: r.text for r in kept[4].collect()}
    assert all(codec.decode(r.ids) == texts[r.doc_id] for r in kept[5].collect())


def test_the_whole_run(spark):
    """``run`` gives what its stages give one after the other, and its ids decode to the texts of the documents."""
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = corpus_pipeline.run(spark, SF).collect()
    codec = bpe.Codec(bpe.default_path())
    assert rows and max(Counter(r.doc_id for r in rows).values()) <= 3
    assert all(codec.decode(r.ids) == docs[r.doc_id] and r.n_tokens == len(r.ids) for r in rows)


def test_stages_on_odd_tables(spark):
    """Nulls, empty and long texts, repeated rows, an empty table and clashing columns through all stages in a row."""
    rows = [(None, None, None, None), (None, "", "en", "s"), (1, "a b c d e f g", "en", "s"), (1, "a b c d e f g", "en", "s"), (2, "a  b c d e f g", "fr", None), (3, "word " * 20_000, None, "t"), (4, "one more text of seven words", "en", "t")]
    docs = spark.createDataFrame([(i, t, lang, s, None) for i, t, lang, s in rows], "doc_id long, text string, lang string, source string, n_chars long").withColumns({c: F.lit("own") for c in ("k_", "score", "h", "row", "n_", "id", "hash", "size")})
    for x in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = cut(stage(spark, x, SF), "odd")
            assert out.columns == docs.columns and out.filter("score <> 'own' OR hash <> 'own' OR row <> 'own'").isEmpty()
            x = out
        assert corpus_pipeline.encode(spark, x, SF).count() == x.count()
    assert x.isEmpty()
