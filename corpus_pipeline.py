"""The corpus pipeline: toxicity, exact and near duplicates, mixing, encoding.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage
before it kept; what a stage returns is written as Parquet and read again as
the next one's input. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.llm import bpe, exact, mix, near, toxic
from shelfspark.session import cut


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic; texts without words are not."""
    return toxic.clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, up to white space, the row with the smallest doc_id."""
    return exact.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the row with the smallest doc_id."""
    return near.deduplicated(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them."""
    return mix.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per row, with its token ids and their digests; ids decode to the whole text again."""
    return bpe.encode_documents(docs, keep_ids=True)


STAGES = [("toxicity", drop_toxic), ("exact dedup", drop_copies), ("near dedup", drop_near_copies), ("mixing", mix_sources), ("bpe", encode)]

#: A trained network, sampling and byte-pair merges are beyond SQL; tests compare each stage's operator with brute force,
#: the stages with their operators, and the run with its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
