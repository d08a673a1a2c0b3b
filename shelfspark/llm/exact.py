"""Exact duplicates by deterministic block naming.

A normalised text is cut into blocks of a fixed number of characters. Sorting
the distinct blocks gives each an integer name; then the names of adjacent
blocks are paired, the distinct pairs sorted and named, until one name is left.
Two texts end at the same level with the same name exactly if they are equal:
names come from comparing content, so no hash can collide.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.llm.rows import id_key, one_of_each
from shelfspark.session import cut

BLOCK = 4096
#: Blocks that a task remembers from one batch to the next at most.
COMMON = 4096
#: Names are a bucket in the high bits and the rank in the bucket in the low ones.
BUCKETS, RANK_BITS = 1 << 20, 40
_SPACE = re.compile(r"[ \t-\r]{2,}|[\t-\r]")

_LOCAL = "gid long, sha string, docs array<long>, first int, refs array<long>, blocks array<struct<lid: long, block: string>>"
_SCHEMA = pa.schema([
    ("gid", pa.int64()), ("sha", pa.string()), ("docs", pa.list_(pa.int64())), ("first", pa.int32()), ("refs", pa.list_(pa.int64())),
    ("blocks", pa.list_(pa.struct([("lid", pa.int64()), ("block", pa.string())]))),
])


def normalise(text: str | None) -> str:
    """Each run of ``[\\x20\\x09-\\x0D]`` becomes one space; null is empty."""
    return _SPACE.sub(" ", text) if text else ""


def _local(block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Equal texts and equal blocks of one batch become one, and common blocks go on to the next batch, so that
        copies do not pile up behind a key."""
        next_id = TaskContext.get().partitionId() << RANK_BITS
        common: dict[str, int] = {}  # blocks that came again, for the batches to come
        for batch in batches:
            groups: dict[str, list] = {}
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                groups.setdefault(normalise(text), []).append(doc_id)
            named, again = dict(common), {}
            rows = []
            for text, ids in groups.items():
                refs, fresh = [], []
                for i in range(0, max(1, len(text)), block):
                    piece = text[i : i + block]
                    if (lid := named.get(piece)) is None:
                        lid = named[piece] = next_id
                        next_id += 1
                        fresh.append({"lid": lid, "block": piece})
                    elif len(again) < COMMON:
                        again[piece] = lid
                    refs.append(lid)
                first = min(range(len(ids)), key=lambda k: (ids[k] is None, ids[k] or 0))
                rows.append({"gid": next_id, "sha": hashlib.sha256(text.encode()).hexdigest(), "docs": ids, "first": first, "refs": refs, "blocks": fresh})
                next_id += 1
            common = again
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)

    return run


def name_sorted(rows: DataFrame, *by: str) -> Column:
    """An integer for each distinct value of ``by``: its rank among the values in its bucket, under the bucket's number."""
    bucket = F.pmod(F.xxhash64(*by), F.lit(BUCKETS))
    rank = F.dense_rank().over(Window.partitionBy(bucket).orderBy(*by))
    return F.shiftleft(bucket, RANK_BITS) + rank


def exact_groups(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when they are after ``normalise``; null counts as empty.
    Of equal texts the row with the smallest doc_id stays, rows without a
    doc_id come last, and of repeated rows with that doc_id exactly one stays.
    Empty texts are one group. An empty table gives an empty result; other
    columns are not read.

    A batch of rows sends each distinct text and block once, so a group that
    holds a third of the table is a few rows a task in every shuffle here.
    """
    local = cut(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_local(block), _LOCAL), "texts")
    blocks = local.select(F.explode("blocks").alias("b")).select("b.lid", "b.block")
    names = blocks.select("lid", name_sorted(blocks, "block").alias("name"))
    refs = local.select("gid", F.posexplode("refs").alias("pos", "lid"), F.size("refs").alias("n"))
    now = cut(refs.join(names, "lid").select("gid", "pos", "name", "n"), "names")
    done, level = [], 0
    while True:
        done.append(now.filter("n = 1").select("gid", F.lit(level).alias("level"), "name"))
        rest = now.filter("n > 1")
        if rest.isEmpty():
            break
        pairs = rest.groupBy("gid", F.expr("pos div 2").alias("pos")).agg(
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"), F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"), F.expr("(first(n) + 1) div 2").alias("n")
        )
        pairs = cut(pairs, "pairs")
        distinct = pairs.select("a", "b").distinct()
        fresh = distinct.select("a", "b", name_sorted(distinct, "a", "b").alias("name"))
        now = cut(pairs.join(fresh, ["a", "b"]).select("gid", F.col("pos").cast("int").alias("pos"), "name", F.col("n").cast("int").alias("n")), "names")
        level += 1
    identity = done[0]
    for x in done[1:]:
        identity = identity.union(x)
    keys = local.select("gid", "docs", "first", "sha")
    first = F.element_at("docs", F.col("first") + 1)
    members = keys.select("gid", F.size("docs").alias("n"), F.struct(first.isNull().alias("none"), first.alias("doc_id"), F.col("gid").alias("gid")).alias("best")).join(identity, "gid")
    kept = members.groupBy("level", "name").agg(F.min("best").alias("keep"), F.sum("n").alias("group_size"))
    of = cut(members.select("gid", "level", "name").join(kept, ["level", "name"]).select("gid", "keep", "group_size"), "kept")
    rows = keys.join(of, "gid").select("gid", "first", "sha", "keep", "group_size", F.posexplode("docs").alias("at", "doc_id"))
    return rows.select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), F.col("group_size").cast("long").alias("group_size"),
        ((F.col("gid") == F.col("keep.gid")) & (F.col("at") == F.col("first"))).alias("kept"), F.col("sha").alias("text_sha256"),
    )


def deduplicated(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` that ``exact_groups`` keeps, with all their columns; the text moves once more.

    Rows equal in id and normalised text count as one; where they differ in
    something else, one is kept by a hash of its values, the same in every run.
    A null id is an id of its own.
    """
    kept = exact_groups(docs, block).filter("kept").select(*[c.alias(n) for n, c in id_key().items()], F.col("text_sha256").alias("sha")).distinct()
    norm = F.regexp_replace(F.coalesce(F.col("text").cast("string"), F.lit("")), r"[ \x09-\x0D]{2,}|[\x09-\x0D]", " ")
    return one_of_each(docs, id_key() | {"sha": F.sha2(norm.cast("binary"), 256)}, kept)
