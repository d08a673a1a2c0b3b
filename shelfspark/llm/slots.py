"""Sharding by fixed virtual slots.

Records hash into a fixed number of slots; a versioned map assigns slots to
shards. Adding a shard edits the map: the new shard takes an equal share of
slots from the fullest shards and no other slot moves. A record's shard hence
depends on its key and the shard count alone. Rebalancing edits a map by the
bytes that lie in each slot and stores the next version.
"""

from __future__ import annotations

import heapq
import zlib
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfspark.llm.rows import free_names
from shelfspark.session import cut

N_SLOTS = 8192


def grow(assigned: tuple[int, ...], shards: int) -> tuple[int, ...]:
    """The map with one more shard, which takes ``len // (shards + 1)`` slots from the fullest shards."""
    order = sorted(range(len(assigned)), key=lambda s: zlib.crc32(f"{s}:{shards}".encode()))
    of: dict[int, list[int]] = {k: [] for k in range(shards)}
    for s in reversed(order):
        of[assigned[s]].append(s)
    heap = [(-len(v), k) for k, v in of.items()]
    heapq.heapify(heap)
    out = list(assigned)
    for _ in range(len(assigned) // (shards + 1)):
        n, k = heapq.heappop(heap)
        out[of[k].pop()] = shards
        heapq.heappush(heap, (n + 1, k))
    return tuple(out)


@lru_cache
def slot_map(shards: int, n_slots: int = N_SLOTS) -> tuple[int, ...]:
    """Version ``shards`` of the map: the map of one shard, edited once for each shard added."""
    if not 1 <= shards <= n_slots:
        raise ValueError("the shard count must be between 1 and the number of slots")
    return (0,) * n_slots if shards == 1 else grow(slot_map(shards - 1, n_slots), shards - 1)


def rebalance(assigned: tuple[int, ...], bytes_of: dict[int, int], tolerance: float = 0.05) -> tuple[int, ...]:
    """An edited map in which no shard exceeds the mean bytes by more than ``tolerance``, where single slots allow it.

    Moves the fewest slots it can find: from each too full shard, its largest
    slot that fits goes to the emptiest shard. The input is one number a slot.
    """
    out, shards = list(assigned), max(assigned) + 1
    load = [0] * shards
    for s, k in enumerate(assigned):
        load[k] += bytes_of.get(s, 0)
    most = sum(load) / shards * (1 + tolerance)
    for k in sorted(range(shards), key=lambda k: -load[k]):
        for s in sorted((s for s in range(len(out)) if out[s] == k), key=lambda s: -bytes_of.get(s, 0)):
            to = min(range(shards), key=load.__getitem__)
            if load[k] <= most:
                break
            if (b := bytes_of.get(s, 0)) and load[to] + b <= most:
                out[s], load[k], load[to] = to, load[k] - b, load[to] + b
    return tuple(out)


def slot_of(key: Column, n_slots: int = N_SLOTS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_slots)).cast("int")


def map_table(spark: SparkSession, versions: list[tuple[int, tuple[int, ...]]]) -> DataFrame:
    """Rows ``(version, virtual_slot, shard)``; each version has one row a slot."""
    texts = F.array(*[F.struct(F.lit(v).alias("version"), F.lit(",".join(map(str, m))).alias("shards")) for v, m in versions])
    rows = spark.range(1).select(F.inline(texts)).select("version", F.posexplode(F.split("shards", ",")).alias("virtual_slot", "shard"))
    return rows.withColumn("shard", F.col("shard").cast("int"))


def store_map(spark: SparkSession, path: str, version: int, assigned: tuple[int, ...]) -> None:
    """Adds a version to the stored map; a version is written once."""
    map_table(spark, [(version, assigned)]).coalesce(1).write.mode("errorifexists").parquet(f"{path}/version={version}")


def stored_map(spark: SparkSession, path: str, version: int | None = None) -> tuple[int, tuple[int, ...]]:
    """The latest or the given version; one number a slot."""
    rows = spark.read.parquet(path)
    version = rows.agg(F.max("version")).first()[0] if version is None else version
    return version, tuple(r.shard for r in rows.filter(F.col("version") == version).orderBy("virtual_slot").collect())


def slot_bytes(base: DataFrame) -> dict[int, int]:
    """Bytes by virtual slot of rows with ``virtual_slot, size``: one number a slot."""
    return {r.virtual_slot: r.b for r in base.groupBy("virtual_slot").agg(F.sum("size").alias("b")).collect()}


def rebalanced(rows: DataFrame, key: Column, size: Column, path: str, tolerance: float = 0.05) -> int:
    """Sums the bytes of ``rows`` by slot, edits the latest stored map by them, stores it as the next version and returns that."""
    version, assigned = stored_map(rows.sparkSession, path)
    base = rows.select(slot_of(key, len(assigned)).alias("virtual_slot"), size.cast("long").alias("size"))
    store_map(rows.sparkSession, path, version + 1, rebalance(assigned, slot_bytes(base), tolerance))
    return version + 1


def shard(rows: DataFrame, key: Column, size: Column, order: list[Column], shards: int, n_slots: int = N_SLOTS, assigned: tuple[int, ...] | None = None) -> DataFrame:
    """``rows`` with ``size, virtual_slot, slot_rows, slot_bytes, shard, slot, grown_shard, balanced_shard``.

    ``key`` decides the shard; it may not be null (give rows without a key a
    stand-in that spreads them). ``slot`` numbers the rows of a shard from 0
    without gaps, by virtual slot and ``order``; rows that tie in all of
    ``order`` get their numbers in any order. ``grown_shard`` is the shard with
    one shard more, ``balanced_shard`` that of the map edited by the slots'
    bytes. No row leaves the table; an empty table stays empty. Columns named
    as the added ones are replaced. ``assigned`` is the map to use, a stored
    one maybe; without it, it is version ``shards``, so that key and shard count
    alone decide.

    Only narrow rows move, once, by virtual slot: a hot source, text or group
    spreads over all slots as its keys do, and repeats of one key share a slot.
    The tables joined by broadcast have ``n_slots`` rows, whatever the input.
    """
    spark = rows.sparkSession
    assigned = slot_map(shards, n_slots) if assigned is None else assigned
    added = ["virtual_slot", "slot_rows", "slot_bytes", "shard", "slot", "grown_shard", "balanced_shard"]
    start, place = free_names(rows, "start", "place")
    base = cut(rows.withColumns({"size": size.cast("long"), "virtual_slot": slot_of(key, n_slots)}).drop(*added[1:]), "slots")
    used = cut(base.groupBy("virtual_slot").agg(F.count("*").alias("slot_rows"), F.sum("size").alias("slot_bytes")), "used")
    balanced = rebalance(assigned, {r.virtual_slot: r.slot_bytes for r in used.select("virtual_slot", "slot_bytes").collect()})
    maps = map_table(spark, [(0, assigned), (1, grow(assigned, shards)), (2, balanced)])
    of = maps.groupBy("virtual_slot").agg(*[F.max(F.when(F.col("version") == v, F.col("shard"))).alias(c) for v, c in enumerate(("shard", "grown_shard", "balanced_shard"))])
    slots = of.join(used, "virtual_slot")
    before = F.sum("slot_rows").over(Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1))
    slots = slots.withColumn(start, F.coalesce(before, F.lit(0)))
    at = F.row_number().over(Window.partitionBy("virtual_slot").orderBy(*order))
    return base.withColumn(place, at - 1).join(F.broadcast(slots), "virtual_slot").withColumn("slot", (F.col(start) + F.col(place)).cast("long")).drop(start, place)


def shard_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """All documents dealt to shards by ``doc_id``: law ``key``, by which doc_id and shard count alone decide.

    Null text counts as empty (16 bytes, CRC 0). Rows without a doc_id have no
    key; they are spread by their text's CRC, which then stands in for it.
    Repeated rows all stay.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.crc32(text.cast("binary")).alias("text_crc32"), (F.octet_length(text) + 16).alias("size"))
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("no id "), F.col("text_crc32")))
    out = shard(rows, key, F.col("size"), [F.col("doc_id"), F.col("text_crc32"), F.col("size")], shards)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard", "balanced_shard", "virtual_slot", "slot_rows", "slot_bytes", F.lit(shards).alias("map_version")
    )
