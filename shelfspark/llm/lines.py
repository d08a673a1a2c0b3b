"""Repeated runs of lines by a suffix array over line ids.

Every line that occurs twice gets an integer id in sort order; the stretches of
such lines are the sequences. Prefix doubling, two doublings a round, names
what starts at each position by its first 1, 4, 16, ... lines in sort order,
until names tell all suffixes apart; sorted, they are the suffix array. The
common prefix of neighbours is compared line by line only where the lines
before them differ (elsewhere it is one less than at the line before), so that
all comparisons together stay in proportion to the sequences, up to a
logarithm. Nested intervals of the array whose suffixes share a prefix are the
maximal repeated runs: for each suffix the longest prefix that it shares with
one that comes earlier is found from both sides, chunk by chunk, and chunks
meet in a tree of folds. What a suffix shares with an earlier one is deleted
there, if it has enough words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.llm import segment
from shelfspark.llm.rows import free_names
from shelfspark.session import cut
from shelfspark.sources.products import numbered

MIN_WORDS = 50
#: Suffixes that one fold takes, and how many folds meet in one of the next level.
CHUNK, FAN = 1 << 16, 64
#: Blocks of names that one round of doubling puts together.
TUPLE = 4
_NULL, FAR = -(1 << 63), 1 << 31


def line_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of bytes that end with a line feed: each line's end, its first and last (exclusive) byte without outer white
    space, and its words; a blank line has none."""
    end = np.flatnonzero(data == 10)
    inside = segment.not_space(data)
    solid = np.flatnonzero(inside)
    words = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    if len(data) and inside[0]:
        words = np.concatenate(([0], words))
    start = np.concatenate(([0], end[:-1] + 1))
    a, b = np.searchsorted(solid, start), np.searchsorted(solid, end)
    solid = np.concatenate((solid, [0]))
    n = np.diff(np.concatenate(([0], np.searchsorted(words, end))))
    return end, np.where(b > a, solid[np.minimum(a, len(solid) - 1)], 0), np.where(b > a, solid[b - 1] + 1, 0), n


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of each text that are not blank: number, 128-bit hash and words; and the text's own hash."""
    line = pa.struct([("raw", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64()), ("n", pa.int32())])
    digest = xxhash.xxh3_128_digest
    for batch in batches:
        at = 0
        for _, texts in segment.chunks([t.as_py() for t in batch.column(2)], empty=b""):
            data = b"\n".join(texts) + b"\n"
            end, first, last, n = line_spans(np.frombuffer(data, np.uint8))
            stop = np.cumsum([len(t) + 1 for t in texts]) - 1  # the line feed that ends each text
            per = np.diff(np.concatenate(([0], np.searchsorted(end, stop) + 1)))  # lines a text
            raw = np.arange(len(end)) - np.repeat(np.cumsum(per) - per, per)
            full = np.flatnonzero(n)
            h = np.frombuffer(b"".join([digest(data[i:j]) for i, j in zip(first[full].tolist(), last[full].tolist(), strict=True)]), ">i8").reshape(-1, 2).astype(np.int64)
            edge = np.concatenate(([0], np.searchsorted(full, np.cumsum(per)))).astype(np.int32)
            of = np.frombuffer(b"".join(map(digest, texts)), ">i8").reshape(-1, 2).astype(np.int64)
            items = pa.StructArray.from_arrays([pa.array(x, k.type) for x, k in zip((raw[full], h[:, 0], h[:, 1], n[full]), line, strict=True)], fields=list(line))
            m = len(texts)
            yield pa.RecordBatch.from_arrays([batch.column(0)[at : at + m], batch.column(1)[at : at + m], pa.array(of[:, 0]), pa.array(of[:, 1]), pa.ListArray.from_arrays(edge, items)], names=["k", "th", "t1", "t2", "lines"])
            at += m


_LINES = "k long, th long, t1 long, t2 long, lines array<struct<raw: int, h1: long, h2: long, n: int>>"


def line_ids(lines: DataFrame) -> DataFrame:
    """Rows whose line occurs at least twice, with ``name``, an integer in the order of the lines' 128-bit hashes."""
    twice = cut(lines.groupBy("h1", "h2").agg(F.count("*").alias("c")).filter("c > 1").select("h1", "h2"), "twice")
    ids = cut(twice.orderBy("h1", "h2").withColumn("name", F.monotonically_increasing_id()), "ids")
    return lines.join(ids, ["h1", "h2"]).drop("h1", "h2")


def _stretches(least: int):
    """Stretches of lines without a gap that have ``least`` words at all."""
    kinds = {"k": pa.int64(), "th": pa.int64(), "at": pa.int32(), "raw": pa.list_(pa.int32()), "n": pa.list_(pa.int32()), "names": pa.list_(pa.int64())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for k, th, *x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), *(batch.column(c) for c in range(2, 6)), strict=True):
                at, name, raw, n = (np.asarray(v.values) for v in x)
                order = np.argsort(at, kind="stable")
                at, name, raw, n = at[order], name[order], raw[order], n[order]
                edge = np.concatenate(([0], np.flatnonzero(np.diff(at) != 1) + 1, [len(at)]))
                out += [(k, th, at[i], raw[i:j], n[i:j], name[i:j]) for i, j in zip(edge[:-1], edge[1:], strict=True) if n[i:j].sum() >= least]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, kind in zip(zip(*out, strict=True) if out else [[]] * len(kinds), kinds.values(), strict=True)], names=list(kinds))

    return run, "k long, th long, at int, raw array<int>, n array<int>, names array<long>"


def sequences(rows: DataFrame, min_words: int) -> DataFrame:
    """``seq, k, th, raw, n, names``: stretches of repeated lines, numbered in order of document and line."""
    lines = rows.select("k", "th", F.posexplode("lines").alias("at", "x")).select("k", "th", "at", "x.*")
    docs = line_ids(lines).groupBy("k", "th").agg(F.collect_list(F.struct("at", "name", "raw", "n")).alias("x"))
    run, schema = _stretches(min_words)
    found = cut(docs.select("k", "th", "x.at", "x.name", "x.raw", "x.n").mapInArrow(run, schema), "stretches")
    return cut(found.orderBy("k", "th", "at").withColumn("seq", F.monotonically_increasing_id()).drop("at"), "sequences")


def suffix_array(seqs: DataFrame) -> DataFrame:
    """``rank, seq, at, left, size, names``: all suffixes of ``seqs(seq, names)``, numbered from 1 in sorted order.

    ``names`` has a suffix's names by its first 1, 4, 16, ... lines; beyond a
    sequence's end comes a name less than all. ``left`` is the line before
    (null at the start), ``size`` the lines from here on. Equal suffixes go by
    sequence. A sequence leaves the doubling when all its suffixes are told
    apart from all others, or have ended.
    """
    now = seqs.select("seq", F.col("names").alias("now"), F.transform("names", lambda x: F.array(x)).alias("names"), F.transform("names", lambda x, i: F.get("names", i - 1)).alias("left"))
    done, step = [], 1
    while True:
        blocks = [F.coalesce(F.get("now", F.col("at") + b * step), F.lit(-1)).alias(f"b{b}") for b in range(TUPLE)]
        rows = now.select("*", F.posexplode("now").alias("at", "name_")).select("seq", "at", F.size("now").alias("total"), *blocks)
        by = [f"b{b}" for b in range(TUPLE)]
        tuples = cut(rows, "tuples")
        counted = tuples.groupBy(*by).agg(F.count("*").alias("c"))
        ids = cut(counted.orderBy(*by).select(*by, F.monotonically_increasing_id().alias("name"), (F.col("c") > 1).alias("shared")), "ids")
        # A sequence goes on if one of its suffixes is like another and longer than what was compared.
        longer = F.col("shared") & (F.col("total") - F.col("at") > TUPLE * step)
        named = tuples.join(ids, by).groupBy("seq").agg(F.sort_array(F.collect_list(F.struct("at", "name"))).alias("x"), F.max(longer).alias("open"))
        now = now.join(named.select("seq", "x.name", "open"), "seq").select("seq", F.col("name").alias("now"), F.zip_with("names", "name", lambda a, b: F.array_append(a, b)).alias("names"), "left", "open")
        now = cut(now, "names")
        done.append(now.filter("not open"))
        now = now.filter("open").drop("open")
        step *= TUPLE
        if now.isEmpty():
            break
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    rows = out.select("seq", F.size("now").alias("total"), F.posexplode(F.arrays_zip("names", "left")).alias("at", "x"))
    rows = cut(rows.select("seq", "at", (F.col("total") - F.col("at")).alias("size"), "x.names", "x.left"), "suffixes")
    return cut(numbered(rows, "names", "seq", "at").withColumnRenamed("n", "rank"), "array")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many first elements of two lists are equal."""
    for batch in batches:
        same = []
        for a, b in zip(batch.column(2), batch.column(3), strict=True):
            a, b = (np.asarray(x.values) for x in (a, b))
            m = min(len(a), len(b))
            differ = np.flatnonzero(a[:m] != b[:m])
            same.append(int(differ[0]) if len(differ) else m)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(same, pa.int32())], names=["seq", "at", "more"])


def common_prefixes(array: DataFrame, seqs: DataFrame) -> DataFrame:
    """``rank, seq, at, lcp``: how many lines each suffix shares with the one before it in the array.

    Names tell it up to a factor of 4. Where both have the same line before
    them, it is one less than that of the suffix one line earlier; for the
    rest the lines are compared.
    """
    before = array.select((F.col("rank") + 1).alias("rank"), F.col("seq").alias("seq2"), F.col("at").alias("at2"), F.col("left").alias("left2"), F.col("names").alias("names2"), F.col("size").alias("size2"))
    rows = array.join(before, "rank", "left")
    same = F.aggregate(F.zip_with("names", "names2", lambda a, b: F.coalesce(a == b, F.lit(False))), F.struct(F.lit(0).alias("n"), F.lit(True).alias("ok")), lambda s, x: F.struct((s["n"] + F.when(s["ok"] & x, 1).otherwise(0)).alias("n"), (s["ok"] & x).alias("ok")), lambda s: s["n"])
    rows = rows.withColumn("same", F.coalesce(same, F.lit(0)))
    sure = F.when(F.col("same") == 0, 0).otherwise(F.least(F.expr(f"shiftleft(1, {TUPLE.bit_length() - 1} * (same - 1))"), "size", "size2"))
    rows = rows.withColumn("sure", sure).withColumn("derived", F.coalesce((F.col("same") > 0) & (F.col("left") == F.col("left2")), F.lit(False)))
    rows = cut(rows.select("rank", "seq", "at", "seq2", "at2", "size", "size2", "sure", "derived"), "neighbours")
    part = lambda at: F.slice("names", F.col(at) + F.col("sure") + 1, F.greatest(F.col("sure") * (TUPLE - 1), F.lit(1)))
    ask = rows.filter("NOT derived AND sure > 0 AND sure < size AND sure < size2").select("seq", "at", "seq2", "at2", "sure")
    one = ask.join(seqs.select("seq", "names"), "seq").select("seq", "at", "seq2", "at2", "sure", part("at").alias("x"))
    two = one.join(seqs.select(F.col("seq").alias("seq2"), "names"), "seq2").select("seq", "at", "x", part("at2").alias("y"))
    more = two.mapInArrow(_compare, "seq long, at int, more int")
    rows = rows.join(more, ["seq", "at"], "left")
    known = F.when(~F.col("derived"), F.col("sure") + F.coalesce("more", F.lit(0)) + F.col("at"))
    lcp = F.last(known, ignorenulls=True).over(Window.partitionBy("seq").orderBy("at")) - F.col("at")
    return rows.select("rank", "seq", "at", lcp.cast("int").alias("lcp"))


def _nearest_earlier(seq: list[int], at: list[int], lcp: list[int], best: list[int]) -> None:
    """Into ``best`` what each suffix shares with the nearest earlier one on its left; ``lcp`` is with the one before."""
    stack: list[tuple[int, int, int]] = []
    for i in range(len(seq)):
        low, own = lcp[i], (seq[i], at[i])
        while stack and stack[-1][:2] > own:
            low = min(low, stack.pop()[2])
        if stack and low > best[i]:
            best[i] = low
        stack.append((*own, low))


def _edge(seq: list[int], at: list[int], reach: list[int]) -> list[int]:
    """Of suffixes in order from an edge, those that matter beyond it: earlier than all up to the edge, the
    earliest of those that reach beyond it equally far, and reaching at all."""
    out: list[int] = []
    low = None
    for i in range(len(seq)):
        if low is None or (seq[i], at[i]) < low:
            low = (seq[i], at[i])
            if out and reach[out[-1]] == reach[i]:
                out.pop()
            if reach[i] <= 0:
                break
            out.append(i)
    return out


def _fold(rows: pd.DataFrame) -> pd.DataFrame:
    """Suffixes of one stretch of the array with ``best``; ``open`` are those that other stretches matter for."""
    rows = rows.sort_values("rank").reset_index(drop=True)
    seq, at, best, lcp = (rows[c].tolist() for c in ("seq", "at", "best", "lcp"))
    n = len(seq)
    _nearest_earlier(seq, at, [0, *lcp[1:]], best)
    back = best[::-1]
    _nearest_earlier(seq[::-1], at[::-1], [0, *lcp[:0:-1]], back)
    best = back[::-1]
    # The last one stays open, so that what the next stretch shares with this one is told between its last row and the next one's first.
    left, right = (np.minimum.accumulate(x).tolist() for x in (lcp, [FAR, *lcp[:0:-1]]))
    open_ = sorted({n - 1, *_edge(seq, at, left), *(n - 1 - i for i in _edge(seq[::-1], at[::-1], right))})
    is_open, low = [False] * n, list(lcp)
    for i, x in zip(open_, np.minimum.reduceat(lcp, [0, *(i + 1 for i in open_[:-1])]).tolist(), strict=True):
        is_open[i], low[i] = True, x
    return rows.assign(best=best, open=is_open, lcp=low)


def shared_with_earlier(lcps: DataFrame) -> DataFrame:
    """``seq, at, best``: the most lines that each suffix shares with one of an earlier document or line, if any."""
    top = lcps.agg(F.max("rank")).first()[0] or 0
    now = lcps.select("rank", "seq", "at", F.col("lcp").cast("long").alias("lcp"), F.lit(0).cast("long").alias("best"), F.lit(True).alias("open"), F.expr(f"(rank - 1) div {CHUNK}").alias("chunk"))
    folds, done = math.ceil(top / CHUNK), None
    while True:
        now = cut(now.groupBy("chunk").applyInPandas(_fold, now.schema), "folded")
        found = now.filter("best > 0" if folds <= 1 else "best > 0 AND NOT open").select("seq", "at", "best")
        done = found if done is None else done.union(found)
        if folds <= 1:
            return done
        now, folds = now.filter("open").withColumn("chunk", F.expr(f"chunk div {FAN}")), math.ceil(folds / FAN)


def _removed(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for raw, n, x in zip(*(batch.column(c) for c in range(2, 5)), strict=True):
                raw, n = np.asarray(raw.values), np.asarray(n.values)
                at, best = (x.values.field(i).to_numpy() for i in range(2))
                total = np.concatenate(([0], np.cumsum(n)))
                at, end = (v[total[at + best] - total[at] >= least] for v in (at, at + best))
                cover = np.cumsum(np.bincount(at, minlength=len(n) + 1) - np.bincount(end, minlength=len(n) + 1))
                out.append(raw[np.flatnonzero(cover[:-1])])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.int32()))], names=["k", "th", "raw"])

    return run


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``k, th, raw``: by document (id or the least long for none, hash of text) the numbers of the lines to delete.

    Blank lines are no part of the sequences. A run of consecutive lines with
    at least ``min_words`` words is deleted wherever it occurs after its first
    copy, in order of doc_id (null first), text hash and line; so a line goes
    exactly if it lies in a later copy of such a run. Texts equal to an earlier
    one are such copies from end to end and go without a search, so that only
    different texts meet in the array.
    """
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL)).alias("k"), F.xxhash64(F.col("text").cast("string")).alias("th"), F.col("text").cast("string").cast("binary").alias("text"))
    rows = cut(rows.filter("text is not null").mapInArrow(_lines, _LINES), "lines")
    words = F.aggregate("lines", F.lit(0).cast("long"), lambda s, x: s + x["n"])
    long = rows.filter(words >= min_words)  # no other text can have a run
    # The first of equal texts: rows with its id are that document, those with other ids are copies.
    first = cut(long.groupBy("t1", "t2").agg(F.min(F.struct("k", "th", "lines")).alias("x")).select("t1", "t2", "x.*"), "texts")
    copies = long.select("k", "th", "t1", "t2").distinct().join(first.select("t1", "t2", F.col("k").alias("first"), F.transform("lines", lambda x: x["raw"]).alias("raw")), ["t1", "t2"]).filter("k <> first").select("k", "th", "raw")
    seqs = sequences(first, min_words)
    if seqs.isEmpty():
        return copies
    best = shared_with_earlier(common_prefixes(suffix_array(seqs.select("seq", "names")), seqs))
    best = best.groupBy("seq").agg(F.collect_list(F.struct("at", "best")).alias("x"))
    gone = seqs.join(best, "seq").select("k", "th", "raw", "n", "x").mapInArrow(_removed(min_words), "k long, th long, raw array<int>")
    gone = gone.filter(F.size("raw") > 0).groupBy("k", "th").agg(F.sort_array(F.flatten(F.collect_list("raw"))).alias("raw"))
    return gone.union(copies)


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Every row of ``docs`` with its columns, ``text`` without its later copies, and ``n_lines, removed_lines``.

    ``removed_lines`` are line numbers from 0. A null text stays null with no
    lines; an empty one has one line and keeps it. Rows equal in id and text
    are one document, so no copy of the other, and all stay. Columns named as
    the added ones are replaced.
    """
    k, t, gone = free_names(docs, "k", "t", "gone")
    text = F.col("text").cast("string")
    rows = docs.withColumns({k: F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL)), t: F.xxhash64(text)})
    # Few documents lose lines while tables are small; the same join at every size keeps its costs in proportion.
    rows = rows.join(cut(repeated_lines(docs, min_words), "gone").toDF(k, t, gone).hint("merge"), [k, t], "left")
    lines = F.split(text, "\n", -1)
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    left = F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")
    return rows.withColumns({
        "n_lines": F.coalesce(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1, F.lit(0)),
        "text": F.when(F.col(gone).isNull(), text).otherwise(left),
        "removed_lines": F.coalesce(gone, F.array().cast("array<int>")),
    }).drop(k, t, gone)


def digests(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document: ``doc_id, n_lines, n_removed, removed_lines, clean_chars, clean_sha256, text``."""
    out = without_repeats(docs.select("doc_id", "text"), min_words)
    text = F.coalesce("text", F.lit(""))
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), "n_lines", F.size("removed_lines").alias("n_removed"), "removed_lines", F.length(text).alias("clean_chars"), F.sha2(text, 256).alias("clean_sha256"), "text")
