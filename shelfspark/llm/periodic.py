"""Periodic runs of words by recursive frequency splitting and a scan of lags.

A run repeats a block of q words four times or more, so each of its words is
there at least four times in any stretch that holds the run. Words rarer than
that split their segment; the pieces are counted anew and split again until
every word of every piece is frequent there. Pieces of ordinary text vanish in
a few rounds. In what is left, each lag q is scanned by blocks: a run of
period q holds three equal neighbouring blocks among those that begin at
multiples of q, so a lag looks at one fingerprint a block, and only where
three agree are words compared and the run extended to both ends.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm import segment

#: A run has this many words at least, and holds its period this many times.
LEAST, POWERS = 6, 4

Run = tuple[int, int, int]  # start, length, period


def _pieces(at: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end, in ``at``, of stretches of neighbouring places of one label; those too short for a run are left out."""
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.flatnonzero((np.diff(at) != 1) | (np.diff(label) != 0)) + 1
    begin, end = np.concatenate(([0], edge)), np.concatenate((edge, [len(at)]))
    long = end - begin >= LEAST
    return begin[long], end[long]


def survivors(words: np.ndarray, of: np.ndarray) -> list[tuple[int, int]]:
    """Stretches ``[begin, end)`` of ``words`` in which every word is frequent enough to be in a run. ``of`` is the
    text of each word; numbers of words are not shared between texts."""
    done = []
    frequent = np.bincount(words)[words] >= POWERS if len(words) else np.zeros(0, bool)
    at, label = np.flatnonzero(frequent), of[frequent]
    while len(at):
        begin, end = _pieces(at, label)
        if not len(begin):
            break
        size = end - begin
        label = np.repeat(np.arange(len(begin)), size)
        at = at[np.arange(len(label)) + np.repeat(begin - np.concatenate(([0], np.cumsum(size)[:-1])), size)]
        _, which, times = np.unique(label * (int(words.max()) + 1) + words[at], return_inverse=True, return_counts=True)
        frequent = times[which] >= POWERS
        stable = np.bincount(label, ~frequent) == 0
        first = np.concatenate(([0], np.cumsum(size)))
        done += [(int(at[first[k]]), int(at[first[k]]) + int(size[k])) for k in np.flatnonzero(stable)]
        on = frequent & ~stable[label]
        at, label = at[on], label[on]
    return sorted(done)


def _stretch(same: np.ndarray) -> int:
    """How many are true from the left on."""
    return len(same) if same.all() else int(np.argmin(same))


def lag_scan(words: np.ndarray) -> list[Run]:
    """All runs of one stretch, by lag; a run's period is its smallest."""
    n = len(words)
    value = segment.mix(words.astype(np.uint64) + np.uint64(1))
    power = segment.powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(value * power[:n], out=sums[1:])
    found: dict[int, list[tuple[int, int]]] = {}  # ends of the runs of each period, in order
    for q in range(1, n // POWERS + 1):
        block = np.diff(sums[::q])
        equal = block[:-1] * power[q] == block[1:]
        if not (equal[:-1] & equal[1:]).any():
            continue
        edge = np.flatnonzero(np.diff(np.concatenate(([False], equal, [False])).astype(np.int8)))
        for k, end in zip(edge[0::2].tolist(), edge[1::2].tolist(), strict=True):
            if end - k < 2:
                continue
            x, y = k * q, (end + 1) * q
            if any(p in found and (i := bisect_right(found[p], (x, n + 1))) and found[p][i - 1][1] >= y for p in _divisors(q, found)):
                continue  # the same run as that of a shorter period
            if not np.array_equal(words[x : y - q], words[x + q : y]):  # fingerprints that agree by chance
                spans = _compared(words, q)
            else:
                left, right = max(0, x - q), min(n, y + q)
                x -= _stretch((words[left:x] == words[left + q : x + q])[::-1])
                y += _stretch(words[y:right] == words[y - q : right - q])
                spans = [(x, y)]
            for s, e in spans:
                own = found.setdefault(q, [])
                if e - s >= max(LEAST, POWERS * q) and (s, e) not in own[-1:] and not any((s, e) in found[p] for p in _divisors(q, found)):
                    own.append((s, e))
        if q in found:
            found[q] = sorted(set(found[q]))
            if not found[q]:
                del found[q]
    return sorted((s, e - s, q) for q, runs in found.items() for s, e in runs)


def _divisors(q: int, found: dict) -> list[int]:
    return [p for p in found if p < q and q % p == 0]


def _compared(words: np.ndarray, q: int) -> list[tuple[int, int]]:
    """Maximal stretches of period ``q``, word by word."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], words[:-q] == words[q:], [False])).astype(np.int8)))
    return [(int(a), int(b) + q) for a, b in zip(edge[0::2], edge[1::2], strict=True)]


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """One document in ten, by its id's checksum, ends in a repeated block of its own words; one without an id never."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


def runs_of(texts: list[list[bytes]]) -> list[list[Run]]:
    """The runs of each list of words, by start, then period."""
    sizes = [len(t) for t in texts]
    numbers, base = [], 0
    for t in texts:
        names: dict[bytes, int] = {}
        numbers.append(np.fromiter((names.setdefault(w, len(names)) for w in t), np.int64, len(t)) + base)
        base += len(names)
    words = np.concatenate(numbers) if numbers else np.zeros(0, np.int64)
    of = np.repeat(np.arange(len(texts)), sizes)
    starts = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    out: list[list[Run]] = [[] for _ in texts]
    for begin, end in survivors(words, of):
        d = int(of[begin])
        out[d] += [(begin - int(starts[d]) + s, length, q) for s, length, q in lag_scan(words[begin:end])]
    return [sorted(x, key=lambda r: (r[0], r[2])) for x in out]


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words without those that come in a run after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for s, length, q in runs:
        keep[s + q : s + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(keep)])


def greatest(runs: list[Run]) -> Run | None:
    """The run with the greatest length over period; of equal ones the first, then that of the smallest period."""
    best = None
    for r in runs:  # by start, then period
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


_DIGEST = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in ("n_runs", "start", "length", "period", "exponent_milli")], ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())])
_RUNS = pa.schema([("doc_id", pa.int64()), ("runs", pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))), ("collapsed", pa.string())])


def _scan(digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for at, texts in segment.chunks(batch.column(1).to_pylist(), empty=b""):
                words = [t.split() for t in texts]  # bytes are split at [\x20\x09-\x0D] alone
                if digest:
                    words = [planted(w, i) for w, i in zip(words, ids[at : at + len(texts)], strict=True)]
                rows = []
                for w, runs, i in zip(words, runs_of(words), ids[at : at + len(texts)], strict=True):
                    left = collapsed(w, runs)
                    if not digest:
                        rows.append({"doc_id": i, "runs": [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs], "collapsed": left.decode()})
                        continue
                    s, length, q = greatest(runs) or (None, None, None)
                    listed = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
                    rows.append({
                        "doc_id": i, "n_runs": len(runs), "start": s, "length": length, "period": q, "exponent_milli": 1000 * length // q if q else None,
                        "runs_sha256": hashlib.sha256(listed.encode()).hexdigest(), "collapsed_sha256": hashlib.sha256(left).hexdigest(),
                    })
                yield pa.RecordBatch.from_pylist(rows, schema=_DIGEST if digest else _RUNS)

    return run


def _picked(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, runs, collapsed``: every document's runs by start, then period, and its words without the repeats.

    A run is a stretch of words with smallest period q and at least ``max(6, 4 q)`` words that no neighbouring word
    continues. Texts are read whole; null and empty ones have no run. Repeated rows, equal and null ids have a row each.
    An empty table gives an empty result; other columns are not read. No shuffle; a document is one task's.
    """
    return _picked(docs).mapInArrow(_scan(False), "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def planted_runs(docs: DataFrame) -> DataFrame:
    """``periodic_runs`` as digests, after one document in ten got a repeated end: the number of runs, the greatest by
    length over period (four nulls if there is none), and digests of all runs and of the words that stay."""
    return _picked(docs).mapInArrow(_scan(True), "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string")
