"""Language identification by script, per-word scores and Viterbi.

A word's letters tell its scripts, which narrow its candidate languages. A
word's score in a language is the sum of log probabilities of its character
trigrams; Viterbi over the words, with a penalty for each switch, labels spans
of one language. The language with the most letters names the document.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.llm import segment
from shelfspark.session import cut

#: Documents of each language to learn from, about; a sample by hash, whole texts, of any corpus.
SAMPLE = 400
PENALTY = 6.0
#: Words in a block of a path, and the most languages for which blocks pay.
BLOCK, MATRIX = 128, 16
#: A script is a language's if it has this share of its letters; at most so likely is a letter of any other script.
SHARE = 0.01
UND = "und"
#: First code points of ranges of scripts (fixed values of the Unicode blocks; others are script 0).
SCRIPTS = (
    ("latin", 0x41, 0x24F), ("latin", 0x1E00, 0x1EFF), ("greek", 0x370, 0x3FF), ("greek", 0x1F00, 0x1FFF), ("cyrillic", 0x400, 0x52F),
    ("armenian", 0x530, 0x58F), ("hebrew", 0x590, 0x5FF), ("arabic", 0x600, 0x6FF), ("arabic", 0x750, 0x77F), ("devanagari", 0x900, 0x97F),
    ("bengali", 0x980, 0x9FF), ("gurmukhi", 0xA00, 0xA7F), ("gujarati", 0xA80, 0xAFF), ("tamil", 0xB80, 0xBFF), ("telugu", 0xC00, 0xC7F),
    ("thai", 0xE00, 0xE7F), ("georgian", 0x10A0, 0x10FF), ("hangul", 0x1100, 0x11FF), ("hangul", 0xAC00, 0xD7AF), ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x4DBF), ("han", 0x4E00, 0x9FFF),
)
NAMES = ("other", *dict.fromkeys(n for n, _, _ in SCRIPTS))


FIELDS = (1 << segment.TRIGRAM_BITS) + len(NAMES)


@lru_cache
def _scripts() -> np.ndarray:
    """The script of each code point."""
    script = np.zeros(0x110000, np.uint8)
    for name, a, b in SCRIPTS:
        script[a : b + 1] = NAMES.index(name)
    return script


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a chunk's trigrams and scripts by language; scripts come after the trigrams' buckets."""
    for batch in batches:
        langs, of = np.unique(np.array(batch.column(1).to_pylist(), object), return_inverse=True)
        for at, texts in segment.chunks(batch.column(0).to_pylist()):
            cp, _, inside, starts, ends, doc = segment.letter_words(texts)
            lang = np.repeat(of[at + doc], ends - starts).astype(np.int64)
            places = np.flatnonzero(inside)
            both = np.concatenate((segment.trigrams(cp, inside)[places].astype(np.int64), (1 << segment.TRIGRAM_BITS) + _scripts()[cp[places]].astype(np.int64)))
            key, n = np.unique(np.concatenate((lang, lang)) * FIELDS + both, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(langs[key // FIELDS].tolist(), pa.string()), pa.array((key % FIELDS).astype(np.int32)), pa.array(n.astype(np.int64))], names=["lang", "field", "n"])


class Model:
    """Log probabilities of trigrams by language, and the languages of each script."""

    def __init__(self, langs: list[str], counts: np.ndarray, scripts: np.ndarray, penalty: float = PENALTY) -> None:
        self.langs, self.penalty = langs, np.float32(penalty)
        p = counts + 0.1
        self.table = np.ascontiguousarray(np.log(p / p.sum(1, keepdims=True)).T.astype(np.float32))
        self.scripts = (scripts >= SHARE * np.maximum(scripts.sum(1, keepdims=True), 1)).T

    @classmethod
    def of(cls, langs: list[str], counts: pa.Table) -> Model:
        """From rows ``lang, field, n`` as ``_learn`` gives them."""
        langs = sorted(langs)
        found = np.zeros((len(langs), FIELDS))
        if counts.num_rows:
            at = {x: k for k, x in enumerate(langs)}
            np.add.at(found, ([at[x] for x in counts["lang"].to_pylist()], counts["field"].to_numpy()), counts["n"].to_numpy())
        return cls(langs, found[:, : 1 << segment.TRIGRAM_BITS], found[:, 1 << segment.TRIGRAM_BITS :])

    def candidates(self, cp: np.ndarray, inside: np.ndarray, starts: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
        """By word: the languages written in a script of its letters; if none fits, those of its document's other words, or else all."""
        bits = np.where(inside, np.uint32(1) << _scripts()[cp].astype(np.uint32), np.uint32(0))
        kinds, of = np.unique(np.bitwise_or.reduceat(bits, starts), return_inverse=True)
        used = (kinds[:, None] >> np.arange(len(NAMES), dtype=np.uint32)) & np.uint32(1)
        ok = (used.astype(np.float32) @ self.scripts.astype(np.float32)) > 0
        fits = ok[of]
        lost = np.flatnonzero(~ok.any(1)[of])
        if len(lost):
            seen = np.zeros((n_docs, len(kinds)), bool)
            seen[doc, of] = True
            others = (seen.astype(np.float32) @ ok.astype(np.float32)) > 0
            others |= ~others.any(1, keepdims=True)
            fits[lost] = others[doc[lost]]
        return fits

    def scores(self, cp: np.ndarray, inside: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """By word and language."""
        tri = segment.trigrams(cp, inside)
        out = np.empty((len(starts), len(self.langs)), np.float32)
        for k in range(len(self.langs)):
            x = self.table[:, k][tri]
            x *= inside
            out[:, k] = np.add.reduceat(x, starts)
        return out

    def narrowed(self, score: np.ndarray, fits: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Scores in which a language that does not fit a word of ``size`` letters stays behind the best that does, by so
        much for each letter that a few letters cost less than two switches."""
        if fits.all():
            return score
        behind = np.where(fits, score, -np.inf).max(1) + np.float32(np.log(SHARE)) * size
        return np.where(fits, score, behind[:, None]).astype(np.float32)

    def path(self, score: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
        """Each word's language on its document's best path.

        Documents are cut into blocks, and all blocks go side by side: first from every language that the word before
        a block may have, which gives the best way from each to each; a walk over a document's blocks then says in
        which language each begins and ends on the best path of the whole; and that path is found inside each block.
        Of many languages, documents are one block each."""
        n_langs = score.shape[1]
        n = np.bincount(doc, minlength=n_docs)
        size = BLOCK if n_langs <= MATRIX else max(1, int(n.max(initial=1)))
        of_doc = np.repeat(np.arange(n_docs), -(-n // size))
        nth = np.arange(len(of_doc)) - np.repeat(np.concatenate(([0], np.cumsum(-(-n // size))))[:-1], -(-n // size))
        first = np.concatenate(([0], np.cumsum(n)))[:-1][of_doc] + nth * size
        length = np.minimum(n[of_doc] - nth * size, size)
        before = np.full((len(of_doc), 1, n_langs), -np.inf)
        before[nth == 0] = 0
        end = np.full(len(of_doc), -1)
        many = np.flatnonzero((n > size)[of_doc])
        if len(many):
            every = np.where(np.eye(n_langs, dtype=bool), 0, -np.inf)
            ways = self._forward(score, first[many], length[many], np.where((nth[many] == 0)[:, None, None], 0, every))
            at = np.full(len(of_doc), -1)
            at[many] = np.arange(len(many))
            docs = np.flatnonzero(n > size)
            begin = np.searchsorted(of_doc, docs)
            count = -(-n // size)[docs]
            best, came = ways[at[begin], 0], np.zeros((len(many), n_langs), np.int64)
            for j in range(1, count.max()):
                on = np.flatnonzero(count > j)
                k = at[begin[on] + j]
                both = best[on][:, :, None] + ways[k]
                came[k], best[on] = both.argmax(1), both.max(1)
            now = best.argmax(1)
            for j in range(count.max() - 1, -1, -1):
                on = np.flatnonzero(count > j)
                end[begin[on] + j] = now[on]
                if j:
                    now[on] = came[at[begin[on] + j], now[on]]
                    before[begin[on] + j, 0, now[on]] = 0
        came = np.zeros((len(doc), n_langs), np.int16 if n_langs <= 1 << 15 else np.int32)
        last = self._forward(score, first, length, before, came)[:, 0]
        label = np.zeros(len(doc), np.int32)
        label[first + length - 1] = np.where(end >= 0, end, last.argmax(1))
        order = np.argsort(-length, kind="stable")
        first, length = first[order], length[order]
        live = np.searchsorted(-length, -np.arange(length[0] if len(length) else 0), side="left")
        for t in range(len(live) - 1, 0, -1):
            at = first[: live[t]] + t
            label[at - 1] = came[at, label[at]]
        return label

    def _forward(self, score: np.ndarray, first: np.ndarray, length: np.ndarray, before: np.ndarray, came: np.ndarray | None = None) -> np.ndarray:
        """The best values after each block, from those ``before`` it (block, way, language); ``came`` gets the language
        before each word, where there is one way. Blocks go side by side, the longest first."""
        order = np.argsort(-length, kind="stable")
        first, length = first[order], length[order]
        v = np.array(before[order], np.float64)
        own = np.arange(score.shape[1])[None, :]
        live = np.searchsorted(-length, -np.arange(length[0] if len(length) else 0), side="left")  # blocks longer than t words
        for t, m in enumerate(live.tolist()):
            at, now = first[:m] + t, v[:m]
            switch = now.max(2, keepdims=True) - self.penalty
            if came is not None:
                came[at] = np.where(now[:, 0] >= switch[:, 0], own, now[:, 0].argmax(1)[:, None])
            np.maximum(now, switch, out=now)
            now += score[at][:, None, :]
        out = np.empty_like(v)
        out[order] = v
        return out

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, list[list[tuple[str, int]]]]:
        """Language and score of each text, and its spans: language and number of words, in order."""
        cp, _, inside, starts, ends, doc = segment.letter_words(texts)
        k = len(self.langs)
        if not len(starts) or not k:
            return [UND] * len(texts), np.zeros(len(texts)), [[] for _ in texts]
        fits = self.candidates(cp, inside, starts, doc, len(texts))
        label = self.path(self.narrowed(self.scores(cp, inside, starts), fits, ends - starts), doc, len(texts))
        letters = np.bincount(doc * k + label, weights=ends - starts, minlength=len(texts) * k).reshape(len(texts), k)
        total = letters.sum(1)
        best = letters.argmax(1)
        langs = [self.langs[b] if n else UND for b, n in zip(best.tolist(), total.tolist(), strict=True)]
        edge = np.flatnonzero((np.diff(label) != 0) | (np.diff(doc) != 0)) + 1
        edge = np.concatenate(([0], edge, [len(label)]))
        spans: list[list[tuple[str, int]]] = [[] for _ in texts]
        for i, j in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
            spans[doc[i]].append((self.langs[label[i]], j - i))
        return langs, letters.max(1) / np.maximum(total, 1), spans


def fit(labelled: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from ``text, lang``, of a sample of at most about ``sample`` different whole texts of each language.

    The sample is taken by hash, so it is the same in every run. Counts are
    added up by Spark; what comes back is a number a language and trigram.
    """
    rows = labelled.select(F.col("text").cast("string"), F.col("lang").cast("string")).filter("text is not null and lang is not null")
    found = cut(rows.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    taken = rows.join(found, "lang").filter(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < F.least(F.lit(1.0), sample / F.col("n")) * (1 << 30))
    # A text counts once, however often it is there: so its repeats cannot fill the sample.
    counts = taken.select("text", "lang").distinct().mapInArrow(_learn, "lang string, field int, n long").groupBy("lang", "field").agg(F.sum("n").alias("n"))
    return Model.of([r.lang for r in found.select("lang").collect()], counts.toArrow())


def _predict(model, spans: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            lang, score, found = [], [], []
            for _, texts in segment.chunks(batch.column(2).to_pylist()):
                a, b, c = m.predict(texts)
                lang += a
                score.append(b)
                found += [[{"lang": x, "words": n} for x, n in s] for s in c] if spans else [len(s) for s in c]
            kind = pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int32())])) if spans else pa.int32()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(np.concatenate(score) if score else [], pa.float64()), pa.array(found, kind)], names=["doc_id", "held_out", "lang_pred", "score", "spans"])

    return run


def held_out(n: int, remainder: int) -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % n == remainder, F.lit(False))


def predict_documents(docs: DataFrame, spans: bool = False) -> DataFrame:
    """One row per row: ``doc_id, held_out, lang_pred, score, spans``, learned from rows not held out.

    ``spans`` is the number of one-language spans, or with ``spans=True`` their
    languages and words. ``score`` is the share of the letters that the
    predicted language has. Null texts and those without letters, and all
    texts where there is nothing to learn from, are ``und`` with score 0. A
    null doc_id is not held out. Repeated rows give repeated rows. Nothing is
    shuffled but the sample's counts.
    """
    docs = docs.select(F.col("doc_id").cast("long"), held_out(4, 2).alias("held_out"), F.col("text").cast("string"), F.col("lang").cast("string"))
    model = docs.sparkSession.sparkContext.broadcast(fit(docs.filter("not held_out")))
    schema = "doc_id long, held_out boolean, lang_pred string, score double, spans " + ("array<struct<lang: string, words: int>>" if spans else "int")
    return docs.select("doc_id", "held_out", "text").mapInArrow(_predict(model, spans), schema)
