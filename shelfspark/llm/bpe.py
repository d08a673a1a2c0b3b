"""Byte-level BPE by forced boundaries.

A byte pair that occurs inside no token of the vocabulary can never be bridged
by a merge, so a text may be cut there and its fragments encoded on their own.
The pre-tokenizer also looks at characters next to a pre-token, so whole texts
are cut only at certain pairs that no such look depends on: before white space,
and between two characters of any script that are no white space and no
apostrophe, in the middle of a pre-token or at its end alike. Fragments repeat
often; each is encoded once while it stays in a cache of bounded bytes.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The pre-tokenizer pattern of byte-level BPE vocabularies of this kind (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Bytes of fragments and of their ids that a task keeps at most; beyond, the cache starts anew. A longer
#: fragment than LONG is not kept at all.
CACHE, LONG = 64 << 20, 1 << 12
#: Last bytes of white space characters beyond ASCII, which may not come before a cut (fixed values).
SPACE_ENDS = (*range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF)


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file, by the usual rule."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def refuse_unknown(spec: dict) -> None:
    """Only byte-level BPE as this module has it: anything else in the file is an error, not ignored."""
    model, pre, decoder = spec["model"], spec.get("pre_tokenizer") or {}, spec.get("decoder") or {}
    wrong = [k for k in ("lstrip", "rstrip", "single_word", "normalized") if any(t.get(k) and not (k == "normalized" and spec.get("normalizer") is None) for t in spec["added_tokens"])]
    wrong += [k for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
    wrong += ["normalizer"] if spec.get("normalizer") else []
    wrong += ["pre_tokenizer"] if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) else []
    wrong += ["decoder"] if decoder.get("type") != "ByteLevel" else []
    wrong += ["model"] if model.get("type", "BPE") != "BPE" else []
    vocab = model["vocab"]
    ranks = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    wrong += ["merges"] if ranks != sorted(ranks) else []
    if wrong:
        raise ValueError(f"this vocabulary file has {', '.join(wrong)}, which byte-level BPE by merge order does not cover")


def usable_pairs() -> np.ndarray:
    """By first and second byte: pairs at which a cut leaves every pre-token as it is but for being cut itself."""
    a, b = np.arange(256)[:, None], np.arange(256)[None, :]
    space = lambda x: np.isin(x, [9, 10, 11, 12, 13, 32])
    solid = ~space(a) & ~np.isin(a, [0x1C, 0x1D, 0x1E, 0x1F, ord("'"), *SPACE_ENDS]) & (a < 0xC0)
    begins = ~space(b) & (b != ord("'")) & ((b < 0x80) | (b >= 0xC2))
    out = space(b) | solid & begins
    for x in ("re", "ve", "ll"):  # inside what the pattern takes for a contraction
        out[ord(x[0]), ord(x[1])] = False
    return out


class Codec:
    """Encodes and decodes with one vocabulary file; equal to the tokenizers library on every text."""

    def __init__(self, path: str, cache: int = CACHE) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        refuse_unknown(spec)
        of = byte_alphabet()
        self.special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        vocab = {bytes(of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if i not in self.special.values()}
        self.model = tiktoken.Encoding("fragments", pat_str=PATTERN, mergeable_ranks=vocab, special_tokens={})
        self.bytes = {i: b for b, i in vocab.items()} | {i: b for b, i in self.special.items()}
        self.is_special = re.compile(b"(" + b"|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + b")") if self.special else None
        inside = np.zeros((256, 256), bool)
        for t in vocab:
            a = np.frombuffer(t, np.uint8)
            inside[a[:-1], a[1:]] = True
        self.cut = (~inside & usable_pairs()).ravel()
        self.cache: dict[bytes, bytes] = {}
        self.odd: dict[bytes, bytes] = {}
        self.most, self.held = cache, 0

    def fragments(self, data: bytes) -> list[bytes]:
        """``data`` cut at every usable certain pair."""
        a = np.frombuffer(data, np.uint8)
        at = (np.flatnonzero(self.cut[a[:-1].astype(np.uint16) << 8 | a[1:]]) + 1).tolist()
        return [data[i:j] for i, j in zip([0, *at], [*at, len(data)], strict=True)] if data else []

    def known(self, fragments: list[bytes]) -> list[bytes]:
        """For each fragment its ids as text, each after a comma; ``odd`` gets those that decode to other bytes."""
        cache = self.cache
        try:
            return [cache[f] for f in fragments]
        except KeyError:
            pass
        if self.held > self.most:
            cache.clear()
            self.odd.clear()
            self.held = 0
        long = {}
        for f in set(fragments).difference(cache):
            ids = self.model.encode_ordinary(f.decode())
            text = ("," + ",".join(map(str, ids))).encode()
            if (back := b"".join([self.bytes[i] for i in ids])) != f:
                self.odd[f] = back
            if len(f) <= LONG:
                cache[f] = text
                self.held += len(f) + len(text) + 200
            else:
                long[f] = text
        return [long.get(f) or cache[f] for f in fragments] if long else [cache[f] for f in fragments]

    def both(self, data: bytes) -> tuple[bytes, bytes]:
        """The ids of ``data`` as decimal numbers joined by commas, and the bytes they decode to."""
        parts = self.is_special.split(data) if self.is_special and self.is_special.search(data) else [data]
        ids: list[bytes] = []
        decoded: list[bytes] = []
        for k, part in enumerate(parts):
            if k % 2:
                ids.append(b",%d" % self.special[part])
                decoded.append(part)
            else:
                found = self.fragments(part)
                ids += self.known(found)
                decoded += [self.odd.get(f, f) for f in found] if self.odd else found
        return b"".join(ids)[1:], b"".join(decoded)

    def encode(self, text: str) -> list[int]:
        ids = self.both(text.encode())[0]
        return [int(i) for i in ids.split(b",")] if ids else []

    def decode(self, ids: list[int]) -> str:
        return b"".join([self.bytes[i] for i in ids]).decode(errors="replace")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _run(path: Callable[[], str], keep_ids: bool):
    names = ["n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * keep_ids]
    kinds = [pa.int64(), pa.string(), pa.string(), *[pa.list_(pa.int32())] * keep_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path())
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for data in batch.column(1):
                ids, decoded = codec.both(data.as_py() or b"")
                out[0].append(ids.count(b",") + 1 if ids else 0)
                out[1].append(hashlib.sha256(ids).hexdigest())
                out[2].append(hashlib.sha256(decoded.decode(errors="replace").encode()).hexdigest())
                if keep_ids:
                    out[3].append(np.array(ids.split(b","), np.int32) if ids else np.zeros(0, np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(x, k) for x, k in zip(out, kinds, strict=True)]], names=["doc_id", *names])

    return run


def encode_documents(docs: DataFrame, path: Callable[[], str] = default_path, keep_ids: bool = False) -> DataFrame:
    """One row per row: ``doc_id, n_tokens, ids_sha256, decoded_sha256`` and, if asked, ``ids``.

    Null text counts as empty: no ids, digests of the empty string. Strings of
    special tokens in a text become those tokens, as the library has it.
    Repeated rows give repeated rows. No row needs another, so nothing is
    shuffled and a lost task is simply run again. ``path`` is called in each
    task and names the vocabulary file there.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary").alias("text")).mapInArrow(_run(path, keep_ids), schema)
