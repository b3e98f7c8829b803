"""Held-out passages inside a corpus, by spaced-seed hashing.

A document is a case for an item if ``window`` consecutive words of both differ in at most ``mismatches`` places. Such a window,
cut into ``mismatches + 2`` blocks, has at least two blocks without a difference; so one of a few fixed masks, each two blocks at
some distance with everything else ignored, must match exactly, and no case is missed. Hashes of all masks at all places of both
sides are joined, and the words around each hit are compared, tolerating the substitutions.

The documents' side is thinned by bitmaps of the items' hashes, of a bounded size whatever the number of items, before the join.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessellar.common import BROADCAST_ROWS, cut, is_small, join_sized, stored

#: log2 of the fewest and the most bits in each of the two bitmaps, which are sized by the number of seeds: 8 MB each at most.
LEAST_BITS, MOST_BITS = 16, 26
#: Bits for each seed, as far as the bound allows.
BITS_A_SEED = 16
#: Texts are hashed together up to about so many characters.
CHUNK_CHARS = 4_000_000
_CACHE_WORDS = 1_000_000

_JOINED = re.compile(r"(?<=\w)[-‐‑‒](?:[ \t]*\r?\n[\s>|]*)?(?=\w)")
_DROPPED = re.compile("[­̀-ͯ​-‍⁠﻿]+")
_WORD = re.compile(r"[^\W_]+")


def words(text: str) -> list[str]:
    """The words that count: no case, accents, Unicode form or punctuation; a hyphen between letters, at a line end too, joins."""
    if not text.isascii():
        text = _DROPPED.sub("", unicodedata.normalize("NFKD", text))
    if "-" in text or not text.isascii():
        text = _JOINED.sub("", text)
    return _WORD.findall(text.casefold())


def masks(window: int, mismatches: int) -> list[np.ndarray]:
    """Offsets that each mask looks at; any two of ``mismatches + 2`` blocks, one mask for each distance between them."""
    blocks = mismatches + 2
    size = window // blocks
    if size < 1:
        raise ValueError("the window is too short for so many mismatches")
    return [np.r_[0:size, d * size : (d + 1) * size] for d in range(1, blocks)]


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= _CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def _lists(values: np.ndarray, width: int) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(0, values.size + 1, width, dtype=np.int32), values)


class Seeds:
    """Words and seed hashes of a bunch of texts."""

    def __init__(self, window: int, mismatches: int) -> None:
        self.window, self.masks = window, masks(window, mismatches)
        self.lead = window - min(m[-1] + 1 for m in self.masks)  # a window starts at most so far before a hit
        self.width = self.lead + window
        rng = np.random.default_rng(20)
        self.factors = rng.integers(1, 2**63, size=(len(self.masks), len(self.masks[0])), dtype=np.uint64) | np.uint64(1)
        self.cache = _Hashes()

    def read(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word hashes of all texts in a row; where each text starts and ends."""
        cache, each = self.cache, [[]] * len(texts)
        for i, t in enumerate(texts):
            if t:
                each[i] = [cache[w] for w in words(t)]
        ends = np.cumsum([len(x) for x in each])
        ids = np.fromiter((w for x in each for w in x), dtype=np.uint64, count=int(ends[-1]) if len(ends) else 0)
        return ids, np.r_[0, ends[:-1]].astype(np.int64), ends.astype(np.int64)

    def hashes(self, ids: np.ndarray, ends: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each mask, the places at which it fits into one text, and its hash there."""
        left = np.repeat(ends, lengths) - np.arange(len(ids))
        for mask, factor in zip(self.masks, self.factors):
            n = len(ids) - int(mask[-1])
            if n <= 0:
                continue
            h = np.zeros(n, dtype=np.uint64)
            for k, f in zip(mask, factor):
                h += ids[k : k + n] * f
            h ^= h >> np.uint64(29)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            at = np.flatnonzero(left[:n] > mask[-1])
            yield at, h[at]

    def context(self, ids: np.ndarray, at: np.ndarray, starts: np.ndarray, ends: np.ndarray, pad: int) -> np.ndarray:
        """The words from ``lead`` before to ``window`` after each place, ``pad`` where the text has none."""
        spots = at[:, None] + np.arange(-self.lead, self.window)
        inside = (spots >= starts[:, None]) & (spots < ends[:, None])
        got = ids[np.clip(spots, 0, max(0, len(ids) - 1))].astype(np.uint32).view(np.int32)
        return np.where(inside, got, np.int32(pad))


def _chunks(texts: list[str | None], most: int) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= most:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def item_seeds(items: DataFrame, window: int, mismatches: int) -> DataFrame:
    """(item_id, hash, around): every seed of every item, with the words around it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Seeds(window, mismatches)
        for b in batches:
            keys, texts = b.column(0), b.column(1).to_pylist()
            ids, starts, ends = s.read(texts)
            owner = np.repeat(np.arange(len(texts)), ends - starts)
            for at, h in s.hashes(ids, ends, ends - starts):
                near = s.context(ids, at, starts[owner[at]], ends[owner[at]], -2)
                yield pa.record_batch([keys.take(pa.array(owner[at])), pa.array(h.view(np.int64)), _lists(near.ravel(), s.width)], ["item_id", "hash", "around"])

    return items.where("text IS NOT NULL AND item_id IS NOT NULL").select("item_id", "text").mapInArrow(run, "item_id bigint, hash bigint, around array<int>")


class Bitmaps:
    """Two bitmaps of hashes, packed, under the first and under other bits of each hash."""

    def __init__(self, bits: int, packed: np.ndarray) -> None:
        self.bits, self.packed = bits, packed

    def unpacked(self) -> tuple[np.ndarray, np.ndarray]:
        bits = np.unpackbits(self.packed, bitorder="little").view(bool)
        return bits[: 1 << self.bits], bits[1 << self.bits :]


def bitmaps(hashes: DataFrame, most_bits: int = MOST_BITS) -> Bitmaps:
    """Bitmaps of the hashes; the driver gets at most 2 * 2**MOST_BITS / 64 words, whatever the number of hashes."""
    n = hashes.count()
    size = min(most_bits, max(LEAST_BITS, (BITS_A_SEED * max(1, n) - 1).bit_length()))
    first = F.shiftrightunsigned("hash", 64 - size)
    second = F.shiftrightunsigned("hash", 8).bitwiseAND(F.lit((1 << size) - 1))
    bits = hashes.select(F.explode(F.array(first, second + F.lit(1 << size))).alias("b"))
    got = bits.groupBy(F.shiftright("b", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(CAST(1 AS BIGINT), CAST(b & 63 AS INT))")).alias("x")).toPandas()
    out = np.zeros(2 << (size - 6), dtype=np.int64)
    out[got["w"].to_numpy(dtype=np.int64)] = got["x"].to_numpy(dtype=np.int64)
    return Bitmaps(size, out.view(np.uint8))


def document_hits(documents: DataFrame, maps: Bitmaps, window: int, mismatches: int) -> DataFrame:
    """(doc_id, hash, near): every place of every document whose seed the bitmaps may hold, with the words around it."""
    shared = documents.sparkSession.sparkContext.broadcast(maps)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Seeds(window, mismatches)
        size = shared.value.bits
        one, two = shared.value.unpacked()
        for b in batches:
            keys, all_texts = b.column(0), b.column(1).to_pylist()
            for lo, hi in _chunks(all_texts, CHUNK_CHARS):
                ids, starts, ends = s.read(all_texts[lo:hi])
                owner = np.repeat(np.arange(hi - lo), ends - starts)
                for at, h in s.hashes(ids, ends, ends - starts):
                    kept = one[(h >> np.uint64(64 - size)).astype(np.int64)]
                    at, h = at[kept], h[kept]
                    kept = two[((h >> np.uint64(8)) & np.uint64((1 << size) - 1)).astype(np.int64)]
                    at, h = at[kept], h[kept]
                    if len(at):
                        near = s.context(ids, at, starts[owner[at]], ends[owner[at]], -1)
                        yield pa.record_batch([keys.take(pa.array(owner[at] + lo)), pa.array(h.view(np.int64)), _lists(near.ravel(), s.width)], ["doc_id", "hash", "near"])

    return documents.where("text IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "text").mapInArrow(run, "doc_id bigint, hash bigint, near array<int>")


def _verifier(window: int, mismatches: int):
    @F.pandas_udf(T.BooleanType())
    def alike(near: pd.Series, around: pd.Series) -> pd.Series:
        if not len(near):
            return pd.Series([], dtype=bool)
        same = np.stack(near.to_numpy()) == np.stack(around.to_numpy())
        total = np.concatenate([np.zeros((len(same), 1), dtype=np.int32), np.cumsum(same, axis=1, dtype=np.int32)], axis=1)
        return pd.Series((total[:, window:] - total[:, :-window]).max(axis=1) >= window - mismatches)

    return alike


def leaked(documents: DataFrame, items: DataFrame, window: int = 24, mismatches: int = 2, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(doc_id, item_id): each document that holds ``window`` consecutive words of an item with at most ``mismatches`` replaced.

    Null ids, null and empty texts, and items or documents of fewer words than the window, give nothing; repeated rows give one pair; extra
    columns are never read. The items' seeds are broadcast if a count finds at most ``max_rows``; beyond, both sides shuffle by
    hash, and a stock phrase in a third of all texts is split over tasks.
    """
    seeds = cut(item_seeds(items, window, mismatches))
    hits = document_hits(documents, bitmaps(seeds), window, mismatches)
    if not is_small(seeds, max_rows):
        hits = stored(hits, "hits")
    both = join_sized(hits, seeds, ["hash"], "inner", salt_by=["doc_id"], max_rows=max_rows)
    return both.where(_verifier(window, mismatches)("near", "around")).select("doc_id", "item_id").distinct()


def leaked_items(pairs: DataFrame, items: DataFrame) -> DataFrame:
    """(item_id, n_documents): every item with the number of documents that give it away, 0 if none."""
    n = pairs.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    return items.select("item_id").distinct().join(n, "item_id", "left").select("item_id", F.coalesce("n", F.lit(0)).alias("n_documents"))
