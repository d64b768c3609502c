"""Benchmark decontamination: SimHash fingerprints of item-sized windows, looked up by a
multi-index of Hamming blocks, candidates verified by exact weighted-shingle similarity.

Words are runs of letters, digits and marks in lower case, shingles are ``SHINGLE`` words in
a row, a shingle's weight is its count. A window has as many words as the item it may match;
a text of fewer words is one window as a whole.
Weighted similarity is the sum of the lesser counts over the sum of the greater ones.

1. A window of m shingles can only reach the threshold s if s * m of its shingles occur in
   the benchmark, so other windows are left out; nothing that could match is lost by that.
2. The windows left get a 64-bit SimHash. Items are kept by blocks of their fingerprints: of
   two fingerprints within ``RADIUS`` bits, one of ``BLOCKS`` blocks differs by no more than
   RADIUS // BLOCKS bits, so looking up every block with its near values finds all of them.
3. Candidates within the radius are compared exactly. At the similarity of 0.8 fingerprints
   differ by 10 bits in the mean with a deviation of 3; the radius is 4.6 deviations above.

The benchmark is taken in slices of ``SLICE_ITEMS`` items, each sent to all tasks, so what
is broadcast is bounded and a larger benchmark takes more passes over the documents. Items
of fewer than ``SHINGLE`` words are one shingle of all their words.

Null or empty texts and items without words match nothing; repeated rows are judged alike;
empty tables give empty results. Only the named columns are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milepost.llm.common import pieces

SHINGLE = 5
SIMILARITY = 0.8
BITS, BLOCKS, RADIUS = 64, 8, 23
SLICE_ITEMS, SLICE_BYTES = 2_000, 16_000_000
FILTER_BITS = 22
KEPT_WORDS = 200_000
PART_BYTES = 1_000_000
WORDS = re.compile(r"\w+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class WordHashes(dict):
    """64-bit hash of each word; emptied when it has grown over the bound."""

    def __missing__(self, word: str) -> int:
        import xxhash

        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, text: str) -> np.ndarray:
        if len(self) > KEPT_WORDS:
            self.clear()
        words = WORDS.findall(text.lower())
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hashes of all runs of ``size`` words; a shorter text is one run of its own length."""
    if not len(words):
        return words
    n = max(1, len(words) - size + 1)
    with np.errstate(over="ignore"):
        value = words[:n] * _MIX
        for k in range(1, min(size, len(words))):
            value = (value ^ (value >> np.uint64(29))) * _MIX + words[k : k + n]
        return mixed(value)


def signs(hashes: np.ndarray) -> np.ndarray:
    """+1 or -1 for each bit of each hash, (n, 64)."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1)
    return bits.astype(np.int32) * 2 - 1


def packed(sums: np.ndarray) -> np.ndarray:
    """Fingerprints as 8 block values each: the bits whose weighted sum is positive."""
    return np.packbits(sums > 0, axis=1)


class Index:
    """Items of one slice: shingles, fingerprints, and for every block the items near each value."""

    def __init__(self, items: list[tuple]):
        hashes, words = WordHashes(), []
        for key, text in items:
            words.append((key, hashes.of(text)))
        self.items = [(key, len(w), shingle_hashes(w)) for key, w in words if len(w)]
        self.lengths = sorted({n for _, n, _ in self.items})
        every = np.concatenate([h for _, _, h in self.items]) if self.items else np.zeros(0, np.uint64)
        self.known = np.unique(every)
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[(every >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        prints = [packed(signs(h).sum(0, keepdims=True)) for _, _, h in self.items]
        self.prints = np.concatenate(prints) if prints else np.zeros((0, 8), np.uint8)
        ones = np.array([bin(x).count("1") for x in range(256)], np.uint8)
        self.ones = ones
        values = np.arange(256, dtype=np.uint8)
        # near[b][v]: items whose block b is within RADIUS // BLOCKS bits of v
        self.near = [ones[values[:, None] ^ self.prints[:, b]] <= RADIUS // BLOCKS for b in range(BLOCKS)]
        self.of_length = {n: np.array([m == n for _, m, _ in self.items]) for n in self.lengths}
        self.counts = [Counter(h.tolist()) for _, _, h in self.items]
        self.sizes = [len(h) for _, _, h in self.items]

    def hits(self, shingles: np.ndarray) -> np.ndarray:
        """Which shingles occur in an item."""
        found = self.filter[(shingles >> np.uint64(64 - FILTER_BITS)).astype(np.int64)]
        at = np.flatnonzero(found)
        if len(at):
            place = np.minimum(np.searchsorted(self.known, shingles[at]), len(self.known) - 1)
            found[at] = self.known[place] == shingles[at]
        return found

    def windows(self, words: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Per item length: that length, shingles of a window, starts of windows that may match, and all shingles."""
        usual = shingle_hashes(words) if len(words) >= SHINGLE else words[:0]
        usual_hits = self.hits(usual) if len(usual) else np.zeros(0, bool)
        sums = np.concatenate([[0], np.cumsum(usual_hits)])
        for n in self.lengths:
            least = SIMILARITY * (n - SHINGLE + 1) - 1e-9
            if n > len(words) and (not len(usual) or len(usual) < least):
                break  # longer items have still more shingles
            if n < SHINGLE:
                own = shingle_hashes(words, n)
                yield n, 1, np.flatnonzero(self.hits(own)), own
            elif sums[-1]:
                m = min(n - SHINGLE + 1, len(usual))
                inside = sums[m:] - sums[: len(sums) - m]
                yield n, m, np.flatnonzero(inside >= least), usual

    def promising(self, texts: list[np.ndarray]) -> np.ndarray:
        """Which texts hold any shingle of an item; all of them if an item is below a shingle."""
        if not self.lengths or self.lengths[0] < SHINGLE:
            return np.arange(len(texts)) if self.lengths else np.arange(0)
        flat, ends = np.concatenate(texts), np.cumsum([len(x) for x in texts])
        if len(flat) < SHINGLE:
            return np.arange(0)
        at = np.flatnonzero(self.hits(shingle_hashes(flat)))
        first, last = np.searchsorted(ends, at, "right"), np.searchsorted(ends, at + SHINGLE - 1, "right")
        return np.unique(first[first == last])  # not those over the seam of two texts

    def similarity(self, item: int, shingles: list[int]) -> float:
        """Sum of the lesser counts over the sum of the greater ones."""
        own, seen, both = self.counts[item], {}, 0
        for value in shingles:
            count = seen[value] = seen.get(value, 0) + 1
            both += count <= own.get(value, 0)
        return both / (len(shingles) + self.sizes[item] - both)

    def matches(self, words: np.ndarray) -> list[tuple]:
        """(item, similarity, first word, last word) of the best window of each item found."""
        best: dict = {}
        for n, m, starts, shingles in self.windows(words):
            for some in np.array_split(starts, max(1, len(starts) * 64 // 1_000_000)) if len(starts) else ():
                low = int(some[0])
                sums = np.zeros((int(some[-1]) + m - low + 1, BITS), np.int32)
                np.cumsum(signs(shingles[low : int(some[-1]) + m]), axis=0, out=sums[1:])
                prints = packed(sums[some - low + m] - sums[some - low])
                near = np.zeros((len(some), len(self.items)), bool)
                for b in range(BLOCKS):
                    near |= self.near[b][prints[:, b]]
                near &= self.of_length[n]
                window, item = np.nonzero(near)
                close = self.ones[prints[window] ^ self.prints[item]].sum(1) <= RADIUS
                for start, i in zip(some[window[close]].tolist(), item[close].tolist(), strict=True):
                    value = self.similarity(i, shingles[start : start + m].tolist())
                    if value >= SIMILARITY and (i not in best or value > best[i][0]):
                        best[i] = (value, start, min(start + n, len(words)))
        return [(self.items[i][0], *found) for i, found in sorted(best.items())]


def _slices(items: DataFrame) -> Iterator[list[tuple]]:
    some, size = [], 0
    for key, text in items.toLocalIterator():
        some.append((key, text))
        size += len(text)
        if len(some) == SLICE_ITEMS or size > SLICE_BYTES:
            yield some
            some, size = [], 0
    if some:
        yield some


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per document row and matching item: both keys, similarity, first and last word.

    The result's columns are ``key``, ``item``, ``similarity``, ``first_word`` and
    ``end_word`` (words from 0, the end exclusive).
    """
    key_type, item_type = docs.schema[key].dataType, benchmark.schema[item_key].dataType
    schema = f"key {key_type.simpleString()}, item {item_type.simpleString()}, similarity double, first_word int, end_word int"
    narrow = docs.select(docs[key].alias("key"), docs[text].alias("text")).filter(F.length("text") > 0)
    items = benchmark.select(benchmark[item_key], benchmark[item_text]).filter(F.col(item_text).isNotNull())
    empty = narrow.sparkSession.createDataFrame([], schema)
    arrow = empty.toArrow().schema
    context = docs.sparkSession.sparkContext

    def one(some: list[tuple]) -> DataFrame:
        shared = context.broadcast(some)

        def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index, hashes = None, WordHashes()
            for batch in batches:
                index = index or Index(shared.value)
                for part in pieces(batch, "text", PART_BYTES):
                    words = [hashes.of(x) for x in part.column("text").to_pylist()]
                    rows = []
                    for i in index.promising(words).tolist():
                        k = part.column("key")[i].as_py()
                        rows += [dict(zip(arrow.names, (k, *x), strict=True)) for x in index.matches(words[i])]
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, arrow)

        return narrow.mapInArrow(matched, schema)

    return reduce(DataFrame.unionAll, map(one, _slices(items)), empty)
