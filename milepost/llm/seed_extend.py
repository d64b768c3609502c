"""Removal of word passages that a document with a smaller key has: seed and extend.

A window is ``window`` consecutive words. Seeds are winnowed anchors: of all runs of ``SEED``
words in a window the one with the least fingerprint, the last of equals. Equal windows have the
same anchor at the same place, so documents are joined on anchors, and only there. Each document
brings, per anchor, the words around it that its windows with this anchor reach.

Equal contexts go first: of occurrences whose reached words are all equal, only those of the
smallest key are extended, the others are lost at once. They are counted by an aggregation, so a
passage with any number of copies is brought into a task once.

From an anchor the matches of the remaining contexts are extended one word at a time, to the
left and to the right, all together: after ``a`` words to the left they fall into classes of
equal words, and the next word splits these classes, so no pair is built. Occurrences in the same
left class after ``a`` words and in the same right class after the rest of the window have the
same window; the smallest key of the class keeps it, larger keys lose it. Lost windows of a
document merge into maximal repeats, which are the spans that go.

Anchors with more than ``GROUP_ROWS`` occurrences are not brought into one task: their contexts
are compared by an aggregation that combines before the shuffle, and if more than that many
different contexts are left, a window is the digest of its extension's words and digests are
aggregated in the same way. The result is the same.

Words are runs of characters other than blanks and controls 9 to 13; spans count words. A null
text has no words. A null key counts as larger than all others (as does the largest long, which
comes back as null). Repeated rows, and rows with equal keys in general, do not remove each
other's words. Texts below ``window`` words stay. Very long texts are read in blocks of words. An
empty table gives an empty result. Only key and text are read, so no other column can clash; the
key has to be a whole number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from milepost.llm.common import pieces, text_bytes
from milepost.session import staged

WINDOW = 50
SEED = 12
PART_BYTES = 1_000_000
PART_WORDS = 150_000
GROUP_ROWS = 20_000
GROUP_BYTES = 8_000_000
# Lists of large anchors up to this number are broadcast, longer ones are joined by shuffle.
BROADCAST_ROWS = 1_000_000
NO_KEY = 2**63 - 1
_BLANKS = r"[\x20\x09-\x0D]+"
_BASE = 0x9E3779B97F4A7C15


def normal(text: Column) -> Column:
    """The words of a text joined by one blank; null has none."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), _BLANKS, " "))


def word_hashes(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of words, given by their bounds; every different word is hashed once."""
    lengths = ends - starts
    keep = np.zeros(len(flat) + 1, np.int32)
    np.add.at(keep, starts, 1)
    np.add.at(keep, ends, -1)
    data = flat[np.cumsum(keep[:-1]) > 0]
    bounds = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
    coded = words.dictionary_encode()
    own = np.array([xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    return own[coded.indices.to_numpy()] if len(own) else own


def seed_prints(hashes: np.ndarray, seed: int) -> np.ndarray:
    """Fingerprints of all runs of ``seed`` words."""
    if len(hashes) < seed:
        return np.zeros(0, np.uint64)
    powers = np.cumprod(np.full(seed, _BASE, np.uint64))
    value = np.zeros(len(hashes) - seed + 1, np.uint64)
    for k in range(seed):
        value += hashes[k : k + len(value)] * powers[k]
    value ^= value >> np.uint64(32)
    value *= np.uint64(0xD6E8FEB86659FD93)
    return value ^ (value >> np.uint64(32))


def winnowed(prints: np.ndarray, width: int) -> np.ndarray:
    """For every ``width`` neighbours the place of their least print, the last of equals."""
    least = np.arange(len(prints))
    done = 1
    while done < width:
        step = min(done, width - done)
        left, right = least[:-step], least[step:]
        least = np.where(prints[right] <= prints[left], right, left)
        done += step
    return least


def _word_blocks(data: pa.Array, window: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of whole texts, or of parts of a long one that share some words.

    Gives hashes of the words, the text of each word, its place in the text, and whether a
    window that starts there is of this block.
    """
    flat, at = text_bytes(data)
    blank = flat == 32
    after = np.concatenate([[True], blank])
    after[at] = True
    starts = np.flatnonzero(~blank & after[:-1])
    text = np.searchsorted(at, starts, "right") - 1
    stops = np.sort(np.concatenate([np.flatnonzero(blank), at[1:]]))
    ends = stops[np.searchsorted(stops, starts, "right")]
    first_word = np.searchsorted(starts, at)
    place = np.arange(len(starts)) - first_word[text]
    left = first_word[text + 1] - np.arange(len(starts))
    for a in range(0, len(starts), PART_WORDS):
        # The windows of one anchor start within one window's words.
        b = min(len(starts), a + PART_WORDS + 2 * window)
        lo, hi = starts[a], ends[b - 1]
        hashes = word_hashes(flat[lo:hi], starts[a:b] - lo, ends[a:b] - lo)
        own = left[a:b] >= window
        own[PART_WORDS:] = False
        yield hashes, text[a:b], place[a:b], own


def _runs_of(hashes: np.ndarray, text: np.ndarray, own: np.ndarray, window: int, seed: int):
    """(word of the anchor, first and last start) of runs of windows with the same anchor."""
    prints = seed_prints(hashes, seed)
    starts = np.flatnonzero(own)
    if not len(starts):
        return prints, *(np.zeros(0, np.int64),) * 3
    anchor = winnowed(prints, window - seed + 1)[starts]
    cut = np.flatnonzero((anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)) + 1
    first = np.concatenate([[0], cut])
    last = np.concatenate([cut, [len(starts)]]) - 1
    return prints, anchor[first], starts[first], starts[last]


def _contexts(hashes: np.ndarray, anchor: np.ndarray, lo: np.ndarray, hi: np.ndarray, window: int) -> np.ndarray:
    """Fingerprint of all words that the windows of each run reach, and of the run's form."""
    up, down = (np.cumprod(np.full(len(hashes) + 1, x, np.uint64)) for x in (_BASE, pow(_BASE, -1, 2**64)))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up[:-1])])
    value = (sums[hi + window] - sums[lo]) * down[lo]
    value ^= (anchor - lo).astype(np.uint64) << np.uint64(32) | (hi - anchor + window).astype(np.uint64)
    value *= np.uint64(0xD6E8FEB86659FD93)
    return value ^ (value >> np.uint64(32))


def _anchors(window: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "data", PART_BYTES):
                for hashes, text, place, own in _word_blocks(part.column("data"), window):
                    prints, anchor, lo, hi = _runs_of(hashes, text, own, window, seed)
                    if not len(lo):
                        continue
                    move = (place - np.arange(len(place)))[lo]
                    some = pa.array(text[lo])
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(part.column(x).take(some) for x in ("rank", "print")),
                            pa.array(prints[anchor].view(np.int64)),
                            pa.array(_contexts(hashes, anchor, lo, hi, window).view(np.int64)),
                            *(pa.array((x + move).astype(np.int32)) for x in (anchor, lo, hi)),
                        ],
                        ["rank", "print", "anchor", "context", "at", "lo", "hi"],
                    )

    return run


def met(anchors: DataFrame, group_rows: int) -> DataFrame:
    """Occurrences of anchors found elsewhere, with their context's ``least`` key.

    ``classes`` bounds the different contexts of the anchor; one class needs no extension.
    """
    sizes = staged(anchors.groupBy("anchor").agg(F.count("*").alias("classes")).filter("classes > 1"))
    large = sizes.filter(F.col("classes") > group_rows).select("anchor")
    n_large = large.count()
    listed = F.broadcast(large) if n_large <= BROADCAST_ROWS else large
    # Rows of large anchors leave before the rest is dealt by anchor.
    rest = anchors.join(listed, "anchor", "left_anti") if n_large else anchors
    own = Window.partitionBy("anchor")
    several = F.min("context").over(own) != F.max("context").over(own)
    usual = rest.join(sizes.filter(F.col("classes") <= group_rows).hint("merge"), "anchor").select(
        "rank",
        "print",
        "anchor",
        *("at", "lo", "hi"),
        F.min("rank").over(Window.partitionBy("anchor", "context")).alias("least"),
        F.when(several, F.col("classes")).otherwise(1).alias("classes"),
    )
    if not n_large:
        return usual
    hot = anchors.join(listed, "anchor")
    contexts = hot.groupBy("anchor", "context").agg(F.min("rank").alias("least"))
    counted = contexts.groupBy("anchor").agg(F.count("*").alias("classes"))
    hot = hot.join(contexts.join(counted, "anchor"), ["anchor", "context"])
    return usual.unionByName(hot.select(*usual.columns))


def _segments(window: int, seed: int):
    """Texts with their shared anchors to the words that the windows of each anchor reach.

    ``left`` has the hashes of the words before the anchor, nearest first, ``right`` those after.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "classes", "at", "lo", "hi"]
        for batch in _unlike_last(batches):
            for part in pieces(batch, "data", PART_BYTES):
                marks = part.column("marks")
                field = {x: marks.values.field(x) for x in names}
                bounds = marks.offsets.to_numpy()
                owner = np.repeat(np.arange(part.num_rows), np.diff(bounds))
                at, lo, hi = (field[x].to_numpy()[bounds[0] : bounds[-1]].astype(np.int64) for x in ("at", "lo", "hi"))
                for hashes, text, place, _ in _word_blocks(part.column("data"), window):
                    seen, where = np.unique(text, return_index=True)
                    # Places of the first word in the block and after the last one, by text.
                    begin, finish = np.zeros(part.num_rows, np.int64), np.full(part.num_rows, -1)
                    move = np.zeros(part.num_rows, np.int64)
                    begin[seen], move[seen] = place[where], where - place[where]
                    finish[seen] = place[np.concatenate([where[1:], [len(text)]]) - 1] + 1
                    has = (lo >= begin[owner]) & (lo < finish[owner]) & (lo + move[owner] < PART_WORDS)
                    rows = np.flatnonzero(has)
                    if not len(rows):
                        continue
                    here = move[owner[rows]]
                    sides = [
                        _cut(hashes[::-1], len(hashes) - (at[rows] + here), at[rows] - lo[rows]),
                        _cut(hashes, at[rows] + here + seed, hi[rows] + window - at[rows] - seed),
                    ]
                    some, own = pa.array(owner[rows]), pa.array(rows + bounds[0])
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(part.column(x).take(some) for x in ("rank", "print")),
                            *(field[x].take(own) for x in names),
                            *sides,
                        ],
                        ["rank", "print", *names, "left", "right"],
                    )

    return run


def _unlike_last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated rows, which a join leaves next to each other, only once."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = np.stack([batch.column(x).to_numpy() for x in ("rank", "print")])
        new = np.concatenate([[last is None or (ids[:, 0] != last).any()], (ids[:, 1:] != ids[:, :-1]).any(axis=0)])
        last = ids[:, -1]
        yield batch if new.all() else batch.filter(pa.array(new))


def _cut(values: np.ndarray, first: np.ndarray, size: np.ndarray) -> pa.Array:
    """Runs of ``values`` as binary values."""
    ends = np.cumsum(size)
    total = int(ends[-1])
    inside = np.repeat(first - (ends - size), size) + np.arange(total)
    bounds = np.concatenate([[0], ends * 8]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(values[inside]))])


def _column(rows: pa.Table, name: str) -> pa.Array:
    column = rows.column(name).combine_chunks()
    return pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column


def _words_of(rows: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """All hashes of a binary column and the bounds of each row's."""
    flat, at = text_bytes(_column(rows, name))
    return np.frombuffer(flat.tobytes(), np.uint64), at // 8


def _classes(start: np.ndarray, words: np.ndarray, at: np.ndarray, steps: int) -> list[np.ndarray]:
    """Classes of occurrences after 0, 1 ... ``steps`` words of extension; -1 beyond a row's words."""
    classes = [start]
    size = np.diff(at)
    for k in range(steps):
        before = classes[-1]
        rows = np.flatnonzero(size > k)
        after = np.full(len(start), -1)
        if len(rows):
            _, word = np.unique(words[at[rows] + k], return_inverse=True)
            _, after[rows] = np.unique(before[rows] * (word.max() + 1) + word, return_inverse=True)
        classes.append(after)
    return classes


def repeated(rows: pa.Table, window: int, seed: int) -> np.ndarray:
    """(row, start) of all windows that a smaller key has; rows are sorted by anchor and rank."""
    anchor, rank = (_column(rows, x).to_numpy() for x in ("anchor", "rank"))
    at, lo, hi = (_column(rows, x).to_numpy().astype(np.int64) for x in ("at", "lo", "hi"))
    _, start = np.unique(anchor, return_inverse=True)
    free = window - seed
    left = _classes(start, *_words_of(rows, "left"), free)
    right = _classes(start, *_words_of(rows, "right"), free)
    found = []
    for back in range(free + 1):
        own = np.flatnonzero((at - back >= lo) & (at - back <= hi))
        if not len(own):
            continue
        pair = left[back][own] * (right[free - back].max() + 1) + right[free - back][own]
        _, head, member = np.unique(pair, return_index=True, return_inverse=True)
        lost = rank[own] > rank[own][head][member]
        found.append(np.stack([own[lost], at[own[lost]] - back]))
    return np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)


def _spans(rows: pa.Table, lost: np.ndarray, window: int) -> pa.RecordBatch:
    """Runs of lost windows of a row as (rank, print, first word, end word)."""
    order = np.lexsort((lost[1], lost[0]))
    row, start = lost[:, order]
    cut = np.flatnonzero((row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)) + 1
    first = np.concatenate([[0], cut]).astype(np.int64)[: len(row)]
    last = np.concatenate([cut, [len(row)]]).astype(np.int64)[: len(first)] - 1
    return pa.RecordBatch.from_arrays(
        [
            *(_column(rows, x).take(pa.array(row[first])) for x in ("rank", "print")),
            pa.array(start[first].astype(np.int32)),
            pa.array((start[last] + window).astype(np.int32)),
        ],
        ["rank", "print", "first", "end"],
    )


def _extended(window: int, seed: int):
    """Rows sorted by anchor and rank, in blocks of whole anchors, to spans."""

    def spans(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        return _spans(rows, repeated(rows, window, seed), window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.nbytes
            if size < GROUP_BYTES:
                continue
            rows = pa.Table.from_batches(held)
            anchors = _column(rows, "anchor").to_numpy()
            cut = int(np.searchsorted(anchors, anchors[-1], "left"))
            if cut:
                yield spans(rows.slice(0, cut).to_batches())
                held = rows.slice(cut).to_batches()
                size = sum(x.nbytes for x in held)
        if held:
            yield spans(held)

    return run


def _window_digests(window: int, seed: int):
    """Rows of hot anchors to one row per window, the words of its extension as a digest."""
    free = window - seed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, start, digests = [], [], []
            sides = zip(*(batch.column(x) for x in ("at", "lo", "hi", "left", "right")), strict=True)
            for k, (at, lo, hi, left, right) in enumerate(sides):
                at, before, after = at.as_py(), left.as_py(), right.as_py()
                for first in range(lo.as_py(), hi.as_py() + 1):
                    back = at - first
                    words = back.to_bytes(4) + before[: 8 * back] + after[: 8 * (free - back)]
                    owner.append(k)
                    start.append(first)
                    digests.append(hashlib.blake2b(words, digest_size=16).digest())
            some = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(x).take(some) for x in ("anchor", "rank", "print")),
                    pa.array(start, pa.int32()),
                    pa.array(digests, pa.binary()),
                ],
                ["anchor", "rank", "print", "first", "words"],
            )

    return run


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts and their lost spans to what is left and the maximal repeats."""
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())])), pa.binary()]
    for batch in batches:
        out = []
        for rank, data, spans in zip(*(batch.column(x) for x in ("rank", "data", "spans")), strict=True):
            raw = data.as_buffer()
            flat = np.frombuffer(raw, np.uint8)
            # Places where words begin, and one after the last.
            begins = np.concatenate([[0], np.flatnonzero(flat == 32) + 1, [len(flat)]]) if len(flat) else np.zeros(1, np.int64)
            n, repeats = len(begins) - 1, []
            if spans.is_valid:
                gone = np.zeros(n + 1, np.int32)
                np.add.at(gone, spans.values.field("first").to_numpy(), 1)
                np.add.at(gone, spans.values.field("end").to_numpy(), -1)
                edges = np.flatnonzero(np.diff(np.concatenate([[0], (np.cumsum(gone) > 0).view(np.int8), [0]])))
                repeats = list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))
            left, at = [], 0
            for a, b in [*repeats, (n, n)]:
                left.append(raw[int(begins[at]) : int(begins[a])])
                at = b
            kept = b"".join(memoryview(x) for x in left)
            removed = sum(b - a for a, b in repeats)
            out.append((rank.as_py(), n, removed, [{"first": a, "end": b} for a, b in repeats], kept.rstrip(b" ")))
        columns = zip(*out, strict=True) if out else ([] for _ in kinds)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["rank", "n_words", "n_removed", "repeats", "kept"]
        )


def remove_repeats(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    seed: int = SEED,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """One row per input row: key, n_words, n_removed, repeats (first word, end word) and kept text."""
    if not 0 < seed <= window:
        raise ValueError("a seed has one word at least and fits into a window")
    texts = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY)).alias("rank"), normal(F.col(text)).alias("data"))
    # Key and print tell rows apart that are not equal in key and words. The joins below have one
    # plan for every size, so the exchange of the texts is shared by both that need them.
    texts = texts.select("rank", F.xxhash64("data").alias("print"), "data")
    anchors = staged(
        texts.mapInArrow(_anchors(window, seed), "rank long, print long, anchor long, context long, at int, lo int, hi int")
    )
    found = staged(met(anchors, group_rows).filter("rank > least OR classes > 1"))
    end = (F.col("hi") + window).cast("int")
    lost = found.filter("rank > least").select("rank", "print", F.col("lo").alias("first"), end.alias("end"))
    heads = found.filter("rank = least AND classes > 1")

    def segments(chosen: DataFrame) -> DataFrame:
        marks = chosen.groupBy("rank", "print").agg(
            F.collect_list(F.struct("anchor", "classes", "at", "lo", "hi")).alias("marks")
        )
        return texts.join(marks.hint("merge"), ["rank", "print"]).mapInArrow(
            _segments(window, seed),
            "rank long, print long, anchor long, classes long, at int, lo int, hi int, left binary, right binary",
        )

    extended = (
        segments(heads.filter(F.col("classes") <= group_rows))
        .repartition("anchor")
        .sortWithinPartitions("anchor", "rank")
        .mapInArrow(_extended(window, seed), "rank long, print long, first int, end int")
    )
    spans = lost.unionAll(extended)
    large = heads.filter(F.col("classes") > group_rows)
    if not large.isEmpty():
        single = segments(large).mapInArrow(
            _window_digests(window, seed), "anchor long, rank long, print long, first int, words binary"
        )
        owners = single.groupBy("anchor", "words").agg(F.min("rank").alias("least"), F.max("rank").alias("most"))
        hot = single.join(owners.filter("least < most"), ["anchor", "words"]).filter("rank > least")
        spans = spans.unionAll(hot.select("rank", "print", "first", (F.col("first") + window).cast("int").alias("end")))
    spans = spans.groupBy("rank", "print").agg(F.collect_list(F.struct("first", "end")).alias("spans"))
    cut = texts.join(spans.hint("merge"), ["rank", "print"], "left").mapInArrow(
        _kept, "rank long, n_words long, n_removed long, repeats array<struct<first:int,end:int>>, kept binary"
    )
    own = F.when(F.col("rank") != NO_KEY, F.col("rank")).cast(docs.schema[key].dataType)
    return cut.select(own.alias(key), "n_words", "n_removed", "repeats", F.col("kept").cast("string").alias("kept"))
