"""Removal of repeated byte strings by longest previous factors.

A byte goes when a string of ``length`` bytes that covers it also starts elsewhere. In
suffix order, equal strings are neighbours; the neighbour with the next smaller position is
the longest previous factor's source. Only factors of ``length`` bytes matter here, so
suffixes are ordered by their first ``length`` bytes, through a 64-bit rolling fingerprint
of them, and among equals by position: the entry before is then the earlier match (previous
smaller position), the entry after a later one. ``keep="first"`` removes what has an earlier
match; ``keep="none"`` also removes the first of several.

The suffix array is never built over the corpus. Equal texts are merged. Every string of
``length`` bytes picks its least fingerprint of ``GRAM`` bytes as anchor, so equal strings
have equal anchors; runs of starts with the same anchor travel together as one segment, and
only segments whose anchor occurs twice or more are sent, by anchor. Tasks order the
suffixes of their anchors. Anchors with more than ``GROUP_ROWS`` segments are not collected:
their fingerprints are counted by an ordinary aggregation instead, with the same result.

A null text counts as empty. Texts below ``length`` bytes, empty ones among them, stay as
they are. Matches never cross texts; repeated rows are copies of each other, with
``keep="first"`` the row of the smallest key stays (of rows with the same key, or none, all
stay). An empty table gives an empty result. Only key and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milepost.llm.common import pieces, text_bytes

LENGTH = 400
GRAM = 100
PART_BYTES = 1_000_000
GROUP_ROWS = 20_000
PLACE_BITS = 26
_BASE = 0x9E3779B97F4A7C15
_BYTE_VALUES = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Rolling:
    """Fingerprints of all strings of one length in a run of bytes."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, flat: np.ndarray, length: int) -> np.ndarray:
        n = len(flat)
        if n < length:
            return np.zeros(0, np.uint64)
        if len(self.up) < n + 1:
            steps = [np.full(n + 1, x, np.uint64) for x in (_BASE, pow(_BASE, -1, 2**64))]
            for x in steps:
                x[0] = 1
            self.up, self.down = np.cumprod(steps[0]), np.cumprod(steps[1])
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[flat] * self.up[:n], out=sums[1:])
        value = (sums[length:] - sums[: n - length + 1]) * self.down[: n - length + 1]
        value ^= value >> np.uint64(32)
        value *= np.uint64(0xD6E8FEB86659FD93)
        return value ^ (value >> np.uint64(32))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` neighbours, by doubling."""
    least, done = values, 1
    while done < width:
        step = min(done, width - done)
        least = np.minimum(least[:-step], least[step:])
        done += step
    return least


def anchor_runs(rolling: Rolling, flat: np.ndarray, bounds: list[tuple[int, int]], length: int, gram: int):
    """(text, anchor, first start, last start) of all runs of starts with the same anchor.

    ``bounds`` are the texts in ``flat``; starts are counted in ``flat``.
    """
    grams = rolling.of(flat, gram)
    low = np.uint64((1 << PLACE_BITS) - 1)
    least = sliding_min((grams & ~low) | np.arange(len(grams), dtype=np.uint64), length - gram + 1)
    if not len(least):
        return (np.zeros(0, np.int64),) * 4
    ends = np.zeros(len(least) + 1, np.int64)
    for a, b in bounds:
        if b - a >= length:
            ends[a] += 1
            ends[b - length + 1] -= 1
    starts = np.flatnonzero(np.cumsum(ends[:-1]) > 0)
    place = (least[starts] & low).astype(np.int64)
    cut = np.flatnonzero((place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)) + 1
    first = np.concatenate([[0], cut]).astype(np.int64)[: len(starts)]
    last = np.concatenate([cut, [len(starts)]]).astype(np.int64)[: len(first)] - 1
    owner = np.searchsorted(np.array([a for a, _ in bounds]), starts[first], "right") - 1
    return owner, grams[place[first]].view(np.int64), starts[first], starts[last]


def _blocks(at: np.ndarray, length: int) -> Iterator[tuple[int, int, int]]:
    """Texts of at least ``length`` bytes in blocks that share ``length - 1`` bytes."""
    for k, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
        for first in range(a, b - length + 1, PART_BYTES):
            yield k, first, min(b, first + PART_BYTES + length - 1)


def _anchors(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling()
        for batch in batches:
            for part in pieces(batch, "data", PART_BYTES):
                flat, at = text_bytes(part.column("data"))
                some: list[tuple[int, int, int]] = []

                def found(some=some, flat=flat, at=at, part=part):
                    joined = np.concatenate([flat[a:b] for _, a, b in some])
                    ends = np.cumsum([b - a for _, a, b in some]).tolist()
                    begins = [0, *ends[:-1]]
                    block, anchor, lo, hi = anchor_runs(rolling, joined, list(zip(begins, ends, strict=True)), length, gram)
                    text = np.array([k for k, _, _ in some])[block]
                    move = (np.array([a for _, a, _ in some]) - np.array(begins))[block] - at[text]
                    columns = [
                        part.column("digest").take(pa.array(text)),
                        pa.array(anchor),
                        pa.array((lo + move).astype(np.int32)),
                        pa.array((hi + move).astype(np.int32)),
                    ]
                    some.clear()
                    return pa.RecordBatch.from_arrays(columns, ["digest", "anchor", "lo", "hi"])

                size = 0
                for block in _blocks(at, length):
                    some.append(block)
                    size += block[2] - block[1]
                    if size >= PART_BYTES:
                        yield found()
                        size = 0
                if some:
                    yield found()

    return run


def _segments(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, digest, rank, marks in zip(
                *(batch.column(x) for x in ("data", "digest", "rank", "marks")), strict=True
            ):
                raw, marks = data.as_buffer(), marks.values
                anchor, rows, lo, hi = (marks.field(x) for x in ("anchor", "rows", "lo", "hi"))
                bounds = list(zip(lo.to_pylist(), hi.to_pylist(), strict=True))
                cut = [raw[a : b + length] for a, b in bounds]
                n = len(cut)
                yield pa.RecordBatch.from_arrays(
                    [
                        anchor,
                        rows,
                        pa.array([rank.as_py()] * n, pa.int64()),
                        pa.array([digest.as_py()] * n, pa.binary()),
                        lo,
                        pa.array([x.to_pybytes() for x in cut], pa.binary()),
                    ],
                    ["anchor", "rows", "rank", "digest", "lo", "data"],
                )

    return run


def _runs(found: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], found.view(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def matched(prints: np.ndarray, keep: str) -> np.ndarray:
    """Which of the suffixes, in text order, are to go: their first bytes have another start."""
    order = np.argsort(prints, kind="stable")  # suffix order; equals stay in text order
    equal = prints[order][1:] == prints[order][:-1]
    earlier, later = np.concatenate([[False], equal]), np.concatenate([equal, [False]])
    out = np.empty(len(prints), bool)
    out[order] = earlier if keep == "first" else earlier | later
    return out


def _prints(rolling: Rolling, data: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all suffix starts of all segments and the bounds of each segment's."""
    flat, at = text_bytes(data)
    every = rolling.of(flat, length)
    sizes = np.diff(at) - length + 1
    ends = np.cumsum(sizes)
    inside = np.repeat(at[:-1] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
    return every[inside], np.concatenate([[0], ends])


def _removals(length: int, keep: str):
    """Sorted segments to (digest, first byte, last byte) of what goes; anchors stay together."""

    def judged(rolling: Rolling, some: pa.Table) -> pa.RecordBatch:
        data = some.column("data").combine_chunks()
        data = data.chunk(0) if isinstance(data, pa.ChunkedArray) else data
        prints, bounds = _prints(rolling, data, length)
        gone = matched(prints, keep)
        lo, at, rows = some.column("lo").to_numpy(), [], []
        for k in np.unique(np.searchsorted(bounds, np.flatnonzero(gone), "right") - 1).tolist():
            for a, b in _runs(gone[bounds[k] : bounds[k + 1]]):
                at.append(k)
                rows.append((int(lo[k]) + a, int(lo[k]) + b - 1 + length))
        digest = some.column("digest").combine_chunks()
        digest = digest.chunk(0) if isinstance(digest, pa.ChunkedArray) else digest
        return pa.RecordBatch.from_arrays(
            [
                digest.take(pa.array(at, pa.int64())),
                pa.array([a for a, _ in rows], pa.int32()),
                pa.array([b for _, b in rows], pa.int32()),
            ],
            ["digest", "first", "end"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling, kept = Rolling(), []
        for batch in batches:
            kept.append(batch)
            anchors = batch.column("anchor").to_numpy()
            if sum(x.nbytes for x in kept) < 4_000_000 or not len(anchors):
                continue
            # Whole anchors only: what shares the last anchor waits for the next batch.
            rest = int(np.searchsorted(anchors, anchors[-1], "left"))
            if rest == 0 and all(x.column("anchor")[0].as_py() == anchors[-1] for x in kept if x.num_rows):
                continue
            if rest == 0:
                done = pa.Table.from_batches(kept)
                every = done.column("anchor").to_numpy()
                cut = int(np.searchsorted(every, anchors[-1], "left"))
                kept = done.slice(cut).to_batches()
                yield judged(rolling, done.slice(0, cut))
                continue
            done = pa.Table.from_batches([*kept[:-1], batch.slice(0, rest)])
            kept = [batch.slice(rest)]
            yield judged(rolling, done)
        if any(x.num_rows for x in kept):
            yield judged(rolling, pa.Table.from_batches(kept))

    return run


def _start_rows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling()
        for batch in batches:
            for part in pieces(batch, "data", PART_BYTES // 4):
                prints, bounds = _prints(rolling, part.column("data"), length)
                k = np.repeat(np.arange(part.num_rows), np.diff(bounds))
                start = part.column("lo").to_numpy()[k] + np.arange(len(k)) - bounds[:-1][k]
                take = pa.array(k)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(prints.view(np.int64)),
                        part.column("rank").take(take),
                        part.column("digest").take(take),
                        pa.array(start.astype(np.int32)),
                    ],
                    ["print", "rank", "digest", "start"],
                )

    return run


def _cut(length: int, keep: str):
    schema = pa.schema(
        [
            ("digest", pa.binary()),
            ("n_bytes", pa.int64()),
            ("n_removed", pa.int64()),
            ("n_spans", pa.int64()),
            ("first_copy", pa.bool_()),
            ("kept", pa.binary()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for data, digest, copies, spans in zip(
                *(batch.column(x) for x in ("data", "digest", "copies", "spans")), strict=True
            ):
                raw, n, digest = data.as_buffer(), len(data.as_buffer()), digest.as_py()
                gone = np.zeros(n + 1, np.int32)
                if spans.is_valid:
                    np.add.at(gone, spans.values.field("first").to_numpy(), 1)
                    np.add.at(gone, spans.values.field("end").to_numpy(), -1)
                gone = np.cumsum(gone)[:n] > 0
                copied = copies.as_py() > 1 and n >= length
                for first in (True, False) if copied and keep == "first" else (True,):
                    own = np.ones(n, bool) if copied and not (first and keep == "first") else gone
                    left = np.frombuffer(raw, np.uint8)[~own].tobytes()
                    rows.append((digest, n, int(own.sum()), len(_runs(own)), first, left))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema
            )

    return run


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, keep: str = "first"
) -> DataFrame:
    """One row per input row: key, n_bytes, n_removed, n_spans, kept (binary) and kept_sha256.

    The key has to be a whole number; it orders the texts where the first is kept.
    """
    if keep not in ("first", "none") or length < 2:
        raise ValueError("keep must be first or none, length 2 at least")
    gram = max(1, length * GRAM // LENGTH)
    rows = docs.select(
        F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("data")
    ).withColumn("digest", F.unhex(F.md5("data")))
    # One exchange of the texts, which the three passes below share.
    texts = rows.groupBy("digest").agg(
        F.first("data").alias("data"), F.count("*").alias("copies"), F.min("key").alias("rank")
    )
    anchors = texts.mapInArrow(_anchors(length, gram), "digest binary, anchor long, lo int, hi int")
    shared = anchors.groupBy("anchor").agg(F.count("*").alias("rows")).filter("rows > 1")
    marks = (
        anchors.join(shared, "anchor")
        .groupBy("digest")
        .agg(F.collect_list(F.struct("anchor", "rows", "lo", "hi")).alias("marks"))
    )
    segments = texts.join(marks, "digest").mapInArrow(
        _segments(length), "anchor long, rows long, rank long, digest binary, lo int, data binary"
    )
    usual = (
        segments.filter(F.col("rows") <= GROUP_ROWS)
        .repartition("anchor")
        .sortWithinPartitions("anchor", "rank", "digest", "lo")
        .mapInArrow(_removals(length, keep), "digest binary, first int, end int")
    )
    starts = segments.filter(F.col("rows") > GROUP_ROWS).mapInArrow(
        _start_rows(length), "print long, rank long, digest binary, start int"
    )
    place = F.struct(F.coalesce("rank", F.lit(-(2**63))).alias("rank"), "digest", "start")
    counted = starts.groupBy("print").agg(F.count("*").alias("n"), F.min(place).alias("head")).filter("n > 1")
    hot = starts.join(counted, "print")
    if keep == "first":
        hot = hot.filter(place != F.col("head"))
    hot = hot.select("digest", F.col("start").alias("first"), (F.col("start") + length).alias("end"))
    spans = usual.unionAll(hot).groupBy("digest").agg(F.collect_list(F.struct("first", "end")).alias("spans"))
    cut = texts.join(spans, "digest", "left").mapInArrow(
        _cut(length, keep),
        "digest binary, n_bytes long, n_removed long, n_spans long, first_copy boolean, kept binary",
    )
    cut = cut.withColumn("kept_sha256", F.sha2("kept", 256))
    lead = texts.select("digest", "rank")
    if keep == "none":
        joined = rows.select("key", "digest").join(cut, "digest")
    else:
        first = F.col("key").eqNullSafe(F.col("rank")) | F.col("rank").isNull() | (F.col("n_bytes") < length)
        own = rows.select("key", "digest", F.octet_length("data").alias("n_bytes")).join(lead, "digest")
        own = own.select("key", "digest", first.alias("own_first"))
        joined = own.join(cut, "digest").filter(
            (F.col("first_copy") == F.col("own_first")) | (F.col("n_bytes") < length)
        )
        # A text without copies has one entry only, whichever row asks.
    return joined.select(F.col("key").alias(key), "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256")
