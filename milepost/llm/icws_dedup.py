"""Near-duplicates by improved consistent weighted sampling (ICWS) over TF-IDF shingles.

Shingles are five words in a row (runs of ASCII letters and digits in lower case and of all
other characters beyond ASCII); a shingle weighs its count in the text times the mean
inverse document frequency of its words. Document frequencies are counted over all rows in
2**16 hash buckets of words, a table of fixed size.

1. Equal texts are merged. Each text gets ``BANDS`` keys of ``ROWS`` samples. At a weighted
   Jaccard similarity of 0.8 a pair shares no key once in 40,000 pairs.
2. Texts with the same key are compared with a lead, the one of them that shares most keys
   with others, and links are joined to components; so again with a second lead among the
   texts outside the first one's component. Then all texts of a key that are in different
   components meet, so no link between components is lost: only the key's largest component is
   spared as a start, and leads, which have met all others. For that the texts of such keys get
   512 samples of four bits (at 0.8, 96 differ with a deviation of 9; 134 are let through).
   In keys of more than ``SHARP_FROM`` texts, where pairs just below the threshold are many, two
   bits of 4,096 samples are looked at as well (at 0.8, 614 differ with a deviation of 23; 715 are
   let through, which is a similarity of 0.767 and not 0.72).
   Before texts are fetched, three bits of each of the 80 samples and the total weights rule
   out pairs (at 0.8, 14 samples differ in them with a deviation of 3.4; 30 are let through).
3. Candidates are verified by exact weighted Jaccard similarity.
4. Links are joined to classes by alternating star contraction, in tables that are written
   each round; nothing of it passes through the driver but a checksum.

Null texts count as empty; texts without words are duplicates of equal texts only. Texts of
fewer than five words are one shingle. Repeated rows share a class. The class is the least
key in it (null if all keys are). An empty table gives an empty result. Only key and text
are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.llm.common import pieces, text_bytes
from milepost.session import staged

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 20, 4
SAMPLES = BANDS * ROWS
BUCKET_BITS = 16
PLANES = 3
SKETCH_SLACK = 30
# Shingles that a task remembers while it verifies pairs.
KEPT_SHINGLES = 2_000_000
STARS = 2
# Texts that are compared with all of their keys get so many samples, and four bits of each.
FINE_SAMPLES, FINE_PLANES, FINE_SLACK = 512, 4, 134
# Those of keys with more texts than this, so many more.
SHARP_FROM = 64
SHARP_SAMPLES, SHARP_PLANES, SHARP_SLACK = 4096, 2, 715
PART_BYTES = 1_000_000
BLOCK = 1024
# The texts that meet their whole keys are broadcast up to this size. Beyond, the runtime splits both sides of a
# large key: the parts that meet grow with the square of its bytes, which pays for large parts only.
OPEN_BYTES = "32m"
# Keys of texts to fetch are broadcast up to this number (16 bytes each), joined by shuffle beyond.
BROADCAST_KEYS = 500_000
_BASE = 0x9E3779B97F4A7C15

_letters = np.zeros(256, bool)
_letters[[*range(48, 58), *range(65, 91), *range(97, 123), 95, *range(128, 256)]] = True
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_rng = np.random.default_rng(11)
_values = _rng.integers(1, 2**63, 256, dtype=np.uint64)[_lower]
# Quantiles of the gamma law of shape 2 that samples draw from.
_grid = np.geomspace(1e-4, 40, 1 << 18)
_gamma = np.interp((np.arange(1 << 16) + 0.5) / (1 << 16), -np.expm1(-_grid) - _grid * np.exp(-_grid), _grid)
_r, _log_c = _gamma.astype(np.float32), np.log(_gamma).astype(np.float32)
_turns = _rng.integers(1, 2**63, SHARP_SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class Words:
    """Hashes of the words of all texts of a batch, from prefix sums over their bytes."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, flat: np.ndarray, at: np.ndarray, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Word hashes in order, and the bounds of each text in them; of the first ``most`` bytes if given."""
        n = len(flat)
        if not n:
            return np.zeros(0, np.uint64), np.zeros(len(at), np.int64)
        if len(self.up) < n + 1:
            steps = [np.full(n + 1, x, np.uint64) for x in (_BASE, pow(_BASE, -1, 2**64))]
            for x in steps:
                x[0] = 1
            self.up, self.down = np.cumprod(steps[0]), np.cumprod(steps[1])
        inside = np.zeros(n + 2, bool)
        inside[1:-1] = _letters[flat]
        edge = np.zeros(n + 1, bool)
        edge[at] = True
        begin = inside[1:] & (~inside[:-1] | edge)
        end = inside[:-1] & (~inside[1:] | edge)
        first, last = np.flatnonzero(begin), np.flatnonzero(end)
        if most:
            last = np.minimum(last, first + most)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_values[flat] * self.up[:n], out=sums[1:])
        return mixed((sums[last] - sums[first]) * self.down[first]), np.searchsorted(first, at)


def shingles(words: np.ndarray, bounds: np.ndarray, idf: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per text: its distinct shingle hashes and their weights."""
    own = idf[(words >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)]
    sums = np.concatenate([[0.0], np.cumsum(own)])
    n = max(0, len(words) - SHINGLE + 1)
    value = words[:n].copy()
    for k in range(1, SHINGLE):
        value = (value ^ (value >> np.uint64(29))) * np.uint64(_BASE) + words[k : k + n]
    value = mixed(value)
    mean = (sums[SHINGLE:] - sums[: len(sums) - SHINGLE]) / SHINGLE if n else sums[:0]
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            found, where, count = np.unique(value[a : b - SHINGLE + 1], return_index=True, return_counts=True)
            yield found, count * mean[a + where]
        elif b > a:
            whole = words[a : a + 1].copy()
            for k in range(a + 1, b):
                whole = (whole ^ (whole >> np.uint64(29))) * np.uint64(_BASE) + words[k : k + 1]
            yield mixed(whole + np.uint64(b - a)), own[a:b].mean(keepdims=True)
        else:
            yield words[:0], own[:0]


def samples(hashes: np.ndarray, weights: np.ndarray, n: int = SAMPLES) -> np.ndarray:
    """``n`` 64-bit numbers: two texts agree in one with the probability of their similarity."""
    # Each sample's mix of the whole hash gives a shingle its own r and c (16 bits each) and beta (32 bits).
    logs = np.log(weights).astype(np.float32)
    best, every = np.full(n, np.inf, np.float32), np.arange(n)
    out = np.zeros(n, np.uint64)
    size = BLOCK * SAMPLES // n
    for a in range(0, len(hashes), size):
        some, lw = hashes[a : a + size], logs[a : a + size]
        drawn = _turns[:n, None] * some
        drawn ^= drawn >> np.uint64(32)
        drawn *= np.uint64(0x94D049BB133111EB)
        drawn ^= drawn >> np.uint64(29)
        bits = drawn.view(np.uint16).reshape(n, -1, 4)
        r, rank = _r.take(bits[..., 3]), _log_c.take(bits[..., 2])
        beta = drawn.view(np.uint32)[:, ::2].astype(np.float32) * np.float32(2**-32)
        step = np.floor(lw / r + beta)
        rank -= r
        rank -= r * (step - beta)
        at = rank.argmin(1)
        lead = rank[every, at]
        better = lead < best
        best[better] = lead[better]
        chosen = mixed(some[at] + (step[every, at].astype(np.int64).view(np.uint64) * np.uint64(_BASE)))
        out[better] = chosen[better]
    return out


def band_keys(taken: np.ndarray) -> np.ndarray:
    rows = taken.reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(_BASE)
    for k in range(ROWS):
        key = mixed(key + rows[:, k])
    return key.view(np.int64)


def sketch_of(taken: np.ndarray, planes: int) -> np.ndarray:
    """Bits of the samples, plane by plane, 64 samples a number."""
    bits = np.zeros((planes, -(-len(taken) // 64) * 64), np.uint8)
    for plane in range(planes):
        bits[plane, : len(taken)] = (taken >> np.uint64(63 - plane)).astype(np.uint8) & 1
    return np.packbits(bits, axis=1).view(np.int64).ravel()


def lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows)))


def word_idf(rows: DataFrame) -> np.ndarray:
    """Inverse document frequency of each word bucket over all rows (column ``data``)."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, found, n = Words(), np.zeros((1 << BUCKET_BITS) + 1, np.int64), 0
        for batch in batches:
            for part in pieces(batch, "data", PART_BYTES):
                values, bounds = words.of(*text_bytes(part.column("data")))
                text = np.repeat(np.arange(part.num_rows), np.diff(bounds))
                pair = np.unique((text << BUCKET_BITS) | (values >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
                found[:-1] += np.bincount(pair & ((1 << BUCKET_BITS) - 1), minlength=1 << BUCKET_BITS)
                n += part.num_rows
        found[-1] = n
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(found[at])], ["bucket", "n"])

    counts = rows.select("data").mapInArrow(counted, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    table = np.zeros((1 << BUCKET_BITS) + 1, np.int64)
    got = counts.toArrow()  # a row per bucket at most, whatever the input
    table[got.column("bucket").to_numpy()] = got.column("n").to_numpy()
    return np.log((table[-1] + 1) / (table[:-1] + 1)) + 1


def signatures(texts: DataFrame, idf: np.ndarray, n: int = SAMPLES, planes: int = PLANES) -> DataFrame:
    """Per distinct text with words: digest, total weight, band keys and a sketch of ``n`` samples."""
    shared = texts.sparkSession.sparkContext.broadcast(idf)

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            for part in pieces(batch, "data", PART_BYTES):
                values, bounds = words.of(*text_bytes(part.column("data")))
                at, total, keys, sketches = [], [], [], []
                for i, (h, w) in enumerate(shingles(values, bounds, shared.value)):
                    if len(h):
                        taken = samples(h, w, n)
                        at.append(i), total.append(float(w.sum()))
                        keys.append(band_keys(taken[:SAMPLES])), sketches.append(sketch_of(taken, planes))
                if at:
                    yield pa.RecordBatch.from_arrays(
                        [part.column("digest").take(pa.array(at)), pa.array(total), lists(keys), lists(sketches)],
                        ["digest", "weight", "keys", "sketch"],
                    )

    columns = "digest binary, weight double, keys array<long>, sketch array<long>"
    return texts.select("digest", "data").mapInArrow(signed, columns)


def similar_sketch(a: Column, b: Column, fine: bool = False) -> Column:
    """Pairs that may reach the threshold, by total weights and sample bits."""
    n, planes, slack = (FINE_SAMPLES, FINE_PLANES, FINE_SLACK) if fine else (SAMPLES, PLANES, SKETCH_SLACK)
    width = -(-n // 64)

    def apart(part: int) -> Column:
        differ = [a["sketch"][p * width + part].bitwiseXOR(b["sketch"][p * width + part]) for p in range(planes)]
        return F.bit_count(reduce(Column.bitwiseOR, differ))

    light, heavy = F.least(a["weight"], b["weight"]), F.greatest(a["weight"], b["weight"])
    return (light >= heavy * (SIMILARITY - 1e-9)) & (reduce(Column.__add__, map(apart, range(width))) <= slack)


def similar_sharp(a: Column, b: Column) -> Column:
    """The same by two sharp sketches; true if a text has none."""
    width = SHARP_SAMPLES // 64

    def apart(part: Column) -> Column:
        differ = [F.get(a, part + p * width).bitwiseXOR(F.get(b, part + p * width)) for p in range(SHARP_PLANES)]
        return F.bit_count(reduce(Column.bitwiseOR, differ))

    parts = F.sequence(F.lit(0), F.lit(width - 1))
    apart_in_all = F.aggregate(parts, F.lit(0), lambda sum, part: sum + apart(part))
    return F.coalesce(apart_in_all <= SHARP_SLACK, F.lit(True))


def texts_of(needed: DataFrame, rows: DataFrame) -> DataFrame:
    """The texts of some digests, each once; ``needed`` is a written table of distinct digests."""
    few = needed.count() <= BROADCAST_KEYS
    found = rows.select("digest", "data").join(F.broadcast(needed) if few else needed, "digest", "left_semi")
    return found.groupBy("digest").agg(F.first("data").alias("data"))


def verified(pairs: DataFrame, rows: DataFrame, idf: np.ndarray) -> DataFrame:
    """Of pairs (a, b) of digests those whose weighted Jaccard similarity reaches the threshold."""
    shared = pairs.sparkSession.sparkContext.broadcast(idf)
    needed = staged(pairs.select(F.explode(F.array("a", "b")).alias("digest")).distinct())
    texts = staged(texts_of(needed, rows))
    both = pairs.join(texts.select(F.col("digest").alias("a"), F.col("data").alias("one")), "a")
    both = both.join(texts.select(F.col("digest").alias("b"), F.col("data").alias("two")), "b")

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen, kept = Words(), {}, 0

        def weighed(digest: bytes, data: pa.Array) -> tuple[np.ndarray, np.ndarray, float]:
            nonlocal kept
            if digest not in seen:
                if kept > KEPT_SHINGLES:
                    seen.clear()
                    kept = 0
                found, weights = next(shingles(*words.of(*text_bytes(data)), shared.value))
                seen[digest] = found, weights, weights.sum()
                kept += len(found)
            return seen[digest]

        for batch in batches:
            out = []
            for i, (a, b) in enumerate(zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True)):
                left = weighed(a, batch.column("one").slice(i, 1))
                right = weighed(b, batch.column("two").slice(i, 1))
                _, p, q = np.intersect1d(left[0], right[0], assume_unique=True, return_indices=True)
                common = np.minimum(left[1][p], right[1][q]).sum()
                out.append(common / (left[2] + right[2] - common))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(out, pa.float64())], ["a", "b", "similarity"]
            )

    judged_pairs = both.select("a", "b", "one", "two").mapInArrow(judged, "a binary, b binary, similarity double")
    return judged_pairs.filter(F.col("similarity") >= SIMILARITY - 1e-9)


def components(links: DataFrame) -> DataFrame:
    """(node, root) of all nodes of ``links`` (a, b) but the roots, by alternating star contraction."""
    links = staged(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    sign = None
    while True:
        both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = staged(small.unionAll(least.select("u", F.col("m").alias("v"))).distinct())
        now = links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == sign:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        sign = now


def _links(rows: DataFrame, idf: np.ndarray) -> DataFrame:
    """(node, root) of all texts that are near-duplicates of another."""
    texts = rows.groupBy("digest").agg(F.first("data").alias("data"))
    signed = staged(signatures(texts, idf))
    facts = signed.select("digest", F.struct("weight", "sketch").alias("x"))
    banded = signed.select(F.explode("keys").alias("key"), "digest")
    shared = banded.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    members = staged(banded.join(shared, "key"))
    # Who shares keys with many is near the middle of its group.
    degree = members.groupBy("digest").agg(F.sum("n").alias("degree"))
    placed = staged(
        members.join(degree, "digest").select(
            "key", "digest", "degree", F.col("digest").alias("root"), F.lit(True).alias("open"), F.lit(False).alias("led")
        )
    )

    def candidates(found: DataFrame, tested: DataFrame | None) -> DataFrame:
        """Pairs (digest, other) that have not been compared and that the sketches do not rule out."""
        found = found.select(F.least("digest", "other").alias("a"), F.greatest("digest", "other").alias("b")).distinct()
        if tested is not None:
            found = found.join(tested, ["a", "b"], "left_anti")
        both = found.join(facts.select(F.col("digest").alias("b"), "x"), "b")
        both = both.join(facts.select(F.col("digest").alias("a"), F.col("x").alias("y")), "a")
        return staged(both.filter(similar_sketch(F.col("x"), F.col("y"))).select("a", "b"))

    tested = links = None
    for _ in range(STARS):
        lead = F.max(F.struct("degree", "digest", "root")).alias("lead")
        leads = placed.filter("open").groupBy("key").agg(lead)
        led = placed.join(leads, "key").filter(F.col("root") != F.col("lead.root"))
        pairs = candidates(led.select("digest", F.col("lead.digest").alias("other")), tested)
        added = staged(verified(pairs, rows, idf).select("a", "b"))
        tested, links = (pairs, added) if tested is None else (tested.unionAll(pairs), links.unionAll(added))
        roots = components(links)
        # Texts in the component of their key's lead are done there; the next lead is another's.
        own = roots.select(F.col("node").alias("digest"), F.col("root").alias("own"))
        lead_roots = roots.select(F.col("node").alias("lead_digest"), F.col("root").alias("lead_own"))
        leads = leads.select("key", F.col("lead.digest").alias("lead_digest")).join(lead_roots, "lead_digest", "left")
        leads = leads.select("key", "lead_digest", F.coalesce("lead_own", "lead_digest").alias("lead_root"))
        moved = placed.join(own, "digest", "left").withColumn("root", F.coalesce("own", "digest"))
        moved = moved.join(leads, "key", "left")
        still = F.col("open") & (F.col("root") != F.col("lead_root"))
        led = F.col("led") | F.coalesce(F.col("digest") == F.col("lead_digest"), F.lit(False))
        placed = staged(
            moved.select("key", "digest", "degree", "root", F.coalesce(still, F.lit(False)).alias("open"), led.alias("led"))
        )
    # Of two components of a key at least one is not its largest: from there texts meet the whole key,
    # by a finer sketch. Leads have met it.
    sizes = placed.groupBy("key", "root").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("key").agg(F.max(F.struct("n", "root")).alias("most"), F.count("*").alias("parts"))
    largest = largest.filter("parts > 1").select("key", F.col("most.root").alias("spared"))
    open_now = (F.col("root") != F.col("spared")) & ~F.col("led")
    parted = staged(placed.join(largest, "key").select("key", "digest", "root", open_now.alias("open")))
    in_key = staged(parted.join(parted.filter("open").select("key").distinct(), "key", "left_semi"))
    texts = texts_of(staged(in_key.select("digest").distinct()), rows)
    fine = signatures(texts, idf, FINE_SAMPLES, FINE_PLANES)
    fine = staged(fine.select("digest", F.struct("weight", "sketch").alias("x")))
    large = in_key.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > SHARP_FROM).select("key")
    texts = texts_of(staged(in_key.join(large, "key", "left_semi").select("digest").distinct()), rows)
    sharp = staged(signatures(texts, idf, SHARP_SAMPLES, SHARP_PLANES).select("digest", F.col("sketch").alias("sharp")))
    every = staged(in_key.join(fine, "digest").join(sharp, "digest", "left"))
    opened = every.filter("open").select("key", F.struct("digest", "root", "x", "sharp").alias("o"))
    rest = opened.join(
        every,
        (opened["key"] == every["key"])
        & (F.col("root") != F.col("o.root"))
        & (~F.col("open") | (F.col("digest") < F.col("o.digest")))
        & similar_sketch(F.col("x"), F.col("o.x"), fine=True)
        & similar_sharp(F.col("sharp"), F.col("o.sharp")),
    )
    # Written where they meet: a shuffle from here would leave files for each two parts of a key, most without a row.
    met = rest.select(F.least("digest", "o.digest").alias("a"), F.greatest("digest", "o.digest").alias("b"))
    met = staged(met, **{"spark.sql.adaptive.autoBroadcastJoinThreshold": OPEN_BYTES})
    rest = staged(met.distinct().join(tested, ["a", "b"], "left_anti"))
    return components(links.unionAll(verified(rest, rows, idf).select("a", "b")))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, digest of its text, class and size of the class in rows.

    ``class_id`` is the least key of all rows that are linked by equal or similar texts;
    ``class_digest`` names the class as well where keys are missing.
    """
    rows = docs.select(
        F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("data")
    ).withColumn("digest", F.unhex(F.md5("data")))
    roots = _links(rows, word_idf(rows))
    placed = (
        rows.select("key", "digest")
        .join(roots.select(F.col("node").alias("digest"), "root"), "digest", "left")
        .select("key", "digest", F.coalesce("root", "digest").alias("class_digest"))
    )
    classes = placed.groupBy("class_digest").agg(F.min("key").alias("class_id"), F.count("*").alias("class_size"))
    return placed.join(classes, "class_digest").select(
        F.col("key").alias(key), "digest", "class_digest", "class_id", "class_size"
    )
