"""Groups of spelling variants: words that differ by one letter, by a bit-sliced position index.

Two words are near if they differ by exactly one inserted, deleted or replaced code point. The
words of a block are the bits of machine words. The index has a bitset over them per (position,
letter): the words with that letter there. A query word runs over its letters once and keeps
three sets side by side, 64 words a step: ``zero``, the words equal so far, ``replaced``, those
equal but for one letter, and ``dropped``, those equal after one letter of the query is left
out; the last reads the index one position to the left. Words near by an insertion are found
from the longer one, and reported for both.

Blocks. A pair with n and n or n - 1 letters is equal outside the half of the n positions that
has the change. So a word goes to four buckets: as one of n and as one of n - 1 letters, once
without its first and once without its last half, by the letters outside that half. A bucket
with more than ``GROUP_ROWS`` words is split: its free positions are halved and its words go to
both halves' buckets, until it is small or has one free position; then its words differ in one
letter at most, so the alphabet bounds it. No bucket is ever cut, and no pair of words is built
that is not near. A pair with several places for its change (``aab``, ``ab``) counts for the
last of them only, so every pair is found once.

Null texts have no words, a null key counts as the empty text. Of equal largest counts the
smallest word in code-point order is the form. Repeated rows count like others. An empty table
gives an empty result. The runs of one text are one array; a text of any length passes as long
as that fits a task. Only key and text are read, so no other column can clash.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.session import staged

RUN = r"[A-Za-zÀ-ÿ]+"
MIN_LETTERS = 5
MIN_COUNT = 3
# Buckets above this number of words are split, smaller ones share an index up to BLOCK_ROWS.
GROUP_ROWS = 4096
BLOCK_ROWS = 512
BLOCK_LETTERS = 16_384


def ascii_lower(text: Column) -> Column:
    """Only A-Z in lower case, other letters as they are."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def vocabulary(
    docs: DataFrame,
    spoil: Column | None = None,
    key: str = "doc_id",
    text: str = "text",
    min_letters: int = MIN_LETTERS,
    min_count: int = MIN_COUNT,
) -> DataFrame:
    """Words of all texts with their number ``n``.

    ``spoil`` is an expression over ``key`` and ``run`` that gives the word counted for a run.
    """
    runs = docs.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"),
        F.explode(F.regexp_extract_all(F.col(text), F.lit(RUN), 0)).alias("run"),
    ).withColumn("run", ascii_lower(F.col("run")))
    words = runs.select((F.col("run") if spoil is None else spoil).alias("word"))
    words = words.filter(F.char_length("word") >= min_letters)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)


class Index:
    """Bitsets over the words of a block, per (position, letter)."""

    def __init__(self, letters: np.ndarray):
        """``letters``: one row a word, code points, 0 after the end."""
        words, length = letters.shape
        self.width = -(-words // 64)
        self.alphabet, codes = np.unique(letters, return_inverse=True)
        self.codes = codes.reshape(words, length)
        present = np.zeros((length, len(self.alphabet), self.width * 64), bool)
        at, place = np.divmod(np.arange(words * length), length)
        present[place, self.codes[at, place], at] = True
        self.sets = np.packbits(present, axis=-1, bitorder="little").view(np.uint64)

    def bits(self, chosen: np.ndarray) -> np.ndarray:
        """Bitsets of rows of booleans over the words."""
        wide = np.zeros((*chosen.shape[:-1], self.width * 64), bool)
        wide[..., : chosen.shape[-1]] = chosen
        return np.packbits(wide, axis=-1, bitorder="little").view(np.uint64)

    def near(self, queries: np.ndarray, zero: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the words in ``zero``: those with one letter replaced, and one of the query's left out.

        ``queries`` are rows of the index whose words fill all positions. Words are compared up to
        their end or the query's; the caller keeps those of the right length.
        """
        replaced, dropped = np.zeros_like(zero), np.zeros_like(zero)
        before = None
        for place, sets in enumerate(self.sets):
            letter = self.codes[queries, place]
            here = sets[letter]
            dropped = (dropped & before[letter] if before is not None else dropped) | zero
            replaced = (replaced & here) | (zero & ~here)
            zero = zero & here
            before = sets
        return replaced, dropped


def _links_of(rows: pa.Table) -> pa.RecordBatch:
    """Near words among rows (free, word, n, bucket) of whole buckets with the same free length."""
    free = rows.column("hi")[0].as_py() - rows.column("lo")[0].as_py()
    words = rows.column("word").to_pylist()
    lows = rows.column("lo").to_numpy()
    letters = np.array([w[a : a + free] for w, a in zip(words, lows.tolist(), strict=True)], f"U{max(1, free)}")
    long = rows.column("long").to_numpy(zero_copy_only=False)
    # A shorter word has one free letter less, also where its fixed end follows.
    letters = letters.view(np.uint32).reshape(len(words), -1).copy()
    letters[~long, free - 1] = 0
    index = Index(letters)
    buckets = rows.column("bucket").combine_chunks().dictionary_encode()
    bucket = (buckets.chunk(0) if isinstance(buckets, pa.ChunkedArray) else buckets).indices.to_numpy()
    members = index.bits(bucket[None, :] == np.arange(bucket.max() + 1)[:, None])
    queries = np.flatnonzero(long)
    replaced, dropped = index.near(queries, members[bucket[queries]])
    kinds = index.bits(long[None, :])[0]
    pairs = []
    for found, ends in ((replaced & kinds, False), (dropped & ~kinds, True)):
        some = np.flatnonzero(found.any(axis=1))
        bits = np.unpackbits(found[some].view(np.uint8), axis=1, bitorder="little")
        query, other = np.nonzero(bits)
        query = queries[some[query]]
        if ends:
            last = np.array([_last_place(words[q], words[o]) for q, o in zip(query, other, strict=True)], np.int64)
            own = last < lows[query] + free
            query, other = query[own], other[own]
            query, other = np.concatenate([query, other]), np.concatenate([other, query])
        pairs.append((query, other))
    query, other = (np.concatenate(x) for x in zip(*pairs, strict=True))
    word, n = rows.column("word"), rows.column("n")
    columns = [word.take(pa.array(query)), word.take(pa.array(other)), n.take(pa.array(other))]
    return pa.RecordBatch.from_arrays([pa.concat_arrays(c.chunks) if c.num_chunks else pa.array([], c.type) for c in columns], ["word", "near", "near_n"])


def _last_place(long: str, short: str) -> int:
    """The last position of the longer word whose letter may be left out: their common beginning."""
    for k, letter in enumerate(short):
        if long[k] != letter:
            return k
    return len(short)


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by free length and bucket, in blocks of whole buckets."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        free = batch.column("hi").to_numpy() - batch.column("lo").to_numpy()
        bucket = batch.column("bucket").dictionary_encode().indices.to_numpy()
        edges = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist(), batch.num_rows]
        start = 0
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            last = held[-1] if held else None
            new = start < a or (
                last is not None and last.column("bucket")[-1].as_py() != batch.column("bucket")[a].as_py()
            )
            ahead = size + b - a
            full = ahead > BLOCK_ROWS or ahead * free[a] > BLOCK_LETTERS
            if new and size and (full or free[a] != (free[a - 1] if a else _free(last))):
                if start < a:
                    held.append(batch.slice(start, a - start))
                yield _links_of(pa.Table.from_batches(held))
                held, start, ahead = [], a, b - a
            size = ahead
        held.append(batch.slice(start))
    if held:
        yield _links_of(pa.Table.from_batches(held))


def _free(batch: pa.RecordBatch) -> int:
    return batch.column("hi")[-1].as_py() - batch.column("lo")[-1].as_py()


def _bucketed(words: DataFrame) -> DataFrame:
    """``words`` with their bucket: family, free positions and the letters outside them."""
    short = F.when(F.col("long"), 0).otherwise(1)
    outside = F.concat(
        F.substring("word", F.lit(1), F.col("lo")),
        F.lit("|"),
        F.substring("word", F.col("hi") + 1 - short, F.col("family")),
    )
    return words.withColumn("bucket", F.concat_ws("|", "family", "lo", "hi", outside))


def _halves(lo: Column, hi: Column) -> Column:
    """Both halves of the free positions, or all where there is one."""
    middle = F.floor((lo + hi) / 2).cast("int")
    return F.array(
        F.struct(lo.alias("lo"), middle.alias("hi")),
        F.struct(middle.alias("lo"), hi.alias("hi")),
    )


def _split(words: DataFrame) -> DataFrame:
    """Rows with free positions to rows with either half of them."""
    parts = words.withColumn("part", F.explode(_halves(F.col("lo"), F.col("hi"))))
    parts = parts.withColumns({"lo": F.col("part.lo"), "hi": F.col("part.hi")}).drop("part")
    return _bucketed(parts.filter("lo < hi"))


def links(words: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """All (word, near, near_n) among ``words`` (word, n), each pair once in both directions."""
    n = F.char_length("word")
    roles = F.array(
        F.struct(n.alias("family"), F.lit(True).alias("long")), F.struct((n + 1).alias("family"), F.lit(False).alias("long"))
    )
    rows = words.select("word", "n", F.explode(roles).alias("role"))
    rows = rows.select("word", "n", "role.family", "role.long", F.lit(0).alias("lo"), F.col("role.family").alias("hi"))
    rows, ready = _split(rows), None
    while True:
        sizes = rows.groupBy("bucket").agg(F.count("*").alias("rows"), F.max(F.col("hi") - F.col("lo")).alias("free"))
        hot = staged(sizes.filter((F.col("rows") > group_rows) & (F.col("free") > 1)).select("bucket"))
        small = hot.isEmpty()
        done = rows if small else rows.join(hot, "bucket", "left_anti")
        ready = done if ready is None else ready.unionByName(done)
        if small:
            break
        rows = _split(rows.join(hot, "bucket", "left_semi").drop("bucket"))
    return (
        ready.withColumn("free", F.col("hi") - F.col("lo"))
        .repartition("bucket")
        .sortWithinPartitions("free", "bucket", "word")
        .select("bucket", "word", "n", "long", "lo", "hi")
        .mapInArrow(_links, "word string, near string, near_n long")
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms`` (word, form): the last word along the forms, by doubling the steps."""
    at = staged(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = staged(at.join(ahead, "root", "left"))
        if step.filter(F.col("next").isNotNull()).isEmpty():
            return at
        at = step.select("word", F.coalesce("next", "root").alias("root"))


def variants(words: DataFrame, ratio: int = 2, group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row per word of ``words`` (word, n): word, form, root, n, n_near, form_n.

    The form is the near word of largest n, if that is at least ``ratio`` times the word's own.
    """
    words = staged(words)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best")
    found = links(words, group_rows).groupBy("word").agg(F.count("*").alias("n_near"), best)
    joined = words.join(found, "word", "left")
    form_n = -F.col("best.less")
    taken = form_n >= ratio * F.col("n")
    joined = staged(
        joined.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(taken, F.col("best.near")).alias("form"),
            F.when(taken, form_n).alias("form_n"),
        )
    )
    last = roots(joined.filter(F.col("form").isNotNull()))
    whole = joined.join(last, "word", "left").withColumn("root", F.coalesce("root", "word"))
    return whole.select("word", "form", "root", "n", "n_near", "form_n")
