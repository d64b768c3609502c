"""Seed-and-extend removal against comparing the windows of all documents."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pytest

from milepost.llm import seed_extend

# Names that the operator uses itself.
SCHEMA = "doc_id long, text string, rank string, print string, data string, spans string, anchor string"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def by_hand(rows, window):
    least = {}
    for key, text in rows:
        w = words_of(text)
        for i in range(len(w) - window + 1):
            g = tuple(w[i : i + window])
            order = float("inf") if key is None else key
            least[g] = min(least.get(g, float("inf")), order)
    out = []
    for key, text in rows:
        w = words_of(text)
        gone = set()
        for i in range(len(w) - window + 1):
            if least[tuple(w[i : i + window])] < (float("inf") if key is None else key):
                gone |= set(range(i, i + window))
        out.append((key, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=repr)


def run(spark, rows, **more):
    docs = spark.createDataFrame([(k, t, "r", "p", "d", "s", "a") for k, t in rows], SCHEMA).repartition(5)
    found = seed_extend.remove_repeats(docs, **more).collect()
    for r in found:
        assert sum(s.end - s.first for s in r.repeats) == r.n_removed
        assert all(a.end < b.first for a, b in zip(r.repeats, r.repeats[1:], strict=False))  # maximal
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in found), key=repr)


def corpus(seed, letters=6, passages=8, n=70):
    """Texts of few different words with shared passages, near copies, copies and odd rows."""
    rng = np.random.default_rng(seed)
    some = lambda k: [str(x) for x in rng.choice([f"w{i}" for i in range(letters)], k)]
    shared = [some(int(rng.integers(4, 25))) for _ in range(passages)]
    rows = []
    for key in rng.permutation(n).tolist():
        w = some(int(rng.integers(0, 20)))
        for k in rng.integers(0, passages, rng.integers(0, 4)).tolist():
            w += shared[k] + some(int(rng.integers(0, 6)))
        rows.append((key, "\n".join(w) if key % 3 else "  ".join(w) + " \t"))
    near = some(60)
    for key in range(200, 230):
        w = list(near)
        for at in rng.integers(0, 60, 2):
            w[at] = f"new{key}"
        rows.append((key, " ".join(w)))
    rows += [(300 + k, rows[3][1]) for k in range(10)] + [rows[5]] * 4
    rows += [(400, " ".join(near)), (400, " ".join(near[::-1])), (None, " ".join(near)), (None, " ".join(near)), (None, "own words")]
    return rows + [(500, None), (501, ""), (502, " \n\t "), (503, "é\U0001f600 \x1c 中 " * 9)]


@pytest.mark.parametrize("group_rows", [3, 25, seed_extend.GROUP_ROWS])
@pytest.mark.parametrize("seed", [1, 3, 8])
def test_removal_as_by_hand(spark, seed, group_rows):
    for letters in (3, 60):
        rows = corpus(letters + seed, letters)
        assert run(spark, rows, window=8, seed=seed, group_rows=group_rows) == by_hand(rows, 8)


def test_default_window_and_long_texts(spark):
    rng = np.random.default_rng(2)
    some = lambda k: [f"w{x}" for x in rng.integers(0, 5000, k)]
    passages = [some(k) for k in (49, 50, 51, 80, 300)]
    long = some(400_000)
    for k, p in enumerate(passages):
        at = 149_990 + 60_000 * k  # the second block of words begins inside the first passage
        long[at : at + len(p)] = p
    repeat = [*long[149_900:150_200], *some(10), *long[:60]]
    rows = [(1, " ".join(long)), (2, " ".join(repeat))]
    rows += [(3 + k, " ".join([*some(20), *p, *some(5), *p])) for k, p in enumerate(passages)]
    rows += [(20, " ".join(["the"] * 200_000)), (21, "the " * 49), (22, "the " * 50), (19, "the " * 60)]
    assert run(spark, rows) == by_hand(rows, 50)


def test_keeps_type_and_empty_tables(spark):
    docs = spark.createDataFrame([(2, "a b c d"), (1, "x a b c")], "doc_id int, text string")
    cut = seed_extend.remove_repeats(docs, window=3, seed=2)
    assert dict(cut.dtypes)["doc_id"] == "int"
    assert {(r.doc_id, r.kept) for r in cut.collect()} == {(2, "d"), (1, "x a b c")}
    assert seed_extend.remove_repeats(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        seed_extend.remove_repeats(docs, window=3, seed=4)


def test_blocks_share_their_words(monkeypatch):
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 30, n)) for n in (0, 1, 30, 500, 3, 90)]
    whole = list(seed_extend._word_blocks(pa.array(texts), 10))
    assert len(whole) == 1 and whole[0][3].sum() == sum(max(0, len(t.split()) - 9) for t in texts)
    monkeypatch.setattr(seed_extend, "PART_WORDS", 37)
    starts, hashes = [], {}
    for h, text, place, own in seed_extend._word_blocks(pa.array(texts), 10):
        starts += [(t, p) for t, p, o in zip(text.tolist(), place.tolist(), own, strict=True) if o]
        hashes |= {(t, p): x for t, p, x in zip(text.tolist(), place.tolist(), h.tolist(), strict=True)}
    h, text, place, own = whole[0]
    assert sorted(starts) == sorted((t, p) for t, p, o in zip(text.tolist(), place.tolist(), own, strict=True) if o)
    assert hashes == {(t, p): x for t, p, x in zip(text.tolist(), place.tolist(), h.tolist(), strict=True)}
