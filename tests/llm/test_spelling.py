"""Spelling variants against comparing every word with every other one."""

from __future__ import annotations

import collections
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from milepost.llm import spelling


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def by_hand(words, ratio=2):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= ratio * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return out


def vocabularies():
    rng = np.random.default_rng(5)
    few = {"".join(rng.choice(list("abc"), rng.integers(4, 8))): int(rng.integers(3, 40)) for _ in range(700)}
    # Runs of equal letters have several places for one change.
    runs = {"a" * i + "b" * j + "a" * k: 3 + i for i in range(6) for j in range(4) for k in range(6)}
    # A hot end and a hot beginning, other alphabets, one very long word, single letters.
    hot = {"".join(rng.choice(list("xyz"), 4)) + "samesamesame": int(rng.integers(3, 9)) for _ in range(200)}
    hot |= {"samesamesame" + "".join(rng.choice(list("xyz"), 5)): 4 for _ in range(200)}
    odd = {"é\U0001f600中a": 9, "é\U0001f600中b": 3, "\U0001f600中a": 2, "x|y|z": 5, "x|yz": 1, "x": 1, "y": 7, "xy": 3}
    long = "".join(rng.choice(list("abcdefgh"), 3000))
    odd |= {long: 10, long[:1500] + "z" + long[1500:]: 4, long[:2999]: 2, "z" + long[1:]: 5}
    return {"few": few, "runs": runs, "hot": hot, "odd": odd, "all": few | runs | hot | odd}


@pytest.mark.parametrize("name", ["few", "runs", "hot", "odd", "all"])
@pytest.mark.parametrize("group_rows", [5, spelling.GROUP_ROWS])
def test_variants_as_by_hand(spark, name, group_rows):
    words = vocabularies()[name]
    rows = spark.createDataFrame(list(words.items()), "word string, n long").repartition(5)
    found = spelling.variants(rows, group_rows=group_rows).collect()
    assert len(found) == len(words)
    assert {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in found} == by_hand(words)


def test_every_pair_is_found_once(spark):
    words = vocabularies()["runs"]
    rows = spark.createDataFrame(list(words.items()), "word string, n long")
    pairs = [(r.word, r.near, r.near_n) for r in spelling.links(rows, group_rows=7).collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(a, b, words[b]) for a in words for b in words if one_edit(a, b)}


def test_index_keeps_both_sets():
    words = ["abcde", "abxde", "abcdx", "abde", "acde", "abcd"]
    letters = np.zeros((len(words), 5), np.uint32)
    for k, w in enumerate(words):
        letters[k, : len(w)] = [ord(c) for c in w]
    index = spelling.Index(letters)
    everything = index.bits(np.ones((1, len(words)), bool))
    replaced, dropped = index.near(np.array([0]), everything)
    sets = [np.unpackbits(x.view(np.uint8), bitorder="little")[: len(words)].nonzero()[0].tolist() for x in (replaced[0], dropped[0])]
    # Sets compare beginnings; the caller keeps words of the query's length, or one letter less.
    assert [k for k in sets[0] if len(words[k]) == 5] == [1, 2] and [k for k in sets[1] if len(words[k]) == 4] == [3, 4, 5]


def test_counts_runs_of_odd_texts(spark):
    texts = [None, "", "123 ... \n", "Straße straße STRASSE straßE", "Ñandú×÷ ñandú", "word " * 50_000, "aWORDb word_word word"]
    rows = [(k, t, "n", "w", "r") for k, t in enumerate(texts)] + [(None, "word", "n", "w", "r")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, n string, word string, run string")
    counts = collections.Counter()
    for _, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            counts["".join(c.lower() if "A" <= c <= "Z" else c for c in run)] += 1
    found = {r.word: r.n for r in spelling.vocabulary(docs, min_letters=4, min_count=1).collect()}
    assert found == {w: n for w, n in counts.items() if len(w) >= 4}
    spoiled = spelling.vocabulary(docs, F.concat("run", F.lit("_"), "key"), min_letters=1, min_count=1)
    assert {"word_", "word_5"} <= {r.word for r in spoiled.collect()}
    assert spelling.variants(spelling.vocabulary(docs.limit(0))).count() == 0
