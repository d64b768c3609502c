"""The Merkle manifest against trees built level by level in plain Python."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from milepost.llm import merkle

FIELDS = ["doc_id", "source", "text"]
# Names that the operator uses itself.
SCHEMA = "doc_id long, source string, text string, pos string, tree string, path string, root string, key string, digest string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes):
    """Root and, per node, the (left, right) siblings a level."""
    paths, own = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, at in enumerate(own):
            run = nodes[at // 3 * 3 : at // 3 * 3 + 3]
            paths[k].append(("".join(run[: at % 3]), "".join(run[at % 3 + 1 :])))
        nodes = [sha("".join(nodes[i : i + 3])) for i in range(0, len(nodes), 3)]
        own = [at // 3 for at in own]
    return nodes[0], paths


def by_hand(rows):
    order = lambda v: (v is not None, str(v).encode() if isinstance(v, str) else v or 0)
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=order)
    subs = {}
    for name in names:
        own = sorted(groups[name], key=lambda r: (order(r[0]), leaf(r)))
        subs[name] = (own, *tree([leaf(r) for r in own]))
    root, top = tree([subs[name][1] for name in names])
    out = []
    for name, rest in zip(names, top, strict=True):
        own, sub, paths = subs[name]
        out += [(r[0], name, leaf(r), sub, root, tuple(p + rest)) for r, p in zip(own, paths, strict=True)]
    return out


def run(spark, rows, **more):
    clash = ("a", "b", "c", "d", "e", "f")
    docs = spark.createDataFrame([(*r, *clash) for r in rows], SCHEMA).repartition(7)
    made = merkle.manifest(docs, FIELDS, **more)
    proof = F.transform("path", lambda s: F.struct(merkle.text_of(s["left"]).alias("a"), merkle.text_of(s["right"]).alias("b")))
    made = made.withColumns({"proof": proof, "end": merkle.folded(F.col("leaf"), F.col("path"))}).collect()
    text = lambda x: bytes(x).hex()
    assert all(r.end == r.root for r in made)
    return [
        (r.doc_id, r.source, text(r.leaf), text(r.subroot), text(r.root), tuple((s.a, s.b) for s in r.proof)) for r in made
    ]


@pytest.mark.parametrize("block", [3, 9, merkle.BLOCK])
def test_paths_as_by_hand(spark, block):
    rows = [(i * 7 % 101, "hot", f"text {i}\n") for i in range(101)]
    rows += [(500 + i, f"s{i % 5}", "x" * i) for i in range(23)]
    rows += [(None, "hot", "no key"), (None, "hot", "none"), (900, None, None), (901, None, ""), (902, "é\U0001f600", "z")]
    rows += [(3, "hot", "tie"), (3, "hot", "tie"), (4, "", "long " * 40_000)]
    assert sorted(run(spark, rows, block=block), key=repr) == sorted(by_hand(rows), key=repr)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28])
def test_tree_sizes_around_whole_blocks(spark, n):
    rows = [(i, "one", None) for i in range(n)]
    assert sorted(run(spark, rows, block=9), key=repr) == sorted(by_hand(rows), key=repr)


def test_witnesses_grow_with_appends():
    grown = merkle.Append()
    digests = [hashlib.sha256(bytes([i])).digest() for i in range(11)]
    for digest in digests[:9]:
        grown.leaf(digest)
    assert [len(w) for w in grown.witness] == [2] * 9 and len(grown.open[2]) == 1
    first = list(grown.witness[0])
    for digest in digests[9:]:
        grown.leaf(digest)
    assert grown.witness[0] == first and grown.witness[10] == []
    root, paths = tree([d.hex() for d in digests])
    assert grown.close(merkle.depth_of(11)).hex() == root
    assert [[(a.hex(), b.hex()) for a, b in w] for w in grown.witness] == paths


def test_changes_are_seen_and_empty_tables_pass(spark):
    docs = spark.createDataFrame([(i, "s", f"a\n{i}") for i in range(40)], "doc_id long, source string, text string")
    later = merkle.leaf_of(F.col("doc_id"), F.col("source"), F.when(F.col("doc_id") % 4 == 0, "other").otherwise(F.col("text")))
    rows = merkle.manifest(docs, FIELDS, carry={"later": later}, block=9)
    rows = rows.select("doc_id", (merkle.folded(F.col("later"), F.col("path")) == F.col("root")).alias("ok")).collect()
    assert {r.doc_id for r in rows if not r.ok} == {i for i in range(40) if i % 4 == 0}
    assert merkle.manifest(docs.limit(0), FIELDS).count() == 0
    with pytest.raises(ValueError):
        merkle.manifest(docs, FIELDS, block=10)
