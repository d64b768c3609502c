"""Registered queries: those with SQL against DuckDB, contracts of the others, and the pipeline."""

from __future__ import annotations

import collections
import glob
import hashlib
import os
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from milepost.llm import icws_dedup, quality_cnn, secret_scan, simhash_decontam
from milepost.llm.queries import ORACLES, QUERIES
from milepost.session import staged
from tests.conftest import FOLDER


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_its_sql(name, spark, duck):
    df, relation = QUERIES[name](spark, FOLDER), duck.sql(ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(relation.columns)
    places = [relation.columns.index(c) for c in columns]
    ours = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    assert ours == sorted((tuple(r[i] for i in places) for r in relation.fetchall()), key=repr)


def test_shares_keep_their_law(spark):
    rows = QUERIES["op3_best_fit_shards"](spark, FOLDER).collect()
    load = collections.Counter()
    for row in rows:
        load[row.shard] += row.size
    assert {r.law for r in rows} == {"bytes"} and set(load) <= set(range(40))
    largest = max(r.size for r in rows)
    assert max(load.values()) <= max(largest, 1.3 * sum(load.values()) / 40)


def test_scores_hold_on_unseen_rows(spark, duck):
    rows = {r.doc_id: r for r in QUERIES["op2_quality_cnn"](spark, FOLDER).collect()}
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 3 == 1) for k, r in rows.items())
    labels = duck.sql("SELECT doc_id, quality FROM labels").fetchall()
    good = [rows[k].predicted == y for k, y in labels if rows[k].held_out]
    assert np.mean(good) > 0.8


def test_pipeline_stages_as_by_hand(spark):
    """Each stage against a plain version of its decision on the same input."""
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = docs.columns
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    items = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    net = quality_cnn.train(docs, labels)
    raw = [(texts[k] or "").encode() for k in texts]
    at = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    score = dict(zip(texts, quality_cnn.scores(net, np.frombuffer(b"".join(raw), np.uint8), at), strict=True))
    stages = iter(corpus_pipeline.STAGES)

    def step(before):
        after = staged(next(stages)[1](spark, before, FOLDER))
        return after, {r.doc_id: r for r in after.collect()}

    docs, kept = step(docs)
    assert set(kept) == {k for k, p in score.items() if p >= 0.5} and docs.columns == names
    classes = {r.doc_id: r.class_id for r in icws_dedup.near_duplicates(docs).collect()}
    docs, one = step(docs)
    assert set(one) == {k for k, c in classes.items() if k == c} and docs.columns == names
    docs, clean = step(docs)
    assert not any(item in r.text for r in clean.values() for item in items)
    gone = {r.key for r in simhash_decontam.find(staged(spark.createDataFrame(list(one.values()))), spark.read.parquet(f"{FOLDER}/benchmark.parquet")).collect()}
    assert set(clean) == set(one) - gone and docs.columns == names
    docs, safe = step(docs)
    assert set(safe) == set(clean) and docs.columns == names
    for k, r in safe.items():
        assert r.text == texts[k] or secret_scan.MARK in r.text
        assert 'token = "' + "0" not in r.text and r.n_chars == len(r.text)
    docs, coded = step(docs)
    assert {k: r.decoded_sha256 for k, r in coded.items()} == {
        k: hashlib.sha256(r.text.encode()).hexdigest() for k, r in safe.items()
    }


def test_stages_bear_odd_rows(spark):
    odd = [(None, None, "en", "s", None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, None, None, None, None)]
    odd += [(3, "word " * 30_000, "en", "s", 1), (4, 'so token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" it', "en", "s", 5)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(odd, schema).withColumns({c: F.lit("own") for c in ("key", "digest", "_score", "_row", "x")})
    for name, stage in corpus_pipeline.STAGES:
        for rows in (docs, docs.limit(0)):
            out = stage(spark, rows, FOLDER)
            found = out.collect()
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns and all(r._score == r._row == "own" for r in found)
            assert len(found) <= rows.count()
    left = corpus_pipeline.near_duplicates(spark, docs, FOLDER).collect()
    assert sorted(r.doc_id for r in left) == [1, 3, 4]  # nulls and empty texts are one class
