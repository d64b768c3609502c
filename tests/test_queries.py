"""Every registered query against its SQL in DuckDB, on the smallest tables."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
import registry
from tests.conftest import FOLDER

QUERIES, ORACLES = registry.QUERIES, registry.ORACLES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return value.isoformat() if isinstance(value, (dt.date, dt.datetime)) else str(value)


def test_entry_has_every_query():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(name, spark, duck):
    df = QUERIES[name](spark, FOLDER)
    relation = duck.sql(ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(relation.columns)
    places = [relation.columns.index(c) for c in columns]
    ours = sorted(tuple(plain(row[c]) for c in columns) for row in df.collect())
    theirs = sorted(tuple(plain(row[i]) for i in places) for row in relation.fetchall())
    assert ours == theirs


def test_entry_is_stable(spark):
    df = entry.entry(spark)
    assert "forecast" in df.columns and df.count() > 0


def test_queries_load_without_the_text_libraries():
    """The text subpackage needs libraries that the other queries do not."""
    code = "import sys; sys.modules['public_tokenizers'] = None; import __spark_entry__ as e; print(len(e.queries()))"
    found = subprocess.run([sys.executable, "-c", code], cwd=os.path.dirname(entry.__file__), capture_output=True, text=True, check=True)
    assert int(found.stdout) == len(QUERIES)
