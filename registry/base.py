"""Registration of queries and assembly of their comparison SQL."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from milepost.session import tune
from registry.proxies import PROXIES, TABLES

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
STEPS: dict[str, str] = {name: text.replace("{", "").replace("}", "") for name, text in PROXIES.items()}


def steps(**named: str) -> None:
    """Add named SQL steps that later oracle texts may refer to."""
    STEPS.update(named)


def oracle_text(select: str) -> str:
    """``select`` preceded by every named step it needs, directly or not."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"[a-z_0-9]+", text)):
            if word in STEPS and word not in needed:
                visit(STEPS[word])
                if word not in needed:
                    needed.append(word)

    visit(select)
    if not needed:
        return select
    body = ",\n".join(f"{name} AS MATERIALIZED ({STEPS[name]})" for name in needed)
    own = select.strip()
    if own.startswith("WITH "):
        return f"WITH {body},\n{own[5:]}"
    return f"WITH {body}\n{select}"


class Tables:
    """The given tables of one folder and the domain views derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = tune(spark), folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        if name in PROXIES:
            used = set(re.findall(r"\{(\w+)\}", PROXIES[name]))
            return self.spark.sql(PROXIES[name], **{n: getattr(self, n) for n in used})
        raise AttributeError(name)


def query(name: str, oracle: str | None = None):
    """Register a function of ``Tables`` and, unless rows only, its comparison SQL."""

    def register(build):
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if oracle is not None:
            ORACLES[name] = oracle_text(oracle)
        return build

    return register
