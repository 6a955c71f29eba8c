"""Registry of the example queries and of the SQL that gives the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import prepare
from .frames import FRAMES, add_shapes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
_NAME = re.compile(r"\{(\w+)\}")


class Tables:
    """Domain frames of one data folder, built on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = prepare(spark), folder
        self._built: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._built:
            self._built[name] = self._build(name)
        return self._built[name]

    def _build(self, name: str) -> DataFrame:
        if name not in FRAMES:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        text = FRAMES[name]
        needed = {n: getattr(self, n) for n in set(_NAME.findall(text))}
        return add_shapes(name, self.spark.sql(text, **needed))


def _ordered(names: list[str], seen: list[str]) -> list[str]:
    for name in names:
        if name in FRAMES and name not in seen:
            _ordered(sorted(set(_NAME.findall(FRAMES[name]))), seen)
            seen.append(name)
    return seen


def oracle_text(sql: str) -> str:
    """SQL with the domain frames it names put in front."""
    used = _ordered(sorted(set(_NAME.findall(sql))), [])
    plain = lambda text: _NAME.sub(r"\1", text).strip()
    frames = [f"{name} AS ({plain(FRAMES[name])})" for name in used]
    body = plain(sql)
    if not frames:
        return body
    if body.upper().startswith("WITH RECURSIVE "):
        return "WITH RECURSIVE " + ", ".join(frames) + ", " + body[len("WITH RECURSIVE "):]
    if body.upper().startswith("WITH "):
        return "WITH " + ", ".join(frames) + ", " + body[len("WITH "):]
    return "WITH " + ", ".join(frames) + " " + body


def query(name: str, oracle: str | None = None):
    """Register a function of `Tables` under a name, with the SQL that must agree."""
    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"two queries named {name}")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if oracle:
            ORACLES[name] = oracle_text(oracle)
        return fn
    return register
