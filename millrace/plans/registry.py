"""Registration of named queries next to the SQL that checks them."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.session import Tables

#: In the SQL of a check, EXACT_SUM(x) is the sum of doubles rounded once: scaled to whole numbers, added up as those, and read from their digits.
EXACT_SUM = "(CAST(CAST(sum(CAST(({}) * pow(2, 64) AS HUGEINT)){} AS VARCHAR) AS DOUBLE) / pow(2, 64))"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def spelled_out(sql: str) -> str:
    """SQL with every EXACT_SUM(x) and EXACT_SUM(x) OVER w written in full."""
    while (at := sql.find("EXACT_SUM(")) >= 0:
        start = end = at + len("EXACT_SUM(")
        depth = 1
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        inner, over = sql[start:end - 1], re.match(r"\s*OVER\s*(\w+|\([^)]*\))", sql[end:])
        sql = sql[:at] + EXACT_SUM.format(inner, f" {over[0].strip()}" if over else "") + sql[end + (over.end() if over else 0):]
    return sql


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``, with its DuckDB equivalent."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = spelled_out(sql.strip())
        return fn

    return register
