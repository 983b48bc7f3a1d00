"""Queries over the test tables, each with its SQL oracle where SQL can express it."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmill.sources.views import ORACLE_VIEWS

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: Named building blocks of oracle SQL; a query pulls in those it mentions.
BLOCKS: dict[str, str] = dict(ORACLE_VIEWS)


def block(name: str, text: str) -> None:
    BLOCKS[name] = text


def _mentioned(text: str, own: str = "") -> list[str]:
    return [b for b in BLOCKS if b != own and re.search(rf"(?:FROM|JOIN)\s+{b}\b", text)]


def expand(body: str) -> str:
    """Prefix ``body`` with the building blocks it needs, in dependency order."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for other in _mentioned(BLOCKS[name], name):
            visit(other)
        order.append(name)

    for name in _mentioned(body):
        visit(name)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({BLOCKS[n]})" for n in order) + "\n" + body


def rounded_sql(body: str, cols: str, digits: int = 4) -> str:
    """``body`` with the listed columns rounded (and negative zero removed)."""
    parts = ", ".join(f"round({c}, {digits}) + 0e0 AS {c}" for c in cols.split())
    return f"SELECT * REPLACE ({parts}) FROM (\n{body})"


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every double column, so that the last bits of two engines' sums do not matter."""
    return df.withColumns({
        f.name: F.round(f.name, digits) + F.lit(0.0) for f in df.schema if isinstance(f.dataType, T.DoubleType)
    })


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def oracles() -> dict[str, str]:
    return {n: expand(t) for n, t in ORACLES.items()}
