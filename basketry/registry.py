"""Registry of named queries: Spark builder + (optional) DuckDB oracle SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .oracle.fixtures import CTES

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}

CATALOG_MODULES = [
    "basketry.catalog.sources",
    "basketry.catalog.scalars",
    "basketry.catalog.scope",
    "basketry.catalog.joins",
    "basketry.catalog.warehouse",
    "basketry.catalog.load",
    "basketry.catalog.quality",
    "basketry.catalog.inputs",
    "basketry.catalog.verify",
    "basketry.catalog.kpi",
    "basketry.catalog.ledger",
    "basketry.catalog.profile",
]


def with_ctes(body: str) -> str:
    body = body.strip()
    local = ""
    if body[:5].upper() == "WITH ":
        local, body = _split_with(body[5:])
    parts = [f"{name} AS (\n{sql}\n)" for name, sql in CTES]
    if local:
        parts.append(local)
    return "WITH " + ",\n".join(parts) + "\n" + body


def _split_with(text: str) -> tuple[str, str]:
    """Split '<ctes> SELECT ...' at the first top-level SELECT after the CTE list."""
    depth = 0
    i = 0
    upper = text.upper()
    while i < len(text):
        ch = text[i]
        if ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
        elif depth == 0 and upper.startswith("SELECT", i) and (i == 0 or not text[i - 1].isalnum()):
            return text[:i].rstrip().rstrip(","), text[i:]
        i += 1
    raise ValueError("no top-level SELECT")


def query(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = with_ctes(oracle)
        return fn
    return deco


def register(name: str, fn: QueryFn, oracle: str | None = None) -> None:
    query(name, oracle)(fn)


_loaded = False


def load_all() -> None:
    global _loaded
    if _loaded:
        return
    for m in CATALOG_MODULES:
        importlib.import_module(m)
    _loaded = True
