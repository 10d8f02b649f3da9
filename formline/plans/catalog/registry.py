"""Where queries and their SQL are collected."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from formline.plans.star import CTES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def with_ctes(body: str, extra: dict[str, str] | None = None) -> str:
    """The statement with the shared definitions it uses, directly or through each other."""
    known = {**CTES, **(extra or {})}
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, definition in known.items():
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                visit(definition)
                needed.append(name)

    visit(body)
    heads = ",\n".join(f"{n} AS ({known[n]})" for n in needed)
    return f"WITH {heads}\n{body}" if heads else body


def query(name: str, sql: str | None = None, extra: dict[str, str] | None = None):
    """Register a query under its inventory name."""

    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = with_ctes(sql, extra)
        return function

    return add
