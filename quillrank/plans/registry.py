"""The library's queries by name, each with SQL for comparison where SQL can say it."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillrank.sources.adapters import VIEWS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: Named parts of the oracles: the domain tables, and what several oracles build on.
PARTS: dict[str, str] = {name: sql.format(**{source: source}) for name, (sql, source) in VIEWS.items()}


def part(name: str, sql: str) -> None:
    PARTS[name] = sql


def oracle(sql: str) -> str:
    """sql with the parts that it names, and those that they name, before it."""
    needed: list[str] = []

    def need(text: str) -> None:
        for name in PARTS:
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                need(PARTS[name])
                if name not in needed:
                    needed.append(name)

    need(sql)
    parts = ", ".join(f"{n} AS ({PARTS[n]})" for n in needed)
    own = re.match(r"\s*WITH (RECURSIVE )?(.*)", sql, re.DOTALL)
    if not parts:
        return sql
    return f"WITH {own[1] or ''}{parts}, {own[2]}" if own else f"WITH {parts} {sql}"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLES[name] = oracle(sql)
        return f

    return add
