"""Checks of Python sources by their syntax tree, which SQL can't express: Arrow batches of texts."""

from __future__ import annotations

import ast

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType


def parses(code: str | None) -> bool:
    try:
        ast.parse(code or "")
    except (SyntaxError, ValueError, RecursionError, MemoryError):
        return False
    return bool(code)


def defines(code: str | None, name: str | None) -> bool:
    """Whether a top-level function of that name is defined."""
    if not parses(code):
        return False
    return any(isinstance(n, (ast.FunctionDef, ast.AsyncFunctionDef)) and n.name == name for n in ast.parse(code).body)


@F.pandas_udf(BooleanType())
def syntax_valid(code: pd.Series) -> pd.Series:
    return code.map(parses)


@F.pandas_udf(BooleanType())
def function_name_valid(code: pd.Series, name: pd.Series) -> pd.Series:
    return pd.Series([defines(c, n) for c, n in zip(code, name, strict=True)], dtype=bool)
