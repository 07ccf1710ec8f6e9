"""Named queries with their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from groundshift.checks.fixtures import sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(check: str | None = None, name: str | None = None):
    """Register a function, with the SQL that must agree with it."""

    def register(fn):
        key = name or fn.__name__
        QUERIES[key] = fn
        if check is not None:
            CHECKS[key] = sql(check)
        return fn

    return register


def r(col, digits: int = 9) -> Column:
    """Rounded for comparison; adding zero turns -0.0 into 0.0."""
    col = F.col(col) if isinstance(col, str) else col
    return F.round(col, digits) + F.lit(0.0)


def rs(cols: list[str], digits: int = 9) -> list[Column]:
    return [r(n, digits).alias(n) for n in cols]


def sql_rs(cols: list[str], digits: int = 9) -> str:
    return ", ".join(f"round({n}, {digits}) + 0.0 as {n}" for n in cols)
