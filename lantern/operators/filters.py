"""Predicates. sem: "ansi" (null compares as unknown) or "document" (null equals null, and differs from values)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def compare(col, op: str, value, sem: str = "ansi") -> Column:
    c, v = _col(col), value if isinstance(value, Column) else F.lit(value)
    if op == "=":
        return c.eqNullSafe(v) if sem == "document" else c == v
    if op in ("<>", "!="):
        return ~c.eqNullSafe(v) if sem == "document" else c != v
    return {">": c > v, ">=": c >= v, "<": c < v, "<=": c <= v}[op]


def between(col, lo, hi) -> Column:
    return _col(col).between(lo, hi)


def in_list(col, values) -> Column:
    return _col(col).isin(list(values))


def like(col, pattern: str) -> Column:
    return _col(col).like(pattern)


def ilike(col, pattern: str) -> Column:
    return _col(col).ilike(pattern)


def regex(col, pattern: str) -> Column:
    """Unanchored search; a pattern may stand between slashes."""
    inner = pattern[1:-1] if len(pattern) > 1 and pattern[0] == pattern[-1] == "/" else pattern
    return _col(col).rlike(inner)


def all_of(*preds: Column) -> Column:
    return reduce(Column.__and__, preds, F.lit(True))


def any_of(*preds: Column) -> Column:
    return reduce(Column.__or__, preds, F.lit(False))


def negate(pred: Column) -> Column:
    return ~pred


def is_null(col, yes: bool = True) -> Column:
    return _col(col).isNull() if yes else _col(col).isNotNull()
