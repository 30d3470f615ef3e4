"""Aggregation. All functions have partial forms, so each task sends a row for each of its groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def aggregate(fn: str, col=None, sem: str = "ansi") -> Column:
    """count, count_distinct, sum, avg, min, max, first; count without a column counts rows.

    Document semantics: count of a column counts rows, the sum of nothing is 0.
    """
    if fn == "count":
        return F.count(F.lit(1)) if col is None or sem == "document" else F.count(col)
    if fn == "sum":
        return F.coalesce(F.sum(col), F.lit(0)) if sem == "document" else F.sum(col)
    return {"count_distinct": F.countDistinct, "avg": F.avg, "min": F.min, "max": F.max, "first": F.any_value}[fn](col)


def _named(aggs: dict, sem: str) -> list[Column]:
    return [(a if isinstance(a, Column) else aggregate(*a, sem=sem)).alias(name) for name, a in aggs.items()]


def group_agg(df: DataFrame, keys, aggs: dict, having: Column | None = None, sem: str = "ansi") -> DataFrame:
    """aggs: name -> (function, column) or a Column; having may use keys and names."""
    out = df.groupBy(*keys).agg(*_named(aggs, sem))
    return out if having is None else out.filter(having)


def global_agg(df: DataFrame, aggs: dict, sem: str = "ansi") -> DataFrame:
    """One row; in document semantics none if the input is empty."""
    if sem == "document":
        return df.agg(*_named(aggs, sem), F.count(F.lit(1)).alias("__n")).filter("__n > 0").drop("__n")
    return df.agg(*_named(aggs, sem))


def sum_case(whens, default=0) -> Column:
    """Conditional sum: whens are (predicate, value), the first that holds counts."""
    case = F
    for pred, val in whens:
        case = case.when(pred, val)
    return F.sum(case.otherwise(default))
