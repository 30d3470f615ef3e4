"""Joins. The optimizer picks broadcast, hash or sort-merge from sizes it measures; no hints are given."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame


def equi_join(left: DataFrame, right: DataFrame, pairs, how: str = "inner", sem: str = "ansi") -> DataFrame:
    """pairs: (left column, right column); several are a composite key. Document semantics match nulls."""
    eq = [left[a].eqNullSafe(right[b]) if sem == "document" else left[a] == right[b] for a, b in pairs]
    return left.join(right, reduce(Column.__and__, eq), how)


def chain_join(base: DataFrame, hops, sem: str = "ansi") -> DataFrame:
    """hops: (DataFrame, pairs, how), each joined to all before it."""
    return reduce(lambda df, hop: equi_join(df, hop[0], hop[1], hop[2] if len(hop) > 2 else "inner", sem), hops, base)


def theta_join(left: DataFrame, right: DataFrame, condition: Column, how: str = "inner") -> DataFrame:
    return left.join(right, condition, how)


def cross_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """For small dimension tables only: the result has as many rows as the product."""
    return left.crossJoin(right)
