"""Set operations, by position of columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_all(*dfs: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionAll, dfs)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    return union_all(*dfs).distinct()


def intersect(left: DataFrame, right: DataFrame, every: bool = False) -> DataFrame:
    return left.intersectAll(right) if every else left.intersect(right)


def except_(left: DataFrame, right: DataFrame, every: bool = False) -> DataFrame:
    return left.exceptAll(right) if every else left.subtract(right)
