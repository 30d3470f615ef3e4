"""Subqueries as joins, never collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def where_in(df: DataFrame, col: str, sub: DataFrame, negated: bool = False) -> DataFrame:
    """`col` among the first column of sub. NOT IN follows SQL: a null in sub leaves no row."""
    values = sub.select(F.col(sub.columns[0]).alias("__in"))
    if not negated:
        return df.join(values, df[col] == F.col("__in"), "left_semi")
    hit = df.join(values.filter("__in is not null"), df[col] == F.col("__in"), "left_anti")
    some_null = values.filter("__in is null").limit(1)
    left = hit.filter(F.col(col).isNotNull())
    # a null on the left is kept only if sub is empty
    empty = where_exists(hit.filter(F.col(col).isNull()), values, negated=True)
    return where_exists(left, some_null, negated=True).unionAll(empty)


def where_exists(df: DataFrame, sub: DataFrame, negated: bool = False) -> DataFrame:
    """All of df, or nothing: one row of sub at most is looked at."""
    one = sub.limit(1).select(F.lit(1).alias("__one"))
    return df.join(one, F.lit(True), "left_anti" if negated else "left_semi")


def where_exists_on(df: DataFrame, sub: DataFrame, pairs, negated: bool = False) -> DataFrame:
    """Correlated by equal columns."""
    on = [df[a] == sub[b] for a, b in pairs]
    return df.join(sub, on, "left_anti" if negated else "left_semi")
