"""Ranking windows, neighbours in a window and aggregates over frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RANKS = {"row_number": F.row_number, "rank": F.rank, "dense_rank": F.dense_rank}


def rank_window(df: DataFrame, fn: str, order, partition=(), alias: str = "rank") -> DataFrame:
    """df with a rank as bigint. Without a partition all rows meet in one task: for bounded inputs."""
    return df.withColumn(alias, RANKS[fn]().over(Window.partitionBy(*partition).orderBy(*order)).cast("bigint"))


def top_n_per_group(df: DataFrame, keys, order, n: int, alias: str = "rn") -> DataFrame:
    """The filter on the rank lets each task keep n rows of a group before the shuffle."""
    return rank_window(df, "row_number", order, keys, alias).filter(F.col(alias) <= n)


def neighbour(df: DataFrame, col: str, order, partition=(), offset: int = 1, alias: str = "neighbour") -> DataFrame:
    """df with the value of col `offset` rows before (or after, if negative) in the window; null beyond its ends."""
    return df.withColumn(alias, F.lag(col, offset).over(Window.partitionBy(*partition).orderBy(*order)))


def tiles(df: DataFrame, n: int, order, partition=(), alias: str = "tile") -> DataFrame:
    """df with the number, from 1, of the n parts of like size that each row of a window falls into."""
    return df.withColumn(alias, F.ntile(n).over(Window.partitionBy(*partition).orderBy(*order)))


def ranged(df: DataFrame, value, order, below, above, partition=(), alias: str = "ranged") -> DataFrame:
    """df with an aggregate over the rows whose value of the one number `order` lies from `below` under to `above` over
    that of each row; rows with equal values share a frame."""
    return df.withColumn(alias, value.over(Window.partitionBy(*partition).orderBy(order).rangeBetween(-below, above)))


def framed(df: DataFrame, value, order, partition=(), preceding: int | None = None, following: int = 0, alias: str = "framed") -> DataFrame:
    """df with an aggregate over the rows from `preceding` before (None: all) to `following` after each row."""
    start = Window.unboundedPreceding if preceding is None else -preceding
    return df.withColumn(alias, value.over(Window.partitionBy(*partition).orderBy(*order).rowsBetween(start, following)))
