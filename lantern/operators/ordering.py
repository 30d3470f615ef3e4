"""Order and pages: the offset is taken before the limit, and a limit of 0 gives no rows."""

from __future__ import annotations

from pyspark.sql import DataFrame


def sort_page(df: DataFrame, order, limit: int | None = None, offset: int | None = None) -> DataFrame:
    """With a limit this is a top-k: each task keeps offset + limit rows."""
    out = df.orderBy(*order) if order else df
    out = out.offset(offset) if offset else out
    return out if limit is None else out.limit(limit)
