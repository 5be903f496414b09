"""Latest-period filters and ordered limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def at_latest(
    df: DataFrame, period: str = "competencia", of: DataFrame | None = None
) -> DataFrame:
    """Rows of the newest period (of another DataFrame, if given).

    An uncorrelated scalar subquery: on a table partitioned by period it becomes a partition
    filter and the MAX reads no data columns.
    """
    newest = (df if of is None else of).agg(F.max(period)).scalar()
    return df.where(F.col(period) == newest)


def highest_first(name: str) -> Column:
    """Descending order with missing values on top, where the source's database puts them."""
    return F.desc_nulls_first(name)


def first_rows(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """ORDER BY ... FETCH FIRST n: a per-partition top-n merged on one task of n rows each."""
    return df.orderBy(*order).limit(n)
