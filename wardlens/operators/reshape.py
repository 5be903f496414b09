"""Wide monthly reports to one row per month."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MONTH_COLUMN = re.compile(r"m_\d{6}")


def month_columns(df: DataFrame) -> list[str]:
    """The month columns a report has, read from its schema."""
    return [c for c in df.columns if MONTH_COLUMN.fullmatch(c)]


def unpivot_months(df: DataFrame, ids: list[str], period: str, value: str) -> DataFrame:
    """One row per filled cell. Empty cells give no row, as in SQL UNPIVOT."""
    long = df.unpivot(ids, month_columns(df), "_coluna", value)
    return long.where(F.col(value).isNotNull()).select(
        *ids, F.substring("_coluna", 3, 6).alias(period), value
    )
