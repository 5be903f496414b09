"""Text to typed values: tolerant casts give NULL, strict ones fail the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = "decimal(18,4)"
MONEY = "decimal(15,2)"
# Fixed value: up to 13 integer digits, point, two decimals, optional sign.
MONEY_FORMAT = "S999999999990D99"


def number_or_null(text: Column) -> Column:
    return text.try_cast(NUMBER)


def money_or_null(text: Column) -> Column:
    """Amounts with at most two decimals; more decimals are an error, not a rounding."""
    return F.try_to_number(text, F.lit(MONEY_FORMAT)).cast(MONEY)


def date_or_null(text: Column) -> Column:
    return F.try_to_date(text, "yyyyMMdd")


def strict_number(text: Column) -> Column:
    return text.cast(NUMBER)
