"""Exact rounding of ratios.

Published rates have one or two decimals, and a rate on the boundary decides a traffic
light. Dividing doubles (or decimals, whose quotient is itself rounded) and rounding
afterwards can land on the wrong side, so ratios are rounded with integer arithmetic.
The builders return SQL text: gold views are stored as SQL, and `F.expr` turns the same
text into a Column.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio_sql(num: str, den: str, scale: int, factor: int = 1) -> str:
    """ROUND(factor * num / den, scale), half away from zero; NULL when den is 0 or NULL."""
    unit = factor * 10**scale
    size = f"((abs({num}) * {2 * unit} + abs({den})) div nullif(2 * abs({den}), 0))"
    signed = f"(case when (({num}) < 0) <> (({den}) < 0) then -{size} else {size} end)"
    if scale == 0:
        return f"cast({signed} as bigint)"
    return f"cast({signed} * {'0.' + '0' * (scale - 1) + '1'} as decimal(18,{scale}))"


def percent_sql(num: str, den: str, scale: int) -> str:
    return ratio_sql(num, den, scale, factor=100)


def ratio(num: str, den: str, scale: int) -> Column:
    return F.expr(ratio_sql(num, den, scale))


def percent(num: str, den: str, scale: int) -> Column:
    return F.expr(percent_sql(num, den, scale))


def tenths_sql(rate: str) -> str:
    """A one-decimal rate as an integer number of tenths."""
    return f"cast({rate} * 10 as bigint)"


def stddev_tenths_sql(n: str, total: str, squares: str) -> str:
    """Sample deviation of one-decimal values, rounded to one decimal.

    Takes the count, sum and sum of squares of the values in tenths, all integers, so the
    result does not depend on the order in which partitions are merged. One value gives 0,
    none gives NULL.
    """
    spread = f"(cast({n} as decimal(19,0)) * {squares} - cast({total} as decimal(19,0)) * {total})"
    deviation = (
        f"floor(sqrt(cast({spread} as double) / (cast({n} as double) * ({n} - 1))) + 0.5D)"
    )
    return (
        f"case when {n} = 0 then cast(null as decimal(18,1)) when {n} = 1 then cast(0 as decimal(18,1)) "
        f"else cast(cast({deviation} as bigint) * 0.1 as decimal(18,1)) end"
    )
