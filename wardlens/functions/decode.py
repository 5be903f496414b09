"""Domain codes of the admissions source and the occupancy bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardlens.functions.casts import NUMBER, number_or_null

# Fixed values of the admissions layout.
SEX = {"1": "M", "3": "F"}
COMPLEXITY = {"02": "MEDIA", "03": "ALTA"}
ADMISSION = {"01": "ELETIVO", "02": "URGENCIA"}
# Above CRITICAL is red, from ATTENTION on is yellow.
CRITICAL = 85
ATTENTION = 70


def decode(code: Column, labels: dict[str, str], default: str) -> Column:
    chain = F
    for value, label in labels.items():
        chain = chain.when(code == value, label)
    return chain.otherwise(default)


def sex(code: Column) -> Column:
    return decode(code, SEX, "IGN")


def complexity(code: Column) -> Column:
    return decode(code, COMPLEXITY, "OUTRA")


def admission_kind(code: Column) -> Column:
    return decode(code, ADMISSION, "OUTRO")


def death_flag(code: Column) -> Column:
    return F.when(code == "1", 1).otherwise(0)


def age_in_years(unit: Column, age: Column) -> Column:
    """Unit 4 counts years, 3 months (one decimal), 2 days (two decimals); others are unknown.

    The decimal quotients carry seven or more digits, finer than the distance of any
    four-decimal age to a rounding boundary, so rounding them is exact.
    """
    n = number_or_null(age)
    return (
        F.when(unit == "4", n)
        .when(unit == "3", F.round(n / 12, 1).cast(NUMBER))
        .when(unit == "2", F.round(n / 365, 2).cast(NUMBER))
    )


def traffic_light_sql(rate: str) -> str:
    """A missing rate falls through to OK."""
    return (
        f"case when {rate} > {CRITICAL} then 'CRITICO' "
        f"when {rate} >= {ATTENTION} then 'ATENCAO' else 'OK' end"
    )


def traffic_light(rate: str) -> Column:
    return F.expr(traffic_light_sql(rate))
