"""Hospital and period keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_WIDTH = 7


def text_or_null(value: Column) -> Column:
    """Empty text is no value."""
    return F.nullif(value, F.lit(""))


def pad_key(code: Column) -> Column:
    """Zero-padded hospital key; longer codes are cut at the key width."""
    return F.lpad(text_or_null(code), KEY_WIDTH, "0")


def leading_code(label: Column) -> Column:
    """The digits a label starts with, NULL when it starts with something else."""
    return F.regexp_substr(label, F.lit(r"^\d+"))


def name_after_code(label: Column) -> Column:
    return text_or_null(F.trim(F.regexp_replace(label, r"^\d+\s*", "")))


def starts_with_digit(label: Column) -> Column:
    return label.rlike(r"^\d")


def period_key(year: Column, month: Column) -> Column:
    """YYYYMM text. A missing part counts as empty text, as in the source's concatenation."""
    return text_or_null(F.concat_ws("", year, month))


def days_in_period(period: str) -> str:
    """SQL text: number of days in a YYYYMM period."""
    return f"dayofmonth(last_day(to_date({period}, 'yyyyMM')))"


def category(code: Column) -> Column:
    """Three-character disease category of a diagnosis code."""
    return F.substring(code, 1, 3)
