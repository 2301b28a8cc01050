"""Bucketing and quality-flag expressions for members."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from perkspark.constants import (
    AGE_BUCKETS,
    AGE_MAX_VALID,
    AGE_MIN,
    AGE_TOP_LABEL,
    AGE_UNDER_MIN_LABEL,
    FLAG_INCOMPLETE,
    FLAG_INVALID_AGE,
    FLAG_INVALID_INCOME,
    FLAG_VALID,
    INCOME_BUCKETS,
    INCOME_TOP_LABEL,
)


def _ladder(value: Column, buckets, top_label: str) -> Column:
    """First bucket whose exclusive upper bound exceeds ``value``; null stays null."""
    expr = F.when(value.isNull(), F.lit(None).cast("string"))
    for bound, label in buckets:
        expr = expr.when(value < bound, label)
    return expr.otherwise(top_label)


def age_group(age: Column) -> Column:
    return _ladder(age, ((AGE_MIN, AGE_UNDER_MIN_LABEL),) + AGE_BUCKETS, AGE_TOP_LABEL)


def income_bracket(income: Column) -> Column:
    return _ladder(income, INCOME_BUCKETS, INCOME_TOP_LABEL)


def quality_flag(age: Column, income: Column, gender: Column) -> Column:
    """Exclusive flag, first match wins: missing data before invalid values."""
    return (
        F.when(age.isNull() | income.isNull() | gender.isNull(), FLAG_INCOMPLETE)
        .when((age < AGE_MIN) | (age > AGE_MAX_VALID), FLAG_INVALID_AGE)
        .when(income < 0, FLAG_INVALID_INCOME)
        .otherwise(FLAG_VALID)
    )
