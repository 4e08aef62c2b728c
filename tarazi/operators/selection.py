"""Filters that are put together from parameters, pages and ranked extracts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filtered(rows: DataFrame, **wanted) -> DataFrame:
    """Rows that meet every condition given; one that is None asks nothing.

    A list is any of its values, a tuple of two its bounds (each may be None), all else equality.
    Null values meet no condition.
    """
    conditions: list[Column] = []
    for column, value in wanted.items():
        if isinstance(value, list):
            conditions.append(F.col(column).isin(value))
        elif isinstance(value, tuple):
            low, high = value
            conditions += [F.col(column) >= F.lit(low)] * (low is not None) + [F.col(column) <= F.lit(high)] * (high is not None)
        elif value is not None:
            conditions.append(F.col(column) == F.lit(value))
    return rows.where(reduce(lambda a, b: a & b, conditions)) if conditions else rows


def page(rows: DataFrame, order: list[Column], offset: int, size: int) -> DataFrame:
    """A page of the rows in an order, each with the total number of rows; the total is counted without a second pass over the page."""
    total = rows.agg(F.count(F.lit(1))).scalar()
    return rows.orderBy(*order).offset(offset).limit(size).withColumn("total", total)


def premium_bp(value: Column, base: Column) -> Column:
    """How far a value is above a base, in hundredths of a per cent, rounded half to even; null for a base of zero."""
    return F.bround((value - base) * 10000.0 / F.nullif(base, F.lit(0)), 0).cast("long")


def gap_bp(value: Column, base: Column) -> Column:
    """How far a value is below a base, in whole hundredths of a per cent of the base; null for a base of zero."""
    return F.floor((base - value) * 10000.0 / F.nullif(base, F.lit(0)))


def gtin13(number: Column) -> Column:
    """A 13-digit code of a number of up to twelve digits, with its check digit."""
    body = F.lpad(number.cast("string"), 12, "0")
    digits = F.transform(F.sequence(F.lit(1), F.lit(12)), lambda i: body.substr(i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 3).otherwise(1))
    return F.concat(body, ((10 - F.reduce(digits, F.lit(0), lambda a, x: a + x) % 10) % 10).cast("string"))
