"""Expressions over device-metric batches."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def metric_position(columns: Column, name: str) -> Column:
    """Zero-based position of the first column of that name, -1 if there is none."""
    return F.array_position(columns, name) - 1


def metric_value(columns: Column, row: Column, name: str, kind: str = "int") -> Column:
    """Value of a named column in a positional row; 0 if absent, short or not a number."""
    text = F.get(row, metric_position(columns, name).cast("int"))
    # Whole numbers are the rule; a fraction is cut off.
    number = F.coalesce(text.try_cast(kind), text.try_cast("double").try_cast(kind))
    return F.coalesce(number, F.lit(0).cast(kind))


def percent_diff(a: Column, b: Column) -> Column:
    """Whole percent by which ``a`` differs from ``b``, truncated."""
    a, b = a.cast("bigint"), b.cast("bigint")
    whole = F.call_function("div", F.abs(a - b) * 100, b)
    return F.when(b == 0, F.when(a == 0, F.lit(0)).otherwise(F.lit(100))).otherwise(whole).cast("bigint")
