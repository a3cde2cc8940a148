"""Aggregation helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def exact_sum(c: str, scale: int = 2) -> Column:
    """Sum of a fixed-decimal measure, exact (decimal) then back to double."""
    return F.sum(F.col(c).cast(f"decimal(38,{scale})")).cast("double")


def exact_mean(c: str, scale: int = 2) -> Column:
    """Mean as exact sum / count (the same division in every engine)."""
    return exact_sum(c, scale) / F.count(F.col(c))


def mean(c: str) -> Column:
    """Mean as sum / count of a double column."""
    return F.sum(F.col(c)) / F.count(F.col(c))


def first_by(value: str, order: str = "Date") -> Column:
    """Deterministic 'first' value: the one on the earliest ``order``, ties by
    value. ``min`` over a struct is a partial (map-side) aggregate."""
    return F.min(F.when(F.col(value).isNotNull(),
                        F.struct(F.col(order).alias("o"), F.col(value).alias("v"))))["v"]


def one_row(df: DataFrame) -> DataFrame:
    """Mark a global aggregate as a one-row side (safe to broadcast)."""
    return F.broadcast(df)
