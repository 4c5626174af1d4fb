"""Aggregate expressions shared by the marts and the messaging reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def share_pct(condition: Column) -> Column:
    """Percentage of rows that satisfy a condition, two decimals."""
    return F.round(F.try_divide(F.count_if(condition) * F.lit(100.0), F.count(F.lit(1))), 2)


def sum_if(value: Column, condition: Column) -> Column:
    return F.sum(F.when(condition, value))


def count_distinct_if(value: Column, condition: Column) -> Column:
    return F.count_distinct(F.when(condition, value))


def count_or_status(value: Column, status: Column, expected: str) -> Column:
    """Count of filled values, or of a status word when there is none."""
    filled = F.count(value)
    return F.when(filled > 0, filled).otherwise(F.count_if(status == expected))


def joined_distinct(df: DataFrame, keys: list[str], value: str, name: str, separator: str = ",") -> DataFrame:
    """Sorted distinct values per key in one text; repeats fold before collecting."""
    once = df.where(F.col(value).isNotNull()).select(*keys, value).distinct()
    return once.groupBy(*keys).agg(
        F.array_join(F.array_sort(F.collect_list(value)), separator).alias(name)
    )


def recent_or_all(df: DataFrame, recent: Column) -> DataFrame:
    """The recent rows, or every row when nothing is recent.

    A probe decides first: it reads with the condition pushed down and stops at
    the first row. The plan is then one of two, and in the usual one the
    condition reaches the scan.
    """
    found = df.where(recent)
    return df if found.isEmpty() else found


def high_water_mark(audit: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Last processed position per unit."""
    return audit.groupBy(*keys).agg(F.coalesce(F.max(column), F.lit(0)).alias(column))


def verdict_counts(df: DataFrame, column: str, verdicts: list[str]) -> DataFrame:
    """One row with a count per expected verdict."""
    return df.agg(*[F.count_if(F.col(column) == v).alias(f"{v}_count") for v in verdicts])
