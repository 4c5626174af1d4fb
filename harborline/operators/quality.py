"""Declarative data tests; each returns its findings as a small DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.functions.dates import CHECKED_LAYOUTS, first_layout


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, failures) for not-null tests, in one scan."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "failures")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).where("occurrences > 1")


def out_of_range(df: DataFrame, column: str, low: float, high: float, allow_null: bool = False) -> DataFrame:
    """Rows whose value lies outside the closed range."""
    outside = ~F.col(column).between(low, high)
    return df.where(F.coalesce(outside, F.lit(not allow_null)))


def orphans(df: DataFrame, parent: DataFrame, key: str, parent_key: str) -> DataFrame:
    """Rows whose foreign key has no parent."""
    return df.where(F.col(key).isNotNull()).join(
        parent.select(F.col(parent_key).alias(key)), key, "left_anti"
    )


def header_check(df: DataFrame, expected: list[str]) -> tuple[list[str], list[str]]:
    """(missing, unexpected) column names."""
    return (
        [c for c in expected if c not in df.columns],
        [c for c in df.columns if c not in expected],
    )


def invalid_datetimes(df: DataFrame, columns: list[str], layouts: list[str] = CHECKED_LAYOUTS) -> DataFrame:
    """Rows with ``problems``: datetime columns that fit no accepted layout."""
    def broken(name: str) -> Column:
        text = F.trim(F.col(name))
        return F.when((text != "") & first_layout(text, layouts).isNull(), F.lit(name))

    found = F.array_compact(F.array(*[broken(c) for c in columns]))
    return df.withColumn("problems", found).where(F.size("problems") > 0)
