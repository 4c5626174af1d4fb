"""Slowly changing dimensions with closed-open validity (type 2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harborline.functions.security import version_key
from harborline.operators.latest import latest_by_key

VERSION_COLUMNS = ["start_date", "end_date", "is_current"]


def new_versions(changes: DataFrame, key: str, surrogate: str, day: str) -> DataFrame:
    """Changed rows as the current versions that start on ``day``."""
    start = F.lit(day).cast("date")
    return changes.select(
        version_key(F.col(key), start).alias(surrogate),
        *changes.columns,
        start.alias("start_date"),
        F.lit(None).cast("date").alias("end_date"),
        F.lit(1).alias("is_current"),
    )


def expired_versions(dim: DataFrame, changes: DataFrame, key: str, day: str) -> DataFrame:
    """Current versions of the changed keys, ended on ``day``.

    Whether the day's changes are broadcast is left to the engine, which
    checks their size first.
    """
    changed = changes.select(key).distinct()
    return (
        dim.where(F.col("is_current") == 1)
        .join(changed, key, "left_semi")
        .withColumn("end_date", F.lit(day).cast("date"))
        .withColumn("is_current", F.lit(0))
        .select(*dim.columns)
    )


def scd2_changes(dim: DataFrame, changes: DataFrame, key: str, surrogate: str, day: str) -> DataFrame:
    """Rows one day adds to an insert-only dimension: new and expired versions."""
    fresh = new_versions(changes, key, surrogate, day).select(*dim.columns)
    return fresh.unionByName(expired_versions(dim, changes, key, day))


def scd2_apply(dim: DataFrame, changes: DataFrame, key: str, surrogate: str, day: str) -> DataFrame:
    """The dimension after one day of changes, each version once.

    One pass over the dimension: a left join tells which current versions end
    today, and the new versions are appended. Repeating a day that has already
    been applied changes nothing: versions that start on ``day`` are not ended
    by it, and a new version replaces none that exists.
    """
    start = F.lit(day).cast("date")
    changed = changes.select(key).distinct().withColumn("_changed", F.lit(True))
    ends_now = F.col("_changed") & (F.col("is_current") == 1) & (F.col("start_date") < start)
    ends_now = F.coalesce(ends_now, F.lit(False))
    kept = (
        dim.join(changed, key, "left")
        .withColumn("end_date", F.when(ends_now, start).otherwise(F.col("end_date")))
        .withColumn("is_current", F.when(ends_now, F.lit(0)).otherwise(F.col("is_current")))
        .select(*dim.columns)
    )
    applied = dim.where(F.col("start_date") == start).select(key)
    fresh = new_versions(changes, key, surrogate, day).join(applied, key, "left_anti")
    return kept.unionByName(fresh.select(*dim.columns))


def collapse_versions(dim: DataFrame, key: str) -> DataFrame:
    """One row per (key, start): the ended copy replaces the open one."""
    return latest_by_key(dim, [key, "start_date"], [-F.col("is_current"), F.coalesce("end_date", F.lit("0001-01-01").cast("date"))])


def history(changes: DataFrame, key: str, surrogate: str, day_column: str) -> DataFrame:
    """Full dimension history from all changes at once.

    ``changes`` holds one row per key and day (fold them first), so the window
    below sees at most one row per key and calendar day.
    """
    order = Window.partitionBy(key).orderBy(day_column)
    following = F.lead(day_column).over(order)
    return changes.select(
        version_key(F.col(key), F.col(day_column)).alias(surrogate),
        *[c for c in changes.columns if c != day_column],
        F.col(day_column).alias("start_date"),
        following.alias("end_date"),
        following.isNull().cast("int").alias("is_current"),
    )


def guard_dimension(dim: DataFrame, day: str) -> None:
    """Refuse a day that is not after everything already applied."""
    if not dim.where(F.col("start_date") >= F.lit(day).cast("date")).isEmpty():
        raise ValueError(f"dimension already holds versions from {day} on")


def guard_fact(fact: DataFrame, day: str) -> None:
    """Refuse a day whose facts are already there."""
    if not fact.where(F.col("date_key") == F.lit(day).cast("date")).isEmpty():
        raise ValueError(f"facts of {day} were already written")
