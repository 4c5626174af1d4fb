"""Lookup joins that survive missing and very frequent keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(
    left: DataFrame, right: DataFrame, on: list[str], spread_by: list[str], slices: int = 64
) -> DataFrame:
    """Left join in which rows without a key are spread over all tasks.

    A null key matches nothing, yet all nulls would hash to one partition. They
    get a slice number as additional key part; the lookup side has slice 0, as
    have all rows with a key.
    """
    missing = F.lit(False)
    for key in on:
        missing = missing | F.col(key).isNull()
    slice_no = F.when(missing, F.pmod(F.xxhash64(*spread_by), F.lit(slices)).cast("int")).otherwise(0)
    return (
        left.withColumn("_slice", slice_no)
        .join(right.withColumn("_slice", F.lit(0)), [*on, "_slice"], "left")
        .drop("_slice")
    )


def frequent_keys(df: DataFrame, on: list[str], share: float) -> DataFrame:
    """Keys that own more than ``share`` of all rows: at most 1/share of them."""
    counts = df.groupBy(*on).count()
    total = counts.agg(F.sum("count").alias("n"))
    return counts.where(F.col("count") > total.scalar() * share).select(*on)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    spread_by: list[str],
    how: str = "inner",
    share: float = 0.01,
    salts: int = 32,
) -> DataFrame:
    """Inner or left equi-join in which only the frequent left keys are salted.

    Rows with a null in a key match nothing: an inner join leaves them out
    first, in a left join they are spread over salts of their own.
    The list of frequent keys has at most ``1/share`` entries by construction,
    which is what makes broadcasting it safe. Their right rows are repeated per
    salt; all other right rows are sent once.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins")
    missing = F.lit(False)
    for key in on:
        missing = missing | F.col(key).isNull()
    if how == "inner":
        left = left.where(~missing)
    right = right.where(~missing)
    frequent = F.broadcast(frequent_keys(left.where(~missing), on, share).withColumn("_hot", F.lit(True)))
    slot = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    salt = F.when(missing, -1 - slot).when(F.col("_hot"), slot).otherwise(0)
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted_left = left.join(frequent, on, "left").withColumn("_salt", salt).drop("_hot")
    salted_right = right.join(frequent, on, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return salted_left.join(salted_right, [*on, "_salt"], how).drop("_salt")
