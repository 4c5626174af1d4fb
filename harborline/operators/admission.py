"""Files wait until their acknowledgement file has arrived."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACK_MARK = "_ack."  # fixed value


def is_ack(name: Column) -> Column:
    return name.contains(ACK_MARK)


def expected_ack(name: Column) -> Column:
    """``sales.csv`` -> ``sales_ack.csv``."""
    return F.regexp_replace(name, r"^(.*?)(\.[^.]*)?$", "$1_ack$2")


def admission(files: DataFrame, group: list[str], name: str = "file_name") -> DataFrame:
    """Data files with ``status`` admitted or held; hidden files are ignored."""
    acks = files.where(is_ack(F.col(name))).select(*group, F.col(name).alias("_ack"), F.lit(True).alias("_seen")).distinct()
    data = files.where(~is_ack(F.col(name)) & ~F.col(name).startswith("."))
    return (
        data.withColumn("_ack", expected_ack(F.col(name)))
        .join(acks, [*group, "_ack"], "left")
        .select(*files.columns, F.when(F.col("_seen"), "admitted").otherwise("held").alias("status"))
    )


def recover(held: DataFrame, files: DataFrame, group: list[str], name: str = "file_name") -> DataFrame:
    """Held files whose acknowledgement has turned up since."""
    acks = files.where(is_ack(F.col(name))).select(*group, F.col(name).alias("_ack")).distinct()
    return (
        held.withColumn("_ack", expected_ack(F.col(name)))
        .join(acks, [*group, "_ack"], "left_semi")
        .drop("_ack")
    )
