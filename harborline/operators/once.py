"""Evaluating an expensive expression exactly once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that later filters and projections refer to by value.

    The optimizer moves filters below a projection by copying its expressions,
    so a document that is parsed in a projection would be parsed again for
    every filter and attribute derived from it. A generator over a one-element
    array is a boundary it does not cross.
    """
    made = F.struct(*[value.alias(name) for name, value in columns.items()])
    kept = [c for c in df.columns if c not in columns]
    generated = df.select(*kept, F.explode_outer(F.array(made)).alias("_once"))
    return generated.select(*kept, *[F.col(f"_once.{name}").alias(name) for name in columns])
