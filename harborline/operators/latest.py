"""Latest version per key, and first-filled value per attribute.

Everything here is an aggregate rather than a ranking window: partial results
are combined on the map side, so a key that owns a large share of the rows
sends one row per input partition through the shuffle and is never sorted in a
single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _order_struct(order: list[Column]) -> Column:
    return F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])


def _sortable(df: DataFrame) -> bool:
    return not any(w in f.dataType.simpleString() for f in df.schema.fields for w in ("map<", "variant"))


def latest_by_key(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row per key: the one with the greatest ``order``.

    ``order`` lists expressions from most to least significant; use a negated
    expression for "smallest first". Rows that tie on all of them are told
    apart by their other columns, so that a rerun gives the same rows.
    """
    others = [c for c in df.columns if c not in keys]
    if not _sortable(df):
        picked = df.groupBy(*keys).agg(
            F.max_by(F.struct(*others), _order_struct([F.col(c) if isinstance(c, str) else c for c in order])).alias("_row")
        )
        return picked.select(*keys, "_row.*").select(*df.columns)
    # one struct that is both the rank and the row: nothing is shuffled twice
    ranks = [(F.col(c) if isinstance(c, str) else c).alias(f"_o{i}") for i, c in enumerate(order)]
    place = {c: f"_o{i}" for i, c in enumerate(order) if isinstance(c, str)}
    rest = [c for c in others if c not in place]
    picked = df.groupBy(*keys).agg(F.max(F.struct(*ranks, *rest)).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{place.get(c, c)}").alias(c) for c in df.columns])


def latest_values(
    df: DataFrame, keys: list[str], values: list[str], order: list[Column | str]
) -> DataFrame:
    """Per key and column, the latest value that is not null."""
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    rank = _order_struct(columns)
    return df.groupBy(*keys).agg(
        *[F.max_by(v, F.when(F.col(v).isNotNull(), rank)).alias(v) for v in values]
    )


def earliest_values(
    df: DataFrame, keys: list[str], values: list[str], order: list[Column | str]
) -> DataFrame:
    """Per key and column, the earliest value that is not null."""
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    rank = _order_struct(columns)
    return df.groupBy(*keys).agg(
        *[F.min_by(v, F.when(F.col(v).isNotNull(), rank)).alias(v) for v in values]
    )


def two_stage_dedup(df: DataFrame, merge_keys: list[str], order: list[Column | str]) -> DataFrame:
    """Newest row per merge key, then identical rows only once.

    The first stage leaves one row per merge key, and the full row contains the
    merge key, so the second stage can never find a repeat: one aggregation
    does both.
    """
    return latest_by_key(df, merge_keys, order)


def first_per_group(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The alphabetically first non-null value per key."""
    return df.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.min(value).alias(value))


def ordered_array(
    df: DataFrame, keys: list[str], value: str, order: list[Column | str], name: str
) -> DataFrame:
    """Distinct values per key, newest occurrence first.

    Repeats are folded to their newest occurrence before anything is collected,
    so the array that is built is never longer than the result.
    """
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    once = df.groupBy(*keys, value).agg(F.max(_order_struct(columns)).alias("_at"))
    pairs = F.sort_array(F.collect_list(F.struct("_at", value)), asc=False)
    return once.groupBy(*keys).agg(F.transform(pairs, lambda p: p[value]).alias(name))


def merged_documents(
    df: DataFrame, keys: list[str], document: str, order: list[Column | str]
) -> DataFrame:
    """Fold all documents of a key: per attribute the newest non-null value.

    Works on (key, attribute) rows, so it pre-aggregates and no group of whole
    documents is ever brought together.
    """
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    exploded = df.select(*keys, _order_struct(columns).alias("_at"), F.explode(document))
    newest = (
        exploded.where(F.col("value").isNotNull())
        .groupBy(*keys, "key")
        .agg(F.max_by("value", "_at").alias("value"))
    )
    return newest.groupBy(*keys).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "value")))).alias(document)
    )
