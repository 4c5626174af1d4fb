"""Golden profile: aligned sources, survivorship and the final upsert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.functions.text import unquote_list
from harborline.operators import merge as M
from harborline.operators.conform import aligned_union
from harborline.operators.latest import latest_values, merged_documents

SURVIVING = ["email", "phone", "first_name", "last_name", "city", "state", "gender", "age", "pincode"]
LISTED = ["source_system", "source_campaign", "brand_platform"]

PROFILE_RULES = {
    "source_created_date": M.overwrite,
    "source_system": M.csv_union,
    "source_campaign": lambda t, s: M.csv_union(t, unquote_list(s)),
    "brand_platform": M.csv_union,
    "brand_frequency": M.map_merge,
    "email": M.non_empty,
    "phone": M.non_empty,
    "first_name": M.non_empty,
    "last_name": M.non_empty,
    "city": M.non_empty,
    "state": M.non_empty,
    "gender": M.non_empty,
    "pincode": M.non_empty,
    "age": M.coalesce,
}


def combined_lists(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Sorted distinct filled values per key for several columns at once.

    Values are folded as (key, column, value) rows first.
    """
    entries = df.select(key, F.explode(F.create_map(*[x for c in columns for x in (F.lit(c), F.col(c))])).alias("name", "value"))
    once = entries.where(F.trim("value") != "").distinct()
    lists = once.groupBy(key, "name").agg(F.array_join(F.array_sort(F.collect_list("value")), ",").alias("value"))
    return lists.groupBy(key).agg(*[F.max(F.when(F.col("name") == c, F.col("value"))).alias(c) for c in columns])


def require_engagement(contacts: DataFrame, engagement: DataFrame, key: str, required: bool = True) -> DataFrame:
    """Contacts with engagement figures; others are dropped when required."""
    return contacts.join(engagement, key, "inner" if required else "left")


def golden_profiles(sources: list[DataFrame], key: str = "contact_id") -> DataFrame:
    """One row per contact across all sources."""
    rows = aligned_union(sources)
    order = ["updated_at", "created_at", "source_system"]
    values = latest_values(rows, [key], SURVIVING, order)
    documents = merged_documents(rows, [key], "brand_frequency", order)
    dates = rows.groupBy(key).agg(
        F.max("updated_at").alias("updated_at"),
        F.max("created_at").alias("created_at"),
        F.min("created_at").alias("source_created_date"),
    )
    return dates.join(values, key).join(combined_lists(rows, key, LISTED), key, "left").join(documents, key, "left")


def merge_profiles(target: DataFrame, source: DataFrame, now: Column, key: str = "contact_id") -> DataFrame:
    return M.merge_upsert(
        target, source.where(F.col(key).isNotNull()), [key], PROFILE_RULES,
        created_at="created_at", updated_at="updated_at", now=now, check_unique=False,
    )
