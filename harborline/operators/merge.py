"""Upsert of a change set into a snapshot, with one rule per column."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.functions import documents as D

Rule = Callable[[Column, Column], Column]


def overwrite(target: Column, source: Column) -> Column:
    return source


def keep(target: Column, source: Column) -> Column:
    return target


def coalesce(target: Column, source: Column) -> Column:
    return F.coalesce(source, target)


def non_empty(target: Column, source: Column) -> Column:
    return D.filled_or(source, target)


def csv_union(target: Column, source: Column) -> Column:
    return D.union_lists(target, source)


def map_merge(target: Column, source: Column) -> Column:
    return D.prefer_source(target, source)


def map_merge_immutable(*fixed_keys: str) -> Rule:
    return lambda target, source: D.prefer_source_except(target, source, list(fixed_keys))


def fold_addresses(target: Column, source: Column) -> Column:
    """``source`` is ``struct<values, dates>``, newest first."""
    return D.fold_addresses(target, source["values"], source["dates"])


def new_addresses(source: Column) -> Column:
    return D.fold_addresses(F.lit(None).cast("string"), source["values"], source["dates"])


append_structs: Rule = D.append_distinct
merge_ids: Rule = D.merge_ids


def assert_unique(source: DataFrame, keys: list[str]) -> None:
    """Refuse a change set with several rows for one key."""
    repeated = source.groupBy(*keys).count().where(F.col("count") > 1)
    if not repeated.isEmpty():
        raise ValueError(f"several source rows for one key {keys}")


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    rules: dict[str, Rule],
    *,
    on_insert: dict[str, Rule] | None = None,
    watched: list[str] | None = None,
    bump: str | None = None,
    created_at: str | None = None,
    updated_at: str | None = None,
    now: Column | None = None,
    check_unique: bool = True,
) -> DataFrame:
    """New snapshot: matched rows by rule, unmatched source rows inserted.

    One full outer join on the key. Columns without a rule keep the target
    value on a match and take the source value on insert. ``bump`` is set to
    ``now`` when any ``watched`` column ends up with another value;
    ``created_at`` only on insert and ``updated_at`` on both branches.
    """
    source = source.where(~F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False)))
    if check_unique:
        assert_unique(source, keys)
    stamps = [c for c in (bump, created_at, updated_at) if c]
    columns = [c for c in target.columns if c not in keys]
    source_names = set(source.columns)
    side = lambda df, mark: df.select(
        *keys, F.lit(True).alias(mark), *[F.col(c).alias(f"{mark}{c}") for c in df.columns if c not in keys]
    )
    joined = side(target, "_t_").join(side(source, "_s_"), keys, "full_outer")
    matched = F.col("_t_").isNotNull() & F.col("_s_").isNotNull()
    inserted = F.col("_t_").isNull()

    def merged(name: str) -> Column:
        if name not in source_names:
            return F.col(f"_t_{name}")
        old, new = F.col(f"_t_{name}"), F.col(f"_s_{name}")
        fresh = (on_insert or {}).get(name, overwrite)(F.lit(None), new)
        return (
            F.when(matched, rules.get(name, keep)(old, new)).when(inserted, fresh).otherwise(old)
        )

    values = {name: merged(name) for name in columns if name not in stamps}
    if bump:
        changed = F.lit(False)
        for name in watched or []:
            changed = changed | ~values[name].eqNullSafe(F.col(f"_t_{name}"))
        values[bump] = F.when(matched & changed, now).when(inserted, now).otherwise(F.col(f"_t_{bump}"))
    if created_at:
        values[created_at] = F.when(inserted, now).otherwise(F.col(f"_t_{created_at}"))
    if updated_at:
        values[updated_at] = F.when(F.col("_s_").isNotNull(), now).otherwise(F.col(f"_t_{updated_at}"))
    return joined.select(*keys, *[values[name].alias(name) for name in columns])
