"""Folding many columns per key in one pass, with aggregates that combine on the map side.

Every row stays one row with all columns of which one value is kept. Only maps
and addresses, whose entries are open in number, become rows of their own: the
attribute's name, an entry (the key of a map, the address of an address list),
the value and the row's order. One aggregate keeps the newest values per key,
attribute and entry (a key with very many rows sends few), a second one lays
the entries out as columns again. Any number of columns of any rule costs these
two shuffles.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Newest:
    """The newest value that is not null, of this type."""

    type: str = "string"


@dataclass(frozen=True)
class Entries:
    """A map<string,string>: per key of the map the newest value that is not null."""


@dataclass(frozen=True)
class Addresses:
    """struct<values, dates>: the distinct values, newest first, with the time each was last seen."""


Rule = Newest | Entries | Addresses
_ROW = "struct<attribute:string,entry:string,value:string>"


def _present() -> Column:
    """The row without attribute that every row has."""
    return F.array(F.struct(*[F.lit(None).cast("string").alias(c) for c in ("attribute", "entry", "value")]))


def _entries(name: str, rule: Rule) -> Column:
    """The attribute rows of one column of one row."""
    row = lambda entry, value: F.struct(F.lit(name).alias("attribute"), entry.cast("string").alias("entry"), value.cast("string").alias("value"))
    none = F.lit(None)
    if isinstance(rule, Entries):
        filled = F.filter(F.map_entries(name), lambda e: e["value"].isNotNull())
        return F.coalesce(F.transform(filled, lambda e: row(e["key"], e["value"])), F.array().cast(f"array<{_ROW}>"))
    made = row(F.col(name), none) if isinstance(rule, Addresses) else row(none, F.col(name))
    return F.when(F.col(name).isNotNull(), F.array(made)).otherwise(F.array().cast(f"array<{_ROW}>"))


def attribute_rows(rows: DataFrame, keys: list[str], columns: dict[str, Rule], order: list[str]) -> DataFrame:
    """keys, at (the order columns), attribute, entry, value: one row for every filled value, and one without attribute for every row."""
    filled = F.concat(_present(), *[_entries(name, rule) for name, rule in columns.items()])
    return rows.select(*keys, F.struct(*order).alias("at"), F.inline(filled))


def fold(rows: DataFrame, keys: list[str], columns: dict[str, Rule], order: list[str]) -> DataFrame:
    """One row per key with all columns folded by their rules, newest by `order`; of equals the greater value counts.

    The first order column is the time that Addresses report. A key all of whose values are null keeps its row.
    """
    single = {name: rule for name, rule in columns.items() if isinstance(rule, Newest)}
    several = {name: rule for name, rule in columns.items() if name not in single}
    slot = {name: f"v{i}" for i, name in enumerate(single)}
    # the row without attribute holds all single values, the row of an entry none
    values = F.struct(F.lit(True).alias("here"), *[F.col(c).cast("string").alias(v) for c, v in slot.items()])
    entries = F.transform(F.concat(_present(), *[_entries(name, rule) for name, rule in several.items()]), lambda e: F.struct(
        e["attribute"].alias("attribute"), e["entry"].alias("entry"), e["value"].alias("value"), F.when(e["attribute"].isNull(), values).alias("single"),
    ))
    made = rows.select(*keys, F.struct(*order).alias("at"), F.inline(entries))

    def newest_of(value: str) -> Column:
        ranks = [F.col(f"at.{c}").alias(f"o{i}") for i, c in enumerate(order)]
        filled = F.col(f"single.{value}")
        return F.max(F.when(filled.isNotNull(), F.struct(*ranks, filled.alias("value")))).alias(f"_{value}")

    last = F.max(F.when(F.col("attribute").isNotNull(), F.struct("at", "value"))).alias("last")
    newest = made.groupBy(*keys, "attribute", "entry").agg(last, *[newest_of(v) for v in slot.values()])

    def laid_out(name: str, rule: Rule) -> Column:
        mine = F.col("attribute") == name
        if isinstance(rule, Newest):
            return F.max(F.col(f"_{slot[name]}")["value"]).cast(rule.type).alias(name)
        if isinstance(rule, Entries):
            pairs = F.array_sort(F.collect_list(F.when(mine, F.struct(F.col("entry").alias("key"), F.col("last.value").alias("value")))))
            return F.when(F.size(pairs) > 0, F.map_from_entries(pairs)).alias(name)
        seen = F.sort_array(F.collect_list(F.when(mine, F.struct(F.col(f"last.at.{order[0]}").alias("at"), F.col("entry").alias("value")))), asc=False)
        both = F.struct(F.transform(seen, lambda p: p["value"]).alias("values"), F.transform(seen, lambda p: p["at"].cast("string")).alias("dates"))
        return F.when(F.size(seen) > 0, both).alias(name)

    return newest.groupBy(*keys).agg(*[laid_out(name, rule) for name, rule in columns.items()])
