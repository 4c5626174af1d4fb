"""Mail-address validation: known results first, scoring only for the rest."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from harborline.operators.joins import lookup_join
from harborline.settings import work_path
from harborline.sinks.tables import materialise

VERDICTS = ["valid", "invalid", "catchall", "unknown", "disposable"]  # fixed values


def unknown_addresses(addresses: DataFrame, lookup: DataFrame, column: str) -> DataFrame:
    """Distinct addresses without a stored verdict."""
    return (
        addresses.where(addresses[column].isNotNull())
        .select(column)
        .distinct()
        .join(lookup.select(column), column, "left_anti")
    )


def validation_cycle(
    addresses: DataFrame,
    lookup: DataFrame,
    column: str,
    score: Callable[[DataFrame], DataFrame],
) -> tuple[DataFrame, DataFrame]:
    """(records with verdict, lookup including the new verdicts).

    ``score`` maps distinct addresses to (address, verdict); it only sees those
    the lookup does not know. Their verdicts are written once, since both
    results use them; records without an address are spread over all tasks.
    """
    new = score(unknown_addresses(addresses, lookup, column)).select(column, "verdict")
    scored = materialise(new, work_path(addresses.sparkSession, "verdicts"))
    known = lookup.select(column, "verdict").unionByName(scored)
    spread_by = [f.name for f in addresses.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    return lookup_join(addresses, known, [column], spread_by), known
