"""Bringing vendor files and raw tables to an expected shape."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborline.functions.text import keep_plain, title_words


def cleaning_columns(df: DataFrame) -> list[Column]:
    """Cleaning projection derived from the column names and types.

    Password columns go; text is reduced to plain characters; name columns are
    capitalised; decimals end in ``_amount``; ``_at``/``_date`` timestamps are
    renamed to ``_time``.
    """
    chosen = []
    for field in df.schema.fields:
        lower = field.name.lower()
        if "password" in lower:
            continue
        value, name = F.col(field.name), field.name
        if isinstance(field.dataType, T.StringType):
            value = keep_plain(value)
        if "name" in lower:
            value = title_words(value if isinstance(field.dataType, T.StringType) else value.cast("string"))
        if isinstance(field.dataType, T.DecimalType) and "amount" not in lower:
            name = f"{name}_amount"
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            name = re.sub(r"_(at|date)", "_time", name)
        chosen.append(value.alias(name))
    return chosen


def received_columns(df: DataFrame, mapping: dict[str, str]) -> tuple[set[str], set[str], dict[str, str]]:
    """(received targets, missing targets, usable part of the mapping)."""
    present = {source: target for source, target in mapping.items() if source in df.columns}
    received = set(present.values())
    return received, set(mapping.values()) - received, present


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed({s: t for s, t in mapping.items() if s in df.columns})


def conform(df: DataFrame, expected: list[str], data_type: str = "string") -> DataFrame:
    """Expected columns in order: missing ones null, further ones dropped."""
    return df.select(
        *[F.col(c) if c in df.columns else F.lit(None).cast(data_type).alias(c) for c in expected]
    )


def payload(df: DataFrame, columns: list[str], missing: list[str] | None = None) -> Column:
    """All columns as one JSON text in which nulls stay visible."""
    parts = [F.col(c) for c in columns]
    parts += [F.lit(None).cast("string").alias(c) for c in missing or [] if c not in columns]
    return F.to_json(F.struct(*parts), {"ignoreNullFields": "false"})


def unexpected_columns(df: DataFrame, expected: list[str]) -> list[str]:
    return [c for c in df.columns if c not in expected]


def route_unexpected(df: DataFrame, expected: list[str]) -> DataFrame:
    """Add ``unexpected``: names of the surplus columns that hold data.

    Rows with an empty list are valid, the others go to the error table.
    """
    extra = unexpected_columns(df, expected)
    if not extra:
        return df.withColumn("unexpected", F.array().cast("array<string>"))
    named = F.array(
        *[F.when(F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) != "", F.lit(c)) for c in extra]
    )
    return df.withColumn("unexpected", F.array_compact(named))


def exported_scalar(document: Column, key: str, wrapper: str) -> Column:
    """Value of an export field that may be wrapped (``{"$oid": ..}``)."""
    return F.coalesce(
        F.get_json_object(document, f"$.{key}.{wrapper}"), F.get_json_object(document, f"$.{key}")
    )


def flatten_export(document: Column, ids: list[str], dates: list[str], others: list[str]) -> list[Column]:
    """Columns of one exported JSON record; absent ones are empty text.

    Ids and dates may come wrapped, nested values stay JSON text.
    """
    columns = [exported_scalar(document, k, "$oid").alias(k) for k in ids]
    columns += [exported_scalar(document, k, "$date").alias(k) for k in dates]
    columns += [F.get_json_object(document, f"$.{k}").alias(k) for k in others]
    return [F.coalesce(c, F.lit("")).alias(k) for c, k in zip(columns, [*ids, *dates, *others])]


def aligned_union(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL by name; a column absent in a branch is null there."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def channel_consent(phone: Column, email: Column, stamped: Column) -> dict[str, Column]:
    """Consent status and time per channel, from the identifiers at hand."""
    has_phone = F.coalesce(F.trim(phone), F.lit("")) != ""
    has_email = F.coalesce(F.trim(email), F.lit("")) != ""
    columns = {}
    for channel, available in (("email", has_email), ("sms", has_phone), ("whatsapp", has_phone)):
        columns[f"{channel}_consent_status"] = F.when(available, F.lit("true"))
        columns[f"{channel}_consent_status_ts"] = F.when(available, stamped)
    return columns
