"""Attaching an identity to records by phone first, then by mail address."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.operators.joins import lookup_join

MATCHED, HASH_ONLY, ERROR = "matched", "hash_only", "error"


def identity_table(df: DataFrame, kind: str, value: str, identity: str) -> DataFrame:
    """(value, id) pairs of one kind, one row per value."""
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(F.col(value).alias(kind))
        .agg(F.min(identity).alias(f"_{kind}_id"))
    )


def attach_identity(
    records: DataFrame,
    by_phone: DataFrame,
    by_email: DataFrame,
    spread_by: list[str],
    phone: str = "phone",
    email: str = "email",
) -> DataFrame:
    """Left-join both lookups; the phone match has priority.

    Adds ``identity``. Records without a phone or address are spread over the
    tasks instead of meeting in one.
    """
    phones = by_phone.select(F.col("phone").alias(phone), "_phone_id")
    emails = by_email.select(F.col("email").alias(email), "_email_id")
    joined = lookup_join(records, phones, [phone], spread_by)
    joined = lookup_join(joined, emails, [email], spread_by)
    return joined.select(*records.columns, F.coalesce("_phone_id", "_email_id").alias("identity"))


def triage(
    df: DataFrame,
    phone: str = "phone",
    email: str = "email",
    phone_hash: str = "phone_hashed",
    email_hash: str = "email_hashed",
) -> DataFrame:
    """Add ``outcome`` and ``error_detail`` to records with ``identity``.

    Found -> matched. An identifier that was not found is an error even with
    hashes present; without identifiers, hashes keep the record.
    """
    has_phone, has_email = F.col(phone).isNotNull(), F.col(email).isNotNull()
    filled = lambda c: F.coalesce(F.trim(F.col(c)), F.lit("")) != ""
    has_hash = filled(phone_hash) | filled(email_hash)
    outcome = (
        F.when(F.col("identity").isNotNull(), MATCHED)
        .when(has_phone | has_email, ERROR)
        .when(has_hash, HASH_ONLY)
        .otherwise(ERROR)
    )
    reason = (
        F.when(
            has_phone & has_email,
            F.concat(F.lit("Both phone "), phone, F.lit(" and email "), email, F.lit(" failed.")),
        )
        .when(has_phone, F.concat(F.lit("Phone "), phone, F.lit(" failed: no identity found.")))
        .when(has_email, F.concat(F.lit("Email "), email, F.lit(" failed: no identity found.")))
        .otherwise(F.lit("No phone or email available for identity lookup."))
    )
    note = F.when(has_hash, F.lit(" Record has hashed identifiers but phone/email lookup failed.")).otherwise("")
    return df.withColumn("outcome", outcome).withColumn(
        "error_detail", F.when(F.col("outcome") == ERROR, F.concat(reason, note))
    )


def balance(df: DataFrame) -> DataFrame:
    """One row with the outcome counts and whether they add up."""
    counts = {name: F.count_if(F.col("outcome") == name) for name in (MATCHED, HASH_ONLY, ERROR)}
    return df.agg(
        F.count(F.lit(1)).alias("total"), *[c.alias(name) for name, c in counts.items()]
    ).withColumn("balanced", F.col("total") == F.col(MATCHED) + F.col(HASH_ONLY) + F.col(ERROR))


def assert_balanced(df: DataFrame) -> None:
    """Raise when rows were lost between input and the outcome classes."""
    row = balance(df).first()
    if not row["balanced"]:
        raise ValueError(f"row balance broken: {row.asDict()}")
