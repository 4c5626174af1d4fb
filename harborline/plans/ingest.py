"""Vendor file ingestion: rename, conform, validate, identify, route, audit."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.functions.dates import utc_text
from harborline.functions.text import clean_email, clean_phone, with_country_prefix
from harborline.operators import conform as C
from harborline.operators.once import once
from harborline.operators.identity import ERROR, attach_identity, triage
from harborline.sinks.audit import audit_rows, error_rows


@dataclass(frozen=True)
class FileSpec:
    """What is known about one vendor's files."""

    mapping: dict[str, str]
    expected: list[str]
    phone: str = "phone"
    email: str = "email"
    consent_time: str = "consent_timestamp"
    reject_unexpected: bool = False
    static: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Loaded:
    """Result of one load: accepted payloads, error rows, audit rows."""

    records: DataFrame
    errors: DataFrame
    audit: DataFrame
    classified: DataFrame


def standardise(raw: DataFrame, spec: FileSpec) -> DataFrame:
    """Vendor columns under their target names, with cleaned identifiers."""
    df = C.rename_columns(raw, spec.mapping)
    for name in (spec.phone, spec.email, "phone_hashed", "email_hashed", spec.consent_time):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast("string"))
    phone = clean_phone(F.col(spec.phone))
    return df.withColumns(
        {
            "normalized_phone": F.when(phone.isNotNull(), with_country_prefix(phone)),
            "normalized_email": clean_email(F.col(spec.email)),
            **{k: F.lit(v) for k, v in spec.static.items()},
        }
    )


def classify(df: DataFrame, spec: FileSpec, by_phone: DataFrame, by_email: DataFrame, spread_by: list[str]) -> DataFrame:
    """Identity, outcome and reason for every row, schema errors included."""
    internal = [*spec.expected, "normalized_phone", "normalized_email", "phone_hashed", "email_hashed", spec.consent_time, "file_name", *spec.static, *spread_by]
    routed = C.route_unexpected(df, internal) if spec.reject_unexpected else df.withColumn("unexpected", F.array().cast("array<string>"))
    identified = attach_identity(routed, by_phone, by_email, spread_by, "normalized_phone", "normalized_email")
    sorted_out = triage(identified, "normalized_phone", "normalized_email")
    surplus = F.size("unexpected") > 0
    return sorted_out.withColumns(
        {
            "outcome": F.when(surplus, ERROR).otherwise(F.col("outcome")),
            "error_detail": F.when(
                surplus,
                F.concat(F.lit("Row contains unexpected columns with data: "), F.array_join("unexpected", ", ")),
            ).otherwise(F.col("error_detail")),
        }
    )


def load(
    raw: DataFrame,
    spec: FileSpec,
    by_phone: DataFrame,
    by_email: DataFrame,
    *,
    execution_id: str,
    process_name: str,
    target_table: str,
    started: Column,
    finished: Column,
    spread_by: list[str],
) -> Loaded:
    """The whole load of a vendor's files, ``raw`` carrying ``file_name``."""
    _, missing, _ = C.received_columns(raw, spec.mapping)
    df = standardise(raw, spec)
    classified = classify(df, spec, by_phone, by_email, spread_by)
    data = [c for c in df.columns if c not in ("file_name", *spread_by)]
    consent = C.channel_consent(F.col("normalized_phone"), F.col("normalized_email"), F.col("_consented"))
    stamped = once(classified, {"_consented": utc_text(F.col(spec.consent_time))})
    enriched = stamped.withColumns(consent).drop("_consented")
    body = C.payload(enriched, [*data, *consent], sorted(missing))
    records = enriched.where(F.col("outcome") != ERROR).select("identity", body.alias("payload"), "file_name")
    errors = error_rows(
        enriched.where(F.col("outcome") == ERROR),
        execution_id=execution_id, identity="identity", phone=spec.phone, email=spec.email,
        file_name=F.col("file_name"), detail="error_detail", data=[*data, *consent],
    )
    audit = audit_rows(
        classified, "file_name", execution_id=execution_id, process_name=process_name,
        source_name="vendor", target_table=target_table, started=started, finished=finished,
        valid=F.col("outcome") != ERROR,
    )
    return Loaded(records, errors, audit, classified)


def protect(df: DataFrame, encrypted: list[str], hashed: list[str], key: Column) -> DataFrame:
    """Encrypt some identifier columns and hash others."""
    from harborline.functions.security import encrypt, hashed_identifier

    none = F.lit(None).cast("string")
    return df.withColumns(
        {
            **{c: encrypt(F.col(c), key) for c in encrypted},
            **{f"{c}_hashed": hashed_identifier(none, F.col(c)) for c in hashed},
        }
    )
