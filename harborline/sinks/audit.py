"""Audit rows per load and error rows per rejected record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AUDIT_COLUMNS = [
    "execution_id", "process_name", "source_name", "load_type", "load_source_type",
    "source_detail", "target_table", "landing_time", "process_start_time", "process_end_time",
    "process_status", "rows_processed", "error_message", "created_at", "updated_at",
]


def audit_rows(
    loaded: DataFrame,
    per: str,
    *,
    execution_id: str,
    process_name: str,
    source_name: str,
    target_table: str,
    started: Column,
    finished: Column,
    landing_time: str | None = None,
    valid: Column | None = None,
    load_type: str = "incremental",
    load_source_type: str = "file",
    listing: DataFrame | None = None,
) -> DataFrame:
    """One audit row per source file, counted in one pass over the load.

    A file of which no row was accepted is a failure. With a listing
    (source_detail, landing_time) every listed file gets a row, also one that
    is empty or was not read at all, and the position moves past it.
    """
    accepted = F.count_if(valid) if valid is not None else F.count(F.lit(1))
    position = F.max(landing_time) if landing_time else F.lit(None).cast("long")
    counted = loaded.groupBy(F.col(per).alias("source_detail")).agg(
        accepted.alias("rows_processed"), position.alias("landing_time")
    )
    if listing is not None:
        listed = listing.groupBy("source_detail").agg(F.max("landing_time").alias("_landed"))
        counted = counted.join(listed, "source_detail", "full").select(
            "source_detail", F.coalesce("rows_processed", F.lit(0).cast("long")).alias("rows_processed"), F.coalesce("_landed", "landing_time").alias("landing_time")
        )
    empty = F.col("rows_processed") == 0
    constants = {
        "execution_id": F.lit(execution_id),
        "process_name": F.lit(process_name),
        "source_name": F.lit(source_name),
        "load_type": F.lit(load_type),
        "load_source_type": F.lit(load_source_type),
        "target_table": F.lit(target_table),
        "process_start_time": started,
        "process_end_time": finished,
        "process_status": F.when(empty, "FAILURE").otherwise("SUCCESS"),
        "error_message": F.when(empty, "no row was loaded"),
        "created_at": finished,
        "updated_at": finished,
    }
    return counted.withColumns(constants).select(*AUDIT_COLUMNS)


def error_rows(
    rejected: DataFrame,
    *,
    execution_id: str,
    identity: str | None,
    phone: str,
    email: str,
    file_name: Column,
    detail: str,
    data: list[str],
) -> DataFrame:
    """Rejected records in the shape of the error table."""
    return rejected.select(
        F.lit(execution_id).alias("execution_id"),
        (F.col(identity).cast("string") if identity else F.lit(None).cast("string")).alias("identity"),
        F.col(phone).cast("string").alias("phone"),
        F.col(email).cast("string").alias("email"),
        file_name.alias("file_name"),
        F.col(detail).alias("error_detail"),
        F.to_json(F.struct(*data), {"ignoreNullFields": "false"}).alias("data"),
        F.lit(0).alias("processed_flag"),
    )


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)
