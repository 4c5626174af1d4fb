"""Vendor files: incremental discovery, tolerant CSV and JSON reading."""

from __future__ import annotations

from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborline.functions.text import to_flag
from harborline.operators.once import once

DATA_FILE_GLOB = "*.{[cC][sS][vV],[jJ][sS][oO][nN]}"


def newer_files(listing: DataFrame, last_processed: Column, position: str = "generation") -> DataFrame:
    """CSV and JSON files behind the high-water mark, any letter case."""
    wanted = F.lower(F.col("path")).rlike(r"\.(csv|json)$")
    return listing.where(wanted & (F.col(position) > last_processed))


def list_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Path, size and modification time of data files, contents untouched."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", DATA_FILE_GLOB)
        .option("recursiveFileLookup", "true")
        .load(paths)
        .select("path", "length", (F.unix_micros("modificationTime")).alias("generation"))
    )


def plain_path(uri: Column) -> Column:
    """The path that a file's URI (``_metadata.file_path``) stands for, as listings show it."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def _by_header(spark: SparkSession, paths: str | list[str], splittable: bool) -> DataFrame:
    """CSV files as text columns, each file read under its own header line.

    Spark applies the first file's header to all files by position, so files
    are grouped by their header, and the groups are joined by column name.
    """
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), "value", F.monotonically_increasing_id().alias("at"))
    headers = lines.groupBy("path").agg(F.min_by("value", "at").alias("header"))
    groups: dict[str, list[str]] = {}
    for row in headers.orderBy("path").collect():
        groups.setdefault(row["header"].rstrip("\r"), []).append(unquote(row["path"]))
    reader = (
        spark.read.option("header", "true")
        .option("inferSchema", "false")
        .option("multiLine", str(not splittable).lower())
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
    )
    if len(groups) < 2:
        return reader.csv(paths)
    whole = None
    for files in groups.values():
        part = reader.csv(files)
        whole = part if whole is None else whole.unionByName(part, allowMissingColumns=True)
    return whole


def read_vendor_csv(spark: SparkSession, paths: str | list[str], splittable: bool = False) -> DataFrame:
    """Every column as text, so that identifiers keep their digits; columns of all files by name."""
    return _by_header(spark, paths, splittable)


def load_csv(spark: SparkSession, paths: str | list[str], schema: str | T.StructType, splittable: bool = False) -> DataFrame:
    """CSV under an explicit schema.

    Columns are matched by each file's own header, surplus ones are ignored, short rows
    are filled with null. Files without quoted line breaks may be read as
    ``splittable``, which lets one big file use many tasks.
    """
    wanted = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    raw = _by_header(spark, paths, splittable)
    return raw.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in raw.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in wanted.fields
        ]
    )


def read_json(spark: SparkSession, paths: str | list[str], schema: str, whole_document: bool = False) -> DataFrame:
    """JSON lines, or one object/array per file; broken records are dropped."""
    reader = spark.read.schema(schema).option("mode", "DROPMALFORMED")
    if whole_document:
        reader = reader.option("multiLine", "true")
    return reader.json(paths)


def read_partition(spark: SparkSession, path: str) -> DataFrame:
    """One landed partition with repeated rows removed."""
    return spark.read.parquet(path).dropDuplicates()


def unit_prefixes(units: DataFrame, patterns: list[str], unit: str) -> DataFrame:
    """(unit, prefix) pairs from patterns holding ``{unit}``, each once."""
    filled = F.transform(
        F.array(*map(F.lit, patterns)), lambda p: F.replace(p, F.lit("{unit}"), F.col(unit).cast("string"))
    )
    return units.select(unit, F.explode(F.array_distinct(filled)).alias("prefix")).distinct()


def active_units(lookup: DataFrame, environment: str, column: str) -> DataFrame:
    """Distinct units of one environment; join it (semi) to filter files."""
    return lookup.where(F.col("env_name") == environment).select(column).distinct()


# --- typed text lines ------------------------------------------------------

@dataclass(frozen=True)
class TypedField:
    name: str
    kind: str  # text | bool | int | date | timestamp


def _typed(field: TypedField, text: Column) -> Column:
    filled = F.nullif(text, F.lit(""))
    if field.kind == "bool":
        return to_flag(filled)
    if field.kind == "int":
        return filled.try_cast("int")
    if field.kind == "date":
        return F.try_to_date(filled, "yyyy-MM-dd")
    if field.kind == "timestamp":
        return F.try_to_timestamp(
            F.replace(filled, F.lit(" UTC"), F.lit("")), F.lit("yyyy-MM-dd HH:mm:ss")
        ).cast("timestamp_ntz")
    return filled


def parse_lines(lines: DataFrame, fields: list[TypedField], line: str = "value") -> tuple[DataFrame, DataFrame]:
    """(records, rejected lines) of CSV text lines.

    A line with another number of columns is rejected whole; a value that does
    not fit its type becomes null. The parser that reads the cells also counts
    them: doubled quotes stand for one inside a quoted cell, and a quote inside
    a plain cell is an ordinary character.
    """
    cells = ", ".join(f"c{i} string" for i in range(len(fields)))
    options = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    parsed = once(lines, {"_cells": F.from_csv(F.col(line), f"{cells}, _corrupt string", options)})
    fits = F.coalesce((F.col(line) != "") & F.col("_cells").isNotNull() & F.col("_cells._corrupt").isNull(), F.lit(False))
    rest = [c for c in lines.columns if c != line]
    records = parsed.where(fits).select(
        *rest, *[_typed(f, F.col(f"_cells.c{i}")).alias(f.name) for i, f in enumerate(fields)]
    )
    return records, parsed.where(~fits).select(*lines.columns)
