"""Table writers: replacing partitions, hot-to-cold moves, splits, JDBC."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

#: Below cold storage, hidden from its readers: staged rows and manifests.
MOVES = "_moves"


#: Rows that one task of a split sorts, unless a part has more.
RANGE_ROWS = 500_000


def replace_partitions(df: DataFrame, path: str, by: list[str], sort: list[str] | None = None) -> None:
    """Overwrite only the partitions that occur in ``df``.

    Rows are clustered by partition before writing, so that a day is not
    scattered over one small file per task; adaptive execution splits a
    partition that is too large for one task.
    """
    shaped = df.hint("rebalance", *[F.col(c) for c in by])
    if sort:
        shaped = shaped.sortWithinPartitions(*by, *sort)
    (
        shaped.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def _existing(reader: DataFrameReader, path: str) -> DataFrame | None:
    """The table at a path, or nothing if there is none yet."""
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def _hadoop(spark: SparkSession, name: str):
    """(file system, path) of a name."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _write_manifest(spark: SparkSession, folder: str, manifest: dict) -> None:
    """One small file, there whole or not at all: written under another name, then renamed."""
    system, draft = _hadoop(spark, f"{folder}/draft")
    out = system.create(draft, True)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    if not system.rename(draft, _hadoop(spark, f"{folder}/manifest")[1]):
        raise OSError(f"the manifest in {folder} could not be put in place")


def _read_manifest(spark: SparkSession, folder: str) -> dict | None:
    system, path = _hadoop(spark, f"{folder}/manifest")
    if not system.exists(path):
        return None
    return json.loads("".join(r[0] for r in spark.read.text(path.toString(), wholetext=True).collect()))


def merged_rows(old: DataFrame, new: DataFrame, keys: list[str] | None, stamp: str | None) -> DataFrame:
    """The rows of both, with the columns of both.

    With keys: per key the row of the latest stamp, the new one of equals; rows with a null key count by
    content. Without: rows that are equal in content (a missing column counts as null) stay as often as the
    side that has more of them. Any column type will do, maps too.
    """
    both = old.withColumn("_side", F.lit(0)).unionByName(new.withColumn("_side", F.lit(1)), allowMissingColumns=True)
    columns = sorted(c for c in both.columns if c != "_side")
    row = F.struct(*[F.col(f"`{c}`") for c in columns])
    digest = F.sha2(F.to_json(row), 256)
    if keys:
        known = F.lit(True)
        for key in keys:
            known = known & F.col(key).isNotNull()
        owner = F.when(known, F.to_json(F.struct(*keys))).otherwise(digest)
        last = F.struct(*([F.col(stamp)] if stamp else []), F.col("_side"), F.col("_digest"))
        held = both.select(owner.alias("_owner"), digest.alias("_digest"), "_side", row.alias("_row"), *([F.col(stamp)] if stamp else []))
        kept = held.groupBy("_owner").agg(F.max_by("_row", last).alias("_row"))
    else:
        held = both.select(digest.alias("_digest"), "_side", row.alias("_row"))
        counted = held.groupBy("_digest").agg(
            F.max_by("_row", "_side").alias("_row"), F.greatest(F.count_if(F.col("_side") == 0), F.count_if(F.col("_side") == 1)).alias("_copies")
        )
        kept = counted.select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))).alias("_copy"))
    return kept.select(*[F.col("_row").getField(c).alias(c) for c in columns])


def read_cold(spark: SparkSession, cold_path: str) -> DataFrame:
    """Cold storage with the columns of all its days."""
    return spark.read.option("mergeSchema", "true").parquet(cold_path)


def stage_move(spark: SparkSession, hot_path: str, cold_path: str, day: str, keys: list[str] | None = None, stamp: str | None = "updated_at") -> bool:
    """First phase: one day's rows, hot and cold together, written aside; a manifest names the files that were read.

    False if there is nothing to move. Nothing that readers see has changed.
    """
    folder = f"{cold_path}/{MOVES}/{day}"
    hot = _existing(spark.read.option("basePath", hot_path), f"{hot_path}/day={day}")
    if hot is None:
        return False
    names = [spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(f)).toString() for f in hot.inputFiles()]
    if not names:
        return False
    # exactly these files: what lands meanwhile waits for the next move
    found = spark.read.option("basePath", hot_path).option("mergeSchema", "true").parquet(*names).withColumn("day", F.lit(day).cast("date"))
    moved = found.count()
    if not moved:
        return False
    cold = _existing(spark.read.option("mergeSchema", "true"), cold_path)
    before = found.limit(0) if cold is None else cold.where(F.col("day") == F.lit(day).cast("date"))
    merged_rows(before, found, keys, stamp).write.mode("overwrite").parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows").count()
    _write_manifest(spark, folder, {"files": names, "moved": moved, "rows": rows})
    return True


def finish_move(spark: SparkSession, cold_path: str, day: str, sort: list[str] | None = None) -> int:
    """Second phase: replace the day in cold storage by the staged rows, check them, delete the files of the manifest.

    Can be repeated after a crash at any point; without a manifest there is nothing to do. Returns the rows
    that were read from hot storage.
    """
    folder = f"{cold_path}/{MOVES}/{day}"
    manifest = _read_manifest(spark, folder)
    if manifest is None:
        return 0
    staged = spark.read.parquet(f"{folder}/rows")
    replace_partitions(staged, cold_path, ["day"], sort)
    stored = read_cold(spark, cold_path).where(F.col("day") == F.lit(day).cast("date"))
    lost = sorted(set(staged.columns) - set(stored.columns))
    count = stored.count()
    if count != manifest["rows"] or lost:
        raise ValueError(f"{count} of {manifest['rows']} rows of {day} reached cold storage; columns missing there: {lost}")
    for name in manifest["files"]:
        system, path = _hadoop(spark, name)
        system.delete(path, False)
    system, path = _hadoop(spark, folder)
    system.delete(path, True)
    return manifest["moved"]


def move_day_to_cold(spark: SparkSession, hot_path: str, cold_path: str, day: str, stamp: str = "updated_at", keys: list[str] | None = None) -> int:
    """Move one day from hot to cold storage in two phases; returns the rows read from hot storage.

    A move that was cut off is finished first. Rows that cold already holds stay, with the columns of both
    (see `merged_rows`), so late rows and rows with new columns can follow, and a repeated move adds nothing.
    """
    sort = [stamp]
    moved = finish_move(spark, cold_path, day, sort)
    if stage_move(spark, hot_path, cold_path, day, keys, stamp):
        moved += finish_move(spark, cold_path, day, sort)
    return moved


def materialise(df: DataFrame, path: str) -> DataFrame:
    """Write a table and read it back: later steps start from the files."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def landing_columns(arrival: Column) -> dict[str, Column]:
    """Landing folders by the arrival of each row, not of its batch."""
    return {
        "year": F.date_format(arrival, "yyyy"),
        "month": F.date_format(arrival, "MM"),
        "day": F.date_format(arrival, "dd"),
        "hour": F.date_format(arrival, "HH"),
    }


def land(df: DataFrame, path: str, arrival: str) -> None:
    """Append raw rows below ``year/month/day/hour``.

    Rows are brought together per hour first: otherwise every task would write
    its own small file into every folder.
    """
    columns = landing_columns(F.col(arrival))
    shaped = df.withColumns(columns).hint("rebalance", *[F.col(c) for c in columns])
    shaped.write.mode("append").partitionBy(*columns).parquet(path)


def csv_to_parquet(spark: SparkSession, source: str, target: str, schema: str, timestamp_format: str) -> None:
    """Typed CSV to snappy parquet."""
    (
        spark.read.schema(schema)
        .option("header", "true")
        .option("timestampNTZFormat", timestamp_format)
        .option("timestampFormat", timestamp_format)
        .csv(source)
        .write.mode("overwrite")
        .option("compression", "snappy")
        .parquet(target)
    )


def split_files(df: DataFrame, path: str, order: list[str], files: int | None = None, rows_per_file: int | None = None) -> None:
    """CSV parts with a header each: a number of parts or a size per part.

    With both, a range of rows is cut into parts of that size anyway: there are `files` ranges at least, and so
    many more that a task sorts RANGE_ROWS rows or one part, however large the table is.
    """
    if files and rows_per_file:
        files = max(files, -(-df.count() // max(rows_per_file, RANGE_ROWS)))
    writer = df.repartitionByRange(files, *order) if files else df
    writer = writer.sortWithinPartitions(*order).write.mode("overwrite").option("header", "true")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.csv(path)


def verify_split(spark: SparkSession, source: DataFrame, path: str) -> DataFrame:
    """(source_rows, split_rows, same_header, complete) of a finished split; every part must have the source's header."""
    counted = source.agg(F.count(F.lit(1)).alias("source_rows"))
    split = spark.read.option("header", "true").csv(path).agg(F.count(F.lit(1)).alias("n"))
    heads = part_headers(spark, source, path).agg(F.coalesce(F.bool_and("same"), F.lit(False)).alias("same"))
    return counted.select(
        "source_rows", split.scalar().alias("split_rows"), heads.scalar().alias("same_header")
    ).withColumn("complete", (F.col("source_rows") == F.col("split_rows")) & F.col("same_header"))


def part_headers(spark: SparkSession, source: DataFrame, path: str) -> DataFrame:
    """(part, header, same) for every file of a split: its first line, and whether it names the source's columns in order.

    Only a file's first block is looked at, and a task keeps one line of it.
    """
    lines = spark.read.text(path).where(F.col("_metadata.file_block_start") == 0)
    first = lines.select(F.col("_metadata.file_path").alias("part"), "value", F.monotonically_increasing_id().alias("at"))
    heads = first.groupBy("part").agg(F.min_by("value", "at").alias("header"))
    cells = F.from_csv("header", ", ".join(f"c{i} string" for i in range(len(source.columns))) + ", _corrupt string", {"columnNameOfCorruptRecord": "_corrupt", "escape": '"'})
    named = F.array(*[F.col(f"_cells.c{i}") for i in range(len(source.columns))])
    same = F.col("_cells._corrupt").isNull() & F.coalesce(named == F.array(*[F.lit(c) for c in source.columns]), F.lit(False))
    return heads.withColumn("_cells", cells).select("part", "header", same.alias("same"))


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], batch_size: int = 1000, connections: int = 8) -> None:
    """Batched inserts over a bounded number of connections; what comes before keeps its own parallelism."""
    (
        df.repartition(connections)
        .write.mode("append")
        .option("batchsize", batch_size)
        .jdbc(url, table, properties=properties)
    )
