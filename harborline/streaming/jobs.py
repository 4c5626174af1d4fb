"""Structured Streaming jobs. Every job takes a streaming DataFrame and paths;
state and progress live in the checkpoint, so a lost executor or a restart
repeats a micro-batch instead of losing it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from harborline.operators.latest import latest_by_key

BATCH = "_batch"


def _trigger(writer, every: str | None):
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def append_to(stream: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None, every: str | None = None) -> StreamingQuery:
    """Append rows exactly once to parquet.

    ``every`` is the trigger interval (and so the checkpoint interval) of a
    continuous run; without it, what is there is processed and the query ends.
    """
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _trigger(writer, every).start(path)


def print_rows(stream: DataFrame, every: str | None = None) -> StreamingQuery:
    """Console sink for looking at a stream."""
    return _trigger(stream.writeStream.format("console").outputMode("append"), every).start()


def _numbered_batches(path: str):
    """Writer of one folder per micro-batch; a repeated batch replaces itself."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")
    return write


def batch_sink(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Hand every micro-batch to a batch writer such as ``sinks.write_jdbc``.

    After a failure a batch is handed over again under the same number, so the
    writer should replace what it wrote for that number.
    """
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return _trigger(writer, every).start()


def run_with_restarts(start: Callable[[], StreamingQuery], attempts: int = 3) -> int:
    """Run a query to its end, started again on its checkpoint after an error; returns the number of starts.

    A batch that was written but not committed comes again under its number, so
    the sink must replace it (`update_to`, `two_sinks`, a `batch_sink` writer that does).
    """
    for attempt in range(1, attempts + 1):
        try:
            start().awaitTermination()
            return attempt
        except StreamingQueryException:
            if attempt == attempts:
                raise
    return attempts


def tap(stream: DataFrame, keys: list[str], order: list[str], path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Every micro-batch before and after its repeats are dropped, for looking at a stream: folders `before` and `after`."""
    return two_sinks(stream, {"before": lambda batch: batch, "after": lambda batch: latest_by_key(batch, keys, order)}, path, checkpoint, every)


def last_value_per_key(stream: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """Keyed state holding the latest row of each key."""
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(columns)])
    others = [c for c in stream.columns if c not in keys]
    return (
        stream.groupBy(*keys)
        .agg(F.max_by(F.struct(*others), rank).alias("_row"))
        .select(*keys, "_row.*")
    )


def update_to(stateful: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Write the changed keys of every micro-batch; see :func:`newest_state`."""
    writer = (
        stateful.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(_numbered_batches(path))
    )
    return _trigger(writer, every).start()


SNAPSHOTS = "_snapshots"


def _batches(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers of the finished folders `prefix=number` below a path."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    system = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(hadoop(path)):
        return []
    names = [status.getPath().getName() for status in system.listStatus(hadoop(path))]
    found = [int(n.partition("=")[2]) for n in names if n.startswith(f"{prefix}=")]
    return sorted(n for n in found if system.exists(hadoop(f"{path}/{prefix}={n}/_SUCCESS")))


def compact(spark: SparkSession, path: str, keys: list[str]) -> int:
    """Fold an update log into a snapshot and delete what it holds; returns the last batch in it (-1: none).

    The newest batch stays in the log, since a restarted stream may write it
    again. A snapshot counts once it is finished; batches and older snapshots
    go only after that, so a crash at any point leaves the state as it was.
    """
    snapshots, written = _batches(spark, f"{path}/{SNAPSHOTS}", "upto"), _batches(spark, path, BATCH)
    last = snapshots[-1] if snapshots else -1
    upto = max([last, *written[:-1]])
    if upto > last:
        log = log_after(spark, path, last, upto)
        folded = newest_state(log, keys, keep_batch=True)
        folded.write.mode("overwrite").parquet(f"{path}/{SNAPSHOTS}/upto={upto}")
    for name in [f"{SNAPSHOTS}/upto={n}" for n in snapshots if n < upto] + [f"{BATCH}={n}" for n in written if n <= upto]:
        old = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
        old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)
    return upto


def log_after(spark: SparkSession, path: str, snapshot: int, upto: int | None = None) -> DataFrame:
    """The snapshot of a batch (-1: none) and the later batches, each row with its batch."""
    parts = [spark.read.parquet(f"{path}/{SNAPSHOTS}/upto={snapshot}")] if snapshot >= 0 else []
    later = [n for n in _batches(spark, path, BATCH) if n > snapshot and (upto is None or n <= upto)]
    if later:
        batches = spark.read.option("basePath", path).parquet(*[f"{path}/{BATCH}={n}" for n in later])
        parts.append(batches.withColumn(BATCH, F.col(BATCH).cast("long")))
    if not parts:
        raise ValueError(f"there is no state in {path} yet")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def read_state(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Current state from the last snapshot and the batches behind it; nothing older is read."""
    snapshots = _batches(spark, f"{path}/{SNAPSHOTS}", "upto")
    return newest_state(log_after(spark, path, snapshots[-1] if snapshots else -1), keys)


def newest_state(written: DataFrame, keys: list[str], keep_batch: bool = False) -> DataFrame:
    """Current state from an update log: per key, the row of the last batch."""
    others = [c for c in written.columns if c not in (*keys, BATCH)] + [BATCH] * keep_batch
    return (
        written.groupBy(*keys)
        .agg(F.max_by(F.struct(*others), BATCH).alias("_row"))
        .select(*keys, "_row.*")
    )


def bursts(events: DataFrame, user: str, ts: str, condition: Column, at_least: int, watermark: str | None = None) -> DataFrame:
    """Users with repeated failures inside one five-minute window.

    The same plan serves batch and stream. Without a watermark no row is ever
    too late, at the price of state that only grows.
    """
    if watermark:
        events = events.withWatermark(ts, watermark)
    return (
        events.where(condition)
        .groupBy(user, F.window(ts, "5 minutes").alias("w"))
        .agg(F.count(F.lit(1)).alias("failed_count"))
        .where(F.col("failed_count") >= at_least)
        .select(user, "failed_count", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"))
    )


def two_sinks(stream: DataFrame, shapes: dict[str, Callable[[DataFrame], DataFrame]], path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Several tables from one read of the input.

    Each micro-batch is cached once and written once per shape, in a folder
    that a repeated batch replaces.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, shape in shapes.items():
                shape(batch).write.mode("overwrite").parquet(f"{path}/{name}/{BATCH}={batch_id}")
        finally:
            batch.unpersist()

    return batch_sink(stream, write, checkpoint, every)


def file_stream(spark, path: str, schema, glob: str | None = None, fmt: str = "parquet", **options: str) -> DataFrame:
    """New files below a path; the checkpoint remembers those already read."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)
