"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import os
import re
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborline.settings import prepare, work_path

#: Rows of one Arrow batch; with whole documents in it a batch stays at a few megabytes.
BATCH_ROWS = 512


_shipped: set[str] = set()


def _ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = os.path.join(tempfile.mkdtemp(prefix="harborline-code-"), f"{package.name}.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def prepare_llm(spark: SparkSession) -> SparkSession:
    """Session settings of the library, and Arrow batches small enough for whole documents."""
    prepare(spark)
    _ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the sample tables."""
    return prepare_llm(spark).read.parquet(f"{folder}/{name}.parquet")


def stored(frame: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read again: cuts the lineage and survives lost executors."""
    spark = frame.sparkSession
    path = work_path(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def remainder(identifier: Column, modulus: int) -> Column:
    """crc32 of the identifier as text, modulo a number: the split of rows into learned and held out."""
    return F.pmod(F.crc32(identifier.cast("string").cast("binary")), F.lit(modulus))


def thinned(frame: DataFrame, key: str, total: int, rows: int, salt: int = 0) -> DataFrame:
    """About `rows` of `total` rows, chosen by a hash of their key; all of them if there are no more."""
    if total <= rows:
        return frame
    return frame.where(F.pmod(F.xxhash64(F.lit(salt), F.col(key)), F.lit(1_000_000_007)) < int(rows / total * 1_000_000_007))


def beside(frame: DataFrame, text: str, fields: str, work: Callable[[Iterator[list]], Iterator[dict]], keep: list[str] | None = None) -> DataFrame:
    """Every row (or the columns `keep` of it) with new columns computed from its text.

    The row travels in a struct, so that columns of any name pass. `work` gets
    an iterator over lists of texts and yields a dict of columns for each list.
    The result has two columns, `row` and `made`, both structs.
    """
    spark = frame.sparkSession
    columns = frame.columns if keep is None else keep
    packed = frame.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(f"`{text}`").cast("string").alias("text"))
    made_type = T._parse_datatype_string(f"struct<{fields}>")
    schema = T.StructType([T.StructField("row", packed.schema["row"].dataType), T.StructField("made", made_type)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        arrow = to_arrow_type(made_type)
        held: list[pa.Array] = []

        def texts():
            for batch in batches:
                if batch.num_rows:
                    held.append(batch.column(0))
                    yield batch.column(1).to_pylist()

        for made in work(texts()):
            row = held.pop()
            arrays = [pa.array(made[f.name], type=f.type) for f in arrow]
            yield pa.RecordBatch.from_arrays([row, pa.StructArray.from_arrays(arrays, fields=list(arrow))], names=["row", "made"])

    return packed.mapInArrow(run, schema)


def _trim() -> None:
    """Give freed memory back to the system, where the C library can."""
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):
        return


_kept: dict[str, Callable[[], None]] = {}


def takes_over(owner: str, forget: Callable[[], None]) -> None:
    """Called where an operator fills memory that its process keeps: what other operators keep there is given up.

    Python workers are used again by later stages; without this each would hold the memories of all stages so far.
    """
    if owner not in _kept:
        for other in _kept.values():
            other()
        _kept.clear()
        _kept[owner] = forget
        pa.default_memory_pool().release_unused()
        _trim()


def text_blocks(texts: list[str | None], most: int = 1 << 20) -> Iterator[list[int]]:
    """Positions of the texts in blocks of at most `most` characters (a longer text stands alone)."""
    block, size = [], 0
    for i, text in enumerate(texts):
        n = len(text or "")
        if block and size + n > most:
            yield block
            block, size = [], 0
        block.append(i)
        size += n
    if block:
        yield block


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finalizer of a public mixer)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: A-Z to a-z on bytes, everything else unchanged.
LOWER_AZ = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words_of(text: str | None) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+` after A-Z to a-z, as UTF-8; bytes.split() cuts at exactly these six characters."""
    return (text or "").encode("utf-8", "surrogatepass").translate(LOWER_AZ).split()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); a component is called by its smallest node.

    Alternating large and small stars; every round is a shuffle by node with
    map-side minima, and its result is written to the shared folder. A node
    with very many neighbours is an ordinary skewed join, which adaptive
    execution splits. Rounds grow with the logarithm of the longest path.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    seen = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if not state[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        if state == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select(F.col("v"), F.col("v")).distinct())
        seen = state
        both = now.union(now.select(F.col("v"), F.col("u")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least).distinct()
        now = stored(small, "edges")


def blocks_for(rows: Column, size: int) -> Column:
    """How many blocks of at most `size` rows hold so many rows, one at least."""
    return F.greatest(F.lit(1), F.ceil(rows / F.lit(float(size)))).cast("int")

