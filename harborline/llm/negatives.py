"""Hard negatives by Four-Russians scoring of quantised vectors.

Components become integers. For every group of eight dimensions an anchor gets
a table of its 256 subset sums. Candidates are packed as bit planes: bit k of
eight neighbouring components is one byte. A byte looked up in the anchor's
table is the inner product of that plane and group; planes are added by
shifting (the top plane, the sign, counts negative), so a score is exact.

Anchors (a stated set) meet all candidates in blocks: a block of anchors and a
block of candidates are one row each, joined by the number of the candidate
block, and a task holds one pair of blocks. The first pass finds each anchor's
positives among blocks of its own label, the second, with the positives'
scores as windows, the negatives among all blocks. A label with very many rows
has more blocks, nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborline.llm.common import blocks_for, prepare_llm, stored

#: Rows of a block of candidates and of a block of anchors; candidates scored at once.
CANDIDATES, ANCHORS, SLICE = 1024, 256, 512
#: Labels are dealt to so many groups of blocks at most.
GROUPS = 64
_BLOCK = "names array<long>, ids array<long>, labels array<string>, values binary"


def bit_planes(values: np.ndarray) -> np.ndarray:
    """(planes, groups of eight dimensions, rows) bytes of a matrix of integers, lowest plane first, the sign's last."""
    low, high = (int(values.min()), int(values.max())) if values.size else (0, 0)
    planes = 1 + max(high.bit_length(), (-low - 1).bit_length() if low < 0 else 0)
    rows, width = values.shape
    padded = np.zeros((rows, -(-width // 8) * 8), np.int64)
    padded[:, :width] = values
    bits = ((padded[None] >> np.arange(planes)[:, None, None]) & 1).astype(np.uint8)
    return np.packbits(bits.reshape(planes, rows, -1, 8), axis=-1, bitorder="little")[..., 0].transpose(0, 2, 1).copy()


def subset_sums(anchors: np.ndarray, kind: type = np.int64) -> np.ndarray:
    """(groups, 256, anchors): sums of every subset of eight neighbouring components, each from one with a member less."""
    rows, width = anchors.shape
    padded = np.zeros((rows, -(-width // 8) * 8), kind)
    padded[:, :width] = anchors
    groups = padded.reshape(rows, -1, 8).transpose(1, 2, 0)
    sums = np.zeros((groups.shape[0], 256, rows), kind)
    for bit in range(8):
        sums[:, 1 << bit : 2 << bit] = sums[:, : 1 << bit] + groups[:, bit][:, None]
    return sums


def scores(planes: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """(rows, anchors) exact inner products, plane by plane from the sign down."""
    total = None
    for k in range(len(planes) - 1, -1, -1):
        plane = sums[0][planes[k, 0]]
        for group in range(1, len(sums)):
            plane += sums[group][planes[k, group]]
        if total is None:
            total = -plane
        else:
            total <<= 1
            total += plane
    return total


def _kind(anchors: np.ndarray, planes: int) -> type:
    """The narrowest integers that hold every sum on the way."""
    return np.int32 if anchors.shape[1] * (int(np.abs(anchors).max()) + 1 << planes) < 1 << 30 else np.int64


def _packed(rows: DataFrame, block: str, planes: bool = False) -> DataFrame:
    """One row a block, in order of ids: names, ids, labels, and the values as little-endian 64-bit integers or as bit planes."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("id", "ascending"), ("name", "ascending")])
        values = pa.concat_arrays(table.column("q").chunks).flatten().to_numpy(zero_copy_only=False).astype("<i8").reshape(table.num_rows, -1)
        columns = [[table.column(block)[0].as_py()], *([table.column(c).to_pylist()] for c in ("name", "id", "label")), [(bit_planes(values) if planes else values).tobytes()]]
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string()), pa.binary()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=[block, "names", "ids", "labels", "values"])

    return rows.select(block, "name", "id", "label", "q").groupBy(block).applyInArrow(run, f"{block} long, {_BLOCK}")


def _met(anchors: DataFrame, candidates: DataFrame, found, kinds: str, tasks: int) -> DataFrame:
    """Every block of anchors with each block of candidates named in its column `with`: what `found` makes of the pair.

    The pairs are joined by the number of the candidates' block. `found` gets
    the two blocks and the scores of all candidates (rows) with all anchors.
    """
    dealt = anchors.select(F.explode("with").alias("block"), *[F.col(c).alias(f"a_{c}") for c in anchors.columns if c != "with"]).repartition(tasks, "block")
    pairs = dealt.join(candidates.repartition(tasks, "block"), "block")
    names = [c.split()[0] for c in kinds.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                pair = {c: batch.column(j)[i].as_py() for j, c in enumerate(batch.schema.names)}
                a = np.frombuffer(pair["a_values"], "<i8").reshape(len(pair["a_names"]), -1)
                groups, rows = -(-a.shape[1] // 8), len(pair["names"])
                planes = np.frombuffer(pair["values"], np.uint8).reshape(-1, groups, rows)
                sums = subset_sums(a, _kind(a, len(planes)))
                table = np.concatenate([scores(planes[:, :, at : at + SLICE], sums) for at in range(0, rows, SLICE)])
                out = found(pair, table.astype(np.int64))
                if len(out[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=names)

    return pairs.mapInArrow(run, kinds)


def _first(score: np.ndarray, ids: np.ndarray, names: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties by id, then name."""
    if len(score) > k:
        some = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    else:
        some = np.arange(len(score))
    return some[np.lexsort((names[some], ids[some], -score[some]))[:k]]


def _positives(k: int):
    def found(pair: dict, table: np.ndarray) -> list[np.ndarray]:
        names, ids = np.array(pair["names"]), np.array(pair["ids"])
        labels, out = np.array(pair["labels"]), [[], [], [], []]
        for i, (name, label) in enumerate(zip(pair["a_names"], pair["a_labels"])):
            same = np.flatnonzero((labels == label) & (names != name))
            best = same[_first(table[same, i], ids[same], names[same], k)]
            for column, value in zip(out, (np.full(len(best), name), names[best], ids[best], table[best, i])):
                column.append(value)
        return [np.concatenate(x) for x in out]

    return found


def _negatives(k: int, low: int, high: int):
    def found(pair: dict, table: np.ndarray) -> list[np.ndarray]:
        names, ids = np.array(pair["names"]), np.array(pair["ids"])
        labels, out = np.array(pair["labels"]), [[], [], [], [], []]
        for i, (name, label, windows) in enumerate(zip(pair["a_names"], pair["a_labels"], pair["a_windows"])):
            # low * p <= 100 * n <= high * p, in exact integers
            ends = [(p, -(-low * p // 100), high * p // 100) for p in windows or []]
            ends = [(p, a, b) for p, a, b in ends if a <= b]
            if not ends:
                continue
            column = table[:, i]
            some = np.flatnonzero((column >= min(a for _, a, _ in ends)) & (column <= max(b for _, _, b in ends)) & (labels != label))
            some = some[np.lexsort((names[some], ids[some], -column[some]))]
            ranked = -column[some]
            for p, a, b in ends:
                at = int(np.searchsorted(ranked, -b))
                best = some[at : min(at + k, int(np.searchsorted(ranked, -a, "right")))]
                for held, value in zip(out, (np.full(len(best), name), np.full(len(best), p), names[best], ids[best], column[best])):
                    held.append(value)
        return [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out]

    return found


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component, x in double precision."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))


def mine(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Scores are integer inner products of floor(scale * x). Every row that meets the condition `anchors` is
    an anchor. Its positives are the first rows of its own label (higher scores first, ties by smaller id),
    its negatives, for each positive, the first rows of other labels with
    low * positive_score <= 100 * negative_score <= high * positive_score. With fewer, all come.

    Rows with a null id or label, and vectors that are null, empty, of another length than the commonest,
    or hold null or non-finite components take no part; zero vectors do. Nor do vectors with a component so
    large that a score could leave 64 bits (2^31 / sqrt(width) after scaling, in magnitude). Rows that
    repeat an id are rows of their own, also for each other: an anchor can have its own id as a positive.
    Columns of other names are not looked at.
    """
    spark = prepare_llm(rows.sparkSession)
    usable = _usable(rows.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{label}`").cast("string").alias("label"), F.col(f"`{vector}`").alias("vector"), F.coalesce(anchors, F.lit(False)).alias("asks")), scale)
    held = stored(usable.withColumn("name", F.monotonically_increasing_id()).withColumn("group", F.pmod(F.xxhash64("label"), F.lit(GROUPS)).cast("int")), "quantised")
    counts = held.groupBy("group").agg(F.count("*").alias("n"), F.count_if("asks").alias("asking")).orderBy("group").collect()
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not any(r["asking"] for r in counts):
        return spark.createDataFrame([], schema)
    # blocks of candidates are numbered through, group after group
    spans, before = [], 0
    for r in counts:
        blocks = -(-r["n"] // CANDIDATES)
        spans.append((r["group"], before, blocks, -(-r["asking"] // ANCHORS)))
        before += blocks
    tasks = min(before, int(spark.conf.get("spark.sql.shuffle.partitions")))
    span = F.broadcast(spark.createDataFrame(spans, "group int, first long, blocks long, askers long"))  # GROUPS rows at most
    dealt = held.join(span, "group")
    spread = lambda seed, n: F.pmod(F.xxhash64(F.lit(seed), "name"), n)
    candidates = stored(_packed(dealt.withColumn("block", F.col("first") + spread(1, F.col("blocks"))), "block", planes=True), "candidates")
    asking = dealt.where("asks")
    own = _packed(asking.withColumn("ab", F.col("group") * F.lit(1 << 40) + spread(2, F.col("askers"))), "ab")
    own = own.withColumn("group", F.floor(F.col("ab") / F.lit(1 << 40)).cast("int")).join(span, "group").select("names", "labels", "values", F.sequence(F.col("first"), F.col("first") + F.col("blocks") - 1).alias("with"))
    near = _met(own, candidates.select("block", "names", "ids", "labels", "values"), _positives(positives), "anchor long, positive long, positive_id long, positive_score long", tasks)
    order = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id", "positive")
    best = stored(near.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives), "positives")
    windows = best.groupBy("anchor").agg(F.sort_array(F.collect_set("positive_score")).alias("windows"))
    numbers = blocks_for(F.lit(sum(r["asking"] for r in counts)), ANCHORS)
    # windows are small and travel beside the blocks, keyed like the anchors
    ranged = asking.join(windows.withColumnRenamed("anchor", "name"), "name").withColumn("ab", spread(3, numbers).cast("long"))
    blocks = _packed(ranged, "ab").join(_windows(ranged), "ab").select("names", "labels", "values", "windows", F.sequence(F.lit(0).cast("long"), F.lit(before - 1).cast("long")).alias("with"))
    far = _met(blocks, candidates.select("block", "names", "ids", "labels", "values"), _negatives(negatives, low, high), "anchor long, positive_score long, negative long, negative_id long, negative_score long", tasks)
    order = Window.partitionBy("anchor", "positive_score").orderBy(F.desc("negative_score"), "negative_id", "negative")
    ranked = far.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    answers = best.join(ranked, ["anchor", "positive_score"]).join(asking.select(F.col("name").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
    return answers.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def _windows(ranged: DataFrame) -> DataFrame:
    """The windows of a block's anchors, in the order of `_packed`."""
    entry = F.struct("id", "name", "windows")
    return ranged.groupBy("ab").agg(F.transform(F.sort_array(F.collect_list(entry)), lambda e: e["windows"]).alias("windows"))


def _usable(rows: DataFrame, scale: int) -> DataFrame:
    """id, label, asks and the quantised vector of the rows that take part."""
    v = F.col("vector")
    good = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))))
    most = float(1 << 31) / F.sqrt(F.size(v).cast("double"))
    good = good.where(F.forall(v, lambda x: F.abs(x.cast("double") * F.lit(float(scale))) < most - 1))
    size = good.groupBy(F.size(v).alias("width")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "width").limit(1).collect()
    return good.where(F.size(v) == (size[0]["width"] if size else 0)).select("id", "label", "asks", quantised(v, scale).alias("q"))

