"""Nearest neighbours by inner product: shifted Hilbert curves over projected vectors.

Vectors get one more component that makes all of them equally long, so that the
largest inner product is the smallest distance. Each curve projects them to a
few random directions, shifts the grid, and orders them by their Hilbert key.
Spark range-partitions the keys; a row's position on its curve is its place in
its partition plus the rows of all partitions before. Positions are cut into
blocks, a query is compared with its own block and the two beside it, exactly,
and the best over all curves are kept.

How long a block is, is measured and not guessed: for a bounded sample of
queries the true neighbours are found by a pass over all vectors, and the
shortest blocks are taken that would have found the wanted share of them. Where
nearness says little (random directions in many dimensions), blocks grow with
the table, without a bound; where it says much, they stay short. Long blocks are
compared in pieces, of the queries and of the candidates. Where the blocks of
all curves together would hold more rows than the table, every query is compared
with every row instead, once.

Equal vectors form one class, which is searched once and stands for its `k + 1`
smallest ids, so copies can't crowd out each other, and ties go to the smaller
id whatever the block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harborline.llm.common import blocks_for, prepare_llm, stored
from harborline.llm.vectors import matrix, usable

CURVES, DIRECTIONS, BITS = 8, 6, 8
SHORTEST = 1024
#: Candidates, and about so many queries, of one piece of a long block.
PIECE = 65_536
#: Queries whose true neighbours are looked up to choose the block length, and the share to be found.
SAMPLE, WANTED = 96, 0.95


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Positions on the Hilbert curve of points on a grid of 2**bits cells a side (bit-plane transform after Skilling)."""
    x = cells.astype(np.uint64).T.copy()
    n = len(x)
    one = np.uint64(1)
    for level in range(bits - 1, 0, -1):
        q, p = one << np.uint64(level), (one << np.uint64(level)) - one
        for i in range(n):
            high = (x[i] & q) != 0
            t = np.where(high, np.uint64(0), (x[0] ^ x[i]) & p)
            x[0] ^= np.where(high, p, t)
            if i:
                x[i] ^= t
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        q = one << np.uint64(level)
        t ^= np.where((x[n - 1] & q) != 0, q - one, np.uint64(0))
    x ^= t
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << one) | ((x[i] >> np.uint64(level)) & one)
    return key


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to the smaller id."""
    if len(scores) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= edge)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((ids[some], -scores[some]))[:k]]


def _compared(k: int):
    """Of one block, or one piece of it: for every query the k best candidates."""

    def run(table: pa.Table) -> pa.Table:
        role = table.column("asks").to_numpy()
        ids, vectors = table.column("class").to_numpy(), matrix(table.column("vector"))
        asking, held = np.flatnonzero(role), np.flatnonzero(~role)
        names, given = ids[held], vectors[held]
        out_q, out_c, out_s = [], [], []
        for at in range(0, len(asking), 128):
            some = asking[at : at + 128]
            scores, places = vectors[some] @ given.T, dict(zip(ids[some].tolist(), some))
            for row, q in zip(scores, ids[some]):
                best = _best(row, names, k)
                out_q.append(np.full(len(best), q))
                out_c.append(names[best])
                # the same sum, component after component, whatever the block
                out_s.append(np.add.accumulate(given[best] * vectors[places[q]], axis=1)[:, -1])
        join = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
        return pa.table({"query": join(out_q, np.int64), "class": join(out_c, np.int64), "score": join(out_s, np.float64)})

    return run


def search(rows: DataFrame, asks, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding", wanted: float = WANTED) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k nearest rows of every row that meets the condition `asks`.

    Nearness is the inner product in double precision of the vectors as they are. A row isn't its own
    neighbour. Vectors that are null, zero, of another length than the commonest, or hold null or
    non-finite components take no part, nor rows without an id. Rows that repeat an id count once for
    each of their vectors as candidates, with the best score. With fewer than k candidates all come.
    """
    spark = prepare_llm(rows.sparkSession)
    valid = usable(rows.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).alias("vector"), F.coalesce(asks, F.lit(False)).alias("asks")).where("id is not null"), "vector")
    first = Window.partitionBy("vector").orderBy("id")
    few = valid.select("id", "vector").distinct().withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
    classes = few.groupBy("vector").agg(F.min("id").alias("class"), F.sort_array(F.collect_list("id")).alias("ids"))
    # one vector can stand under a repeated id: the class then needs a name of its own
    classes = stored(classes, "classes")
    twice = classes.groupBy("class").agg(F.count("*").alias("n")).where("n > 1")
    if not twice.isEmpty():
        classes = stored(classes.withColumn("class", F.monotonically_increasing_id()), "classes")
    asked = stored(valid.where("asks").select("id", "vector").join(classes.select("vector", "class"), "vector").select("id", "class").distinct(), "asked")
    named = stored(classes.join(asked.select("class").distinct().withColumn("asks", F.lit(True)), "class", "left").withColumn("asks", F.coalesce("asks", F.lit(False))), "named")
    total = named.count()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    norms = named.select("vector").mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array((matrix(b.column(0)) ** 2).sum(1))], names=["n"]) for b in batches if b.num_rows), "n double")
    longest = float(norms.agg(F.max("n")).first()[0])
    width = len(named.select("vector").first()[0])
    rng = np.random.default_rng(11)
    turns = [np.linalg.qr(rng.normal(size=(width + 1, min(DIRECTIONS, width + 1))))[0] for _ in range(CURVES)]
    shifts = [rng.random(t.shape[1]) for t in turns]

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1))
            if not len(x):
                continue
            x = np.hstack([x, np.sqrt(np.maximum(0, longest - (x**2).sum(1)))[:, None]]) / np.sqrt(longest)
            # directions of random vectors spread as 1 / sqrt(width): use the grid where the points are
            scale = min(1.0, 4 / np.sqrt(width + 1))
            for curve in range(CURVES):
                at = (np.clip(x @ turns[curve], -scale, scale) / scale + 1) / 2
                cells = ((at + shifts[curve]) / 2 * ((1 << BITS) - 1)).astype(np.int64)
                key = hilbert_keys(np.clip(cells, 0, (1 << BITS) - 1), BITS).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.full(len(x), curve, np.int32)), pa.array(key)], names=["class", "curve", "key"])

    keys = named.select("class", "vector").mapInArrow(keyed, "class long, curve int, key long")
    ordered = stored(keys.repartitionByRange("curve", "key", "class").sortWithinPartitions("curve", "key", "class").select("class", "curve", F.monotonically_increasing_id().alias("place")), "curve")
    before, offsets = 0, []
    part = F.shiftrightunsigned("place", 33)
    for row in ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect():
        offsets.append((row["part"], before))
        before += row["n"]
    ahead = spark.createDataFrame(offsets, "part long, ahead long")
    positions = ordered.withColumn("part", part).join(F.broadcast(ahead), "part").select("class", "curve", (F.col("ahead") + F.col("place").bitwiseAND((1 << 33) - 1) - F.col("curve") * total).alias("at"))
    length = _block_length(named, positions, total, k, wanted)
    if length > PIECE and 3 * CURVES * length >= total:
        # one curve that is one block: all pairs, which are fewer than those of the blocks
        length, positions = total, positions.where("curve = 0")
    last, pieces = (total - 1) // length, -(-length // PIECE)
    inside = F.floor(F.pmod("at", F.lit(length)) / PIECE).cast("int")
    places = positions.groupBy("class").agg(F.collect_list(F.struct("curve", F.floor(F.col("at") / length).cast("long").alias("block"), inside.alias("piece"))).alias("places"))
    met = named.select("class", "vector", "asks").join(places, "class")
    held = met.select("class", "vector", F.lit(False).alias("asks"), F.explode("places").alias("p")).select("class", "vector", "asks", "p.curve", "p.block", "p.piece")
    beside = lambda p: F.transform(F.array(*[F.lit(d) for d in (-1, 0, 1)]), lambda d: F.struct(p["curve"].alias("curve"), (p["block"] + d).alias("block")))
    asking = met.where("asks").select("class", "vector", F.lit(True).alias("asks"), F.explode(F.flatten(F.transform("places", beside))).alias("p")).where(F.col("p.block").between(0, last)).select("class", "vector", "asks", "p.curve", "p.block")
    keys = ["curve", "block"]
    if pieces > 1:
        keys += ["piece", "share"]
        shares = stored(asking.groupBy("curve", "block").agg(blocks_for(F.count("*"), PIECE).alias("shares")), "shares")
        held = held.join(shares, ["curve", "block"]).withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
        asking = asking.join(shares, ["curve", "block"]).withColumn("share", F.pmod(F.xxhash64(F.lit(5), "class"), F.col("shares")).cast("int")).withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))))
    columns = ["class", "vector", "asks", *keys]
    dealt = held.select(columns).union(asking.select(columns))
    near = dealt.groupBy(*keys).applyInArrow(_compared(k + 1), "query long, class long, score double")
    pairs = near.groupBy("query", "class").agg(F.max("score").alias("score"))
    top = pairs.withColumn("n", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "class"))).where(F.col("n") <= k + 1)
    answers = top.select(F.col("query").alias("class"), F.col("class").alias("near"), "score").join(asked.withColumnRenamed("id", "query_id"), "class")
    found = answers.select("query_id", "near", "score").join(named.select(F.col("class").alias("near"), "ids"), "near").select("query_id", F.explode("ids").alias("vec_id"), "score").where("query_id <> vec_id")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return best.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _block_length(named: DataFrame, positions: DataFrame, total: int, k: int, wanted: float) -> int:
    """The shortest blocks that would have found the wanted share of a sample's true neighbours."""
    if total <= 2 * SHORTEST:
        return SHORTEST
    spark = named.sparkSession
    asked = named.where("asks").select("class", "vector")
    n = asked.count()
    if not n:
        return SHORTEST
    sample = asked.where(F.pmod(F.xxhash64(F.lit(1), "class"), F.lit(1_000_003)) < min(1.0, SAMPLE / n) * 1_000_003).orderBy("class").toArrow()
    if not sample.num_rows:
        return total
    shared = spark.sparkContext.broadcast((sample.column("class").to_numpy(), matrix(sample.column("vector"))))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, asks = shared.value
        kept = [(np.zeros(0, np.int64), np.zeros(0)) for _ in names]
        for batch in batches:
            ids, x = batch.column(0).to_numpy(zero_copy_only=False), matrix(batch.column(1))
            if len(ids):
                for i, row in enumerate(asks @ x.T):
                    all_ids, all_scores = np.concatenate([kept[i][0], ids]), np.concatenate([kept[i][1], row])
                    best = _best(all_scores, all_ids, k + 1)
                    kept[i] = all_ids[best], all_scores[best]
        for name, (ids, scores) in zip(names, kept):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), name)), pa.array(ids), pa.array(scores)], names=["query", "class", "score"])

    best = named.select("class", "vector").mapInArrow(exact, "query long, class long, score double")
    true = best.withColumn("n", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "class"))).where((F.col("n") <= k + 1) & (F.col("query") != F.col("class"))).select("query", "class")
    mine = positions.join(F.broadcast(spark.createDataFrame([(int(x),) for x in shared.value[0]], "query long")), F.col("class") == F.col("query")).select("query", "curve", F.col("at").alias("home"))
    pairs = stored(true.select("query", "class"), "true").join(positions, "class").join(mine, ["query", "curve"]).select("query", "class", "curve", "home", "at").toArrow()
    query, name, home, at = (pairs.column(c).to_numpy() for c in ("query", "class", "home", "at"))
    pair = np.unique(np.stack([query, name]), axis=1, return_inverse=True)[1].ravel()
    length = SHORTEST
    while length < total:
        hit = np.abs(home // length - at // length) <= 1
        if np.bincount(pair, hit).astype(bool).mean() >= wanted:
            break
        length = int(length * 1.25)
    return min(length, total)
