"""Packing by cutting-stock column generation.

Documents become runs of ids. Whole multiples of the sequence length are
sequences of their own; what remains of a document is shorter than a sequence
and is packed whole. Remainders fall into length classes (exact for short
ones, a few per cent wide for long ones), and the histogram of classes, whose
size doesn't depend on the data, is all that the driver sees. There a linear
program over patterns (how many pieces of each class share a sequence) is
solved by column generation: a knapsack by dynamic programming finds the next
pattern for the present prices. The uses are rounded down, what is left gets
the fullest patterns one by one, and every pattern takes the next ranks of its
classes.

In Spark a document's rank in its class (counts of classes by input partition,
summed up, and the place within the partition) gives its sequence. Gaps that
remain are filled exactly by some documents, chosen by a hash, that are cut
for it: the running totals of gaps and of these documents' tokens are matched
as intervals. What is over of them forms further sequences, the last ones of
a power of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harborline.llm.common import mix, prepare_llm, stored
from harborline.llm.word_ids import word_ids
from harborline.settings import work_path

LENGTH, END = 4096, 2
#: Classes are exact up to so many tokens, beyond that one in so many wide.
EXACT, STEP = 32, 32
#: Shares of the documents that can be chosen for cutting: multiples of 1 / BUCKETS.
BUCKETS = 256
#: Column generation ends within this factor of its lower bound, or after so many rounds; any round's patterns are a valid packing.
ENOUGH, ROUNDS = 1.001, 300
#: The greedy patterns take a piece's share of a sequence to this power for its value: of two fillings the one with fewer, longer pieces.
PREFER = 1.02
#: Rows of one running total's inner window, for sequences.
RUN = 4096

_TOKENS = "doc_id long, part int, place long, n long, last int, class int, bucket int, crcs array<long>, crc long, ids binary"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def class_tops(length: int = LENGTH) -> np.ndarray:
    """The longest remainder of each class, ascending; the last is length - 1."""
    tops = list(range(1, min(EXACT, length - 1) + 1))
    while tops and tops[-1] < length - 1:
        tops.append(min(length - 1, tops[-1] + max(1, tops[-1] // STEP)))
    return np.array(tops, np.int64)


def _tokenised(path: str, length: int, end: int, whole: bool):
    """Documents as runs of ids: checksums of their whole multiples and of the remainder, whose ids are kept (all, if `whole`)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, place, tops = word_ids(path), TaskContext.get().partitionId(), 0, class_tops(length)
        last_id = np.array([end], "<u4").tobytes()
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.int64(), pa.binary()]
        names = [c.split()[0] for c in _TOKENS.split(", ")]
        for batch in batches:
            made = [ids + last_id for ids in encode.encode(batch.column(1).to_pylist())]
            count = np.array([len(x) // 4 for x in made], np.int64)
            rest = count % length
            places = np.arange(place, place + len(made))
            place += len(made)
            with np.errstate(over="ignore"):
                bucket = mix((places + 1).astype(np.uint64) * np.uint64(1 << 20) + np.uint64(part)) % np.uint64(BUCKETS)
            cut = (4 * (count - rest)).tolist()
            crcs = [[zlib.crc32(x[a : a + 4 * length]) for a in range(0, c, 4 * length)] for x, c in zip(made, cut)]
            tail = [x[c:] for x, c in zip(made, cut)]
            columns = [batch.column(0), np.full(len(made), part), places, count, rest, np.searchsorted(tops, rest), bucket.astype(np.int32), crcs, [zlib.crc32(t) for t in tail], made if whole else tail]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return run


def knapsack(tops: np.ndarray, values: np.ndarray, most: np.ndarray, length: int) -> tuple[float, np.ndarray]:
    """The best value of pieces in one sequence, and how many of each class: counts in binary steps, all fillings at once."""
    best = np.zeros(length + 1)
    taken = []
    for c in np.flatnonzero((values > 1e-12) & (most > 0)):
        left, step = int(most[c]), 1
        while left > 0:
            k = min(step, left)
            size = int(tops[c]) * k
            if size > length:
                break
            new = best[: length + 1 - size] + values[c] * k
            better = new > best[size:] + 1e-12
            np.copyto(best[size:], new, where=better)
            taken.append((c, k, size, better))
            left, step = left - k, 2 * step
    pattern, at = np.zeros(len(tops), np.int64), length
    for c, k, size, better in reversed(taken):
        if at >= size and better[at - size]:
            pattern[c] += k
            at -= size
    return float(best[length]), pattern


def _start(sizes: np.ndarray, need: np.ndarray, length: int) -> np.ndarray:
    """A basis of patterns, greedily: each of the fullest pattern of what is left, used until a class is met.

    Later patterns leave the classes out that are met, so the columns are triangular.
    """
    most, rest = length // sizes, need.copy()
    values = (sizes / length) ** PREFER
    basis = np.zeros((len(sizes), len(sizes)))
    while (rest > 1e-9).any():
        pattern = knapsack(sizes, np.where(rest > 1e-9, values, 0), np.minimum(most, np.ceil(rest)).astype(np.int64), length)[1]
        uses = np.where(pattern > 0, rest / np.maximum(pattern, 1), np.inf)
        met = int(np.argmin(uses))
        basis[:, met] = pattern
        rest -= pattern * uses[met]
        rest[met] = 0
    alone = np.flatnonzero(basis.sum(0) == 0)  # met together with another class
    basis[alone, alone] = most[alone]
    return basis


def relaxed(sizes: np.ndarray, need: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, float]:
    """Patterns (columns) and their fractional uses that meet every need, and a lower bound on the sum of uses: a revised simplex with column generation."""
    most = length // sizes
    basis = _start(sizes, need, length)
    inverse = np.linalg.inv(basis)
    bound = float(need @ sizes) / length
    for turn in range(1, ROUNDS + 1):
        if turn % 50 == 0:
            inverse = np.linalg.inv(basis)
        prices, level = np.maximum(inverse.sum(0), 0), inverse @ need
        value, pattern = knapsack(sizes, prices, most, length)
        bound = max(bound, float(prices @ need) / value)  # prices / value are feasible for the dual
        if level.sum() <= ENOUGH * bound or value <= 1 + 1e-7:
            break
        enter = inverse @ pattern
        ratio = np.where(enter > 1e-9, np.maximum(level, 0) / np.where(enter > 1e-9, enter, 1), np.inf)
        leave = int(np.argmin(ratio))
        if not np.isfinite(ratio[leave]):
            break
        basis[:, leave] = pattern
        row = inverse[leave] / enter[leave]
        inverse -= np.outer(enter, row)
        inverse[leave] = row
    return basis, np.maximum(np.linalg.solve(basis, need), 0), bound


def solve(tops: np.ndarray, demand: np.ndarray, length: int = LENGTH) -> list[tuple[np.ndarray, int]]:
    """Patterns and how often each is used, so that every class's demand is met exactly: the linear program rounded down, then the fullest patterns of what is left."""
    used = np.flatnonzero(demand)
    chosen: list[tuple[np.ndarray, int]] = []
    rest = demand.astype(np.int64).copy()

    def take(pattern: np.ndarray, times: int) -> None:
        times = min([times, *(rest[pattern > 0] // pattern[pattern > 0]).tolist()])
        if times > 0 and pattern.any():
            chosen.append((pattern, times))
            rest[:] -= pattern * times

    if len(used):
        basis, uses, _ = relaxed(tops[used], demand[used].astype(float), length)
        for column, x in zip(basis.T, np.floor(uses + 1e-6).astype(np.int64).tolist()):
            pattern = np.zeros(len(tops), np.int64)
            pattern[used] = np.rint(column)
            take(pattern, x)
    while rest.any():
        pattern = knapsack(tops, (tops / length) ** PREFER, np.minimum(rest, length // tops), length)[1]
        take(pattern, int(rest.max()))
    return chosen


def plan(counts: np.ndarray, tokens: np.ndarray, length: int = LENGTH) -> tuple[int, list[tuple[np.ndarray, int]]]:
    """How many buckets of documents are cut to fill gaps, and the patterns of the others.

    counts, tokens: by bucket and class. Tried first with the gaps that the width of the classes makes, then
    with more and more, until the tokens of the cut documents fill every gap; with all buckets cut there are
    no gaps.
    """
    tops, total, step = class_tops(length), int(tokens.sum()), 1
    wide = int((counts @ tops).sum())
    buckets = -(-len(counts) * (wide - total) // wide) if wide > total else 0
    while True:
        patterns = solve(tops, counts[buckets:].sum(0), length)
        gaps = length * sum(x for _, x in patterns) - int(tokens[buckets:].sum())
        lacking = gaps - int(tokens[:buckets].sum())
        if lacking <= 0:
            return buckets, patterns
        step = max(2 * step, int(len(counts) * lacking / (total + gaps)))
        buckets = min(len(counts), buckets + step)


def _slots(patterns: list[tuple[np.ndarray, int]]) -> list[tuple[int, int, int, int, int]]:
    """(class, first rank, behind the last, ranks a sequence, first sequence) for every class of every pattern."""
    ranks, sequence, rows = {}, 0, []
    for pattern, x in patterns:
        for c in np.flatnonzero(pattern).tolist():
            first = ranks.get(c, 0)
            ranks[c] = first + int(pattern[c]) * x
            rows.append((c, first, ranks[c], int(pattern[c]), sequence))
        sequence += x
    return rows


def _before(frame: DataFrame, part: str, place: str, value: str, by: list[str] | None = None) -> DataFrame:
    """With `before`: the sum of `value` over all earlier rows (of the same `by`), in order of part and place.

    One window inside each part, one over the parts' totals (a row each), and a join: no task holds more than a part.
    """
    by = by or []
    ahead = (Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(value).over(Window.partitionBy(*by, part).orderBy(place).rowsBetween(*ahead)), F.lit(0))
    totals = frame.groupBy(*by, part).agg(F.sum(value).alias("total"))
    summed = totals.withColumn("ahead", F.coalesce(F.sum("total").over(Window.partitionBy(*by).orderBy(part).rowsBetween(*ahead)), F.lit(0))).drop("total")
    return frame.withColumn("inside", inside).join(summed, [*by, part]).withColumn("before", F.col("ahead") + F.col("inside")).drop("ahead", "inside")


def powers(tokens: int, length: int) -> list[int]:
    """A number below `length` as powers of two, largest first."""
    return [1 << k for k in range(length.bit_length(), -1, -1) if tokens >> k & 1]


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, end: int = END, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces (PIECES) of all documents in sequences of at most `length` tokens; with_ids adds each piece's `ids` (little-endian 32-bit).

    A document is its text's ids and `end`; a null or empty text is `end` alone. Its pieces cover its ids
    once, its whole multiples of `length` are sequences of their own. Sequences are full, or of a power of
    two where the length is none, so nothing is padded. Rows with a null or repeated doc_id are documents of
    their own, under that id. Columns of other names are not looked at. An empty table gives no pieces.
    """
    spark = prepare_llm(docs.sparkSession)
    if length < 2:
        raise ValueError("a sequence needs two tokens at least")
    path = work_path(spark, "packing-tokens")
    source = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    source.mapInArrow(_tokenised(tokenizer, length, end, with_ids), _TOKENS).write.option("compression", "zstd").parquet(path)
    tokens = spark.read.schema(_TOKENS).parquet(path)
    remainders = tokens.where("last > 0")
    tops = class_tops(length)
    counts, sums = (np.zeros((BUCKETS, len(tops)), np.int64) for _ in range(2))
    # BUCKETS x classes rows at most, whatever the data
    for row in remainders.groupBy("bucket", "class").agg(F.count("*").alias("n"), F.sum("last").alias("tokens")).toArrow().to_pylist():
        counts[row["bucket"], row["class"]], sums[row["bucket"], row["class"]] = row["n"], row["tokens"]
    buckets, patterns = plan(counts, sums, length)
    sequences = sum(x for _, x in patterns)
    gaps = length * sequences - int(sums[buckets:].sum())
    over = int(sums[:buckets].sum()) - gaps
    extra = ["ids"] if with_ids else []
    tail = F.substring("ids", 4 * (F.col("n") - F.col("last")) + 1, 4 * F.col("last").cast("long")) if with_ids else F.col("ids")
    bare = ["doc_id", "part", "place", "n", "last"]

    # remainders that stay whole: rank in their class, sequence by rank, offset by the lengths before
    whole = remainders.where(F.col("bucket") >= buckets).select(*bare, "class", "crc", F.lit(1).cast("long").alias("one"), *([tail.alias("ids")] if with_ids else []))
    slots = spark.createDataFrame(_slots(patterns), "slot int, first long, stop long, each long, base long")
    ranked = _before(whole, "part", "place", "one", ["class"])
    placed = ranked.join(F.broadcast(slots), (F.col("class") == F.col("slot")) & (F.col("before") >= F.col("first")) & (F.col("before") < F.col("stop")))
    placed = placed.withColumn("sequence_id", F.col("base") + F.floor((F.col("before") - F.col("first")) / F.col("each")).cast("long"))
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("class"), "before").rowsBetween(Window.unboundedPreceding, -1)
    placed = stored(placed.select(*bare, "crc", "sequence_id", F.coalesce(F.sum("last").over(inside), F.lit(0)).cast("long").alias("offset"), *extra), "packing-placed")
    pieces = placed.select("doc_id", (F.col("n") - F.col("last")).alias("start"), F.col("last").cast("long").alias("length"), F.col("crc").alias("ids_crc32"), F.col("n").alias("doc_tokens"), "sequence_id", "offset", *extra)

    # gaps of those sequences, then further sequences: places for the documents that are cut
    filled = placed.groupBy("sequence_id").agg(F.sum("last").alias("filled")).select("sequence_id", "filled", (F.lit(length) - F.col("filled")).alias("gap"), F.floor(F.col("sequence_id") / RUN).alias("run")).where("gap > 0")
    room = _before(filled, "run", "sequence_id", "gap").select("sequence_id", "filled", "before", "gap")
    full, ends = over // length, powers(over % length, length)
    new = spark.range(full).select((F.col("id") + sequences).alias("sequence_id"), F.lit(0).cast("long").alias("filled"), (F.col("id") * length + gaps).alias("before"), F.lit(length).cast("long").alias("gap"))
    small = [(sequences + full + i, 0, gaps + full * length + sum(ends[:i]), x) for i, x in enumerate(ends)]
    room = room.unionByName(new).unionByName(spark.createDataFrame(small, "sequence_id long, filled long, before long, gap long"))
    cut = remainders.where(F.col("bucket") < buckets)
    pieces = pieces.unionByName(_filled(cut.select(*bare, tail.alias("ids")), room, length, with_ids))

    # whole multiples of the length
    many = _before(tokens.where(F.size("crcs") > 0).withColumn("many", F.size("crcs").cast("long")).select("doc_id", "part", "place", "n", "many", "crcs", *extra), "part", "place", "many")
    number = F.col("i").cast("long")
    alone = many.select("*", F.posexplode("crcs").alias("i", "ids_crc32")).select(
        "doc_id", (number * length).alias("start"), F.lit(length).cast("long").alias("length"), "ids_crc32", F.col("n").alias("doc_tokens"),
        (F.col("before") + number + sequences + full + len(ends)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
        *([F.substring("ids", 4 * length * number + 1, F.lit(4 * length)).alias("ids")] if with_ids else []),
    )
    return pieces.unionByName(alone)


def _filled(cut: DataFrame, room: DataFrame, length: int, with_ids: bool) -> DataFrame:
    """Pieces of the documents that are cut: their running tokens against the running room of the sequences.

    Both are intervals no longer than a sequence on one line; they meet in cells of that length, and a
    pair counts in the cell where its common part begins.
    """
    line = _before(cut.select("part", "place", "last"), "part", "place", "last")
    cells = lambda frame, size, name: frame.withColumn("cell", F.explode(F.sequence(F.floor(F.col("before") / length), F.floor((F.col("before") + F.col(size) - 1) / length)))).withColumnRenamed("before", name)
    a, b = cells(line, "last", "own"), cells(room, "gap", "free")
    start, stop = F.greatest("own", "free"), F.least(F.col("own") + F.col("last"), F.col("free") + F.col("gap"))
    met = a.join(b, "cell").where((start < stop) & (F.floor(start / length) == F.col("cell")))
    spans = met.select("part", "place", F.struct((start - F.col("own")).alias("at"), (stop - start).alias("length"), "sequence_id", (F.col("filled") + start - F.col("free")).alias("offset")).alias("span"))
    dealt = spans.groupBy("part", "place").agg(F.sort_array(F.collect_list("span")).alias("spans"))  # a span a token at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in PIECES.split(", ")] + ["ids"] * with_ids
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                for span in row["spans"]:
                    ids = row["ids"][4 * span["at"] : 4 * (span["at"] + span["length"])]
                    rows.append((row["doc_id"], row["n"] - row["last"] + span["at"], span["length"], zlib.crc32(ids), row["n"], span["sequence_id"], span["offset"], ids))
            columns = list(zip(*rows)) if rows else [()] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if name == "ids" else pa.int64()) for c, name in zip(columns, names)], names=names)

    return cut.join(dealt, ["part", "place"]).select("doc_id", "n", "last", "ids", "spans").mapInArrow(run, PIECES + ", ids binary" * with_ids)


def sequences(pieces: DataFrame, length: int = LENGTH, pad: int = 0) -> DataFrame:
    """sequence_id, ids (array), n_tokens: the sequences of pieces with ids, padded to `length` unless of a power of two."""
    unpacked = pieces.select("sequence_id", F.struct("offset", "ids").alias("piece"))
    joined = unpacked.groupBy("sequence_id").agg(F.sort_array(F.collect_list("piece")).alias("pieces"))  # `length` pieces at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, sizes = [], []
            for some in batch.column(1).to_pylist():
                ids = np.frombuffer(b"".join(p["ids"] for p in some), "<u4").astype(np.int64)
                sizes.append(len(ids))
                made.append(ids if len(ids) & (len(ids) - 1) == 0 else np.pad(ids, (0, length - len(ids)), constant_values=pad))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.list_(pa.int64())), pa.array(sizes, pa.int64())], names=["sequence_id", "ids", "n_tokens"])

    return joined.mapInArrow(run, "sequence_id long, ids array<long>, n_tokens long")
