"""Near-duplicate documents: fast similarity sketches, banding, exact verification.

A sketch has `coordinates` bins. In round i every shingle is hashed anew to one
bin and a value, and a bin keeps the smallest (round, value) it ever got; later
rounds run only while a document still has empty bins, and round
`coordinates + j` throws everything into bin j. So every coordinate is filled,
however small the set, and the share of equal coordinates of two sets is
concentrated around their Jaccard similarity as tightly as for independent
draws.

Documents with the same set of shingles are one class at once. Of each class
one document is compared further: bands of `ROWS` coordinates put it into
buckets, and documents of one bucket whose sketches are alike, with a margin of
seven standard deviations, belong to one family. Everybody in a bucket is
compared with the bucket's leader first; a second round has other leaders. Where
a bucket still holds more than one family, all its members of different families
are compared, in blocks of bounded size. A family is then settled in one place
on the full sets, which are computed again from its texts: blocks of bounded
size meet each other, and each meeting gives a spanning forest of its links. So
a text travels once for each meeting of its block, no pairs are listed, no
bucket or family is capped, and pairs already joined aren't compared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.llm.common import LOWER_AZ, blocks_for, connected_components, mix, prepare_llm, stored, takes_over, text_blocks

COORDINATES = 160
#: A pair at a similarity of 0.8 misses all 32 bands with probability (1 - 0.8**5)**32, 3e-6; at 0.85 with 8e-9.
ROWS = 5
#: Members of a bucket that one task compares with as many others.
BLOCK = 2048
#: Members of a family, and shingles on average, whose full sets one task compares with as many others.
FAMILY, SHINGLES = 2048, 1 << 20
#: Characters whose shingles are made at once; a longer text stands alone.
CHARACTERS = 1 << 18
#: Bits of the filter that keeps texts which need no full set out of the shuffle.
FILTER_BITS = 1 << 23

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_RANDOM = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_UNBASE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    takes_over("minhash", _powers.clear)
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(2 * CHARACTERS, n)
        ones = np.full(size, _BASE), np.full(size, _UNBASE)
        for a in ones:
            a[0] = 1
        _powers["up"], _powers["down"] = np.multiply.accumulate(ones[0]), np.multiply.accumulate(ones[1])
    return _powers["up"], _powers["down"]


def shingle_sets(texts: list[str | None], words: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the distinct shingles of all texts, text after text, and how many each has."""
    blobs = [(t or "").encode("utf-8", "surrogatepass").translate(LOWER_AZ) for t in texts]
    raw = np.frombuffer(b" " + b" ".join(blobs) + b" ", np.uint8)
    begins = np.cumsum([1] + [len(b) + 1 for b in blobs])
    space = _SPACE[raw]
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    up, down = _power(len(raw) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_RANDOM[raw] * up[: len(raw)])])
    word = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    owner = np.searchsorted(begins, starts, side="right") - 1
    counts = np.bincount(owner, minlength=len(texts)) if len(starts) else np.zeros(len(texts), np.int64)
    first = np.concatenate([[0], np.cumsum(counts)])
    n = len(word)
    value = np.zeros(max(0, n - words + 1), np.uint64)
    for j in range(words):
        value = mix(value * np.uint64(0x100000001B3) + word[j : j + len(value)] + np.uint64(1))
    of = owner[: len(value)]
    whole = of == owner[words - 1 :] if len(value) else np.zeros(0, bool)
    values, owners = [value[whole]], [of[whole]]
    for i in np.flatnonzero((counts > 0) & (counts < words)):  # fewer words than a shingle: the whole sequence
        h = np.zeros(1, np.uint64)
        for w in word[first[i] : first[i + 1]]:
            h = mix(h * np.uint64(0x100000001B3) + w + np.uint64(1))
        values.append(mix(h + counts[i : i + 1].astype(np.uint64)))
        owners.append(np.array([i]))
    value, of = np.concatenate(values), np.concatenate(owners)
    order = np.lexsort((value, of))
    value, of = value[order], of[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (of[1:] != of[:-1])
    return value[fresh], np.bincount(of[fresh], minlength=len(texts)).astype(np.int64)


def sketches(values: np.ndarray, counts: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """One row of coordinates for each set (sets of size 0 get a row of equal values)."""
    n = len(counts)
    out = np.full(n * coordinates, np.iinfo(np.uint64).max, np.uint64)
    owner = np.repeat(np.arange(n), counts)
    active = values
    for turn in range(2 * coordinates):
        if not len(active):
            break
        h = mix(active ^ mix(np.full(1, turn + 1, np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        bins = ((h >> np.uint64(40)) % np.uint64(coordinates)).astype(np.int64) if turn < coordinates else np.full(len(h), turn - coordinates)
        np.minimum.at(out, owner * coordinates + bins, (np.uint64(turn) << np.uint64(40)) | (h & np.uint64((1 << 40) - 1)))
        hollow = (out.reshape(n, coordinates) == np.iinfo(np.uint64).max).any(1)
        go = hollow[owner]
        active, owner = active[go], owner[go]
    return out.reshape(n, coordinates)


def band_keys(sketch: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """Hashes of the bands of `rows` coordinates."""
    bands = sketch.shape[1] // rows
    key = np.zeros((len(sketch), bands), np.uint64)
    for j in range(rows):
        key = mix(key * np.uint64(0x100000001B3) + sketch[:, j : bands * rows : rows])
    return mix(key + np.arange(bands, dtype=np.uint64))


def least_equal(percent: int, coordinates: int = COORDINATES) -> int:
    """Equal coordinates that a pair at the threshold has, but for seven standard deviations."""
    p = percent / 100
    return int(coordinates * p - 7 * (coordinates * p * (1 - p)) ** 0.5)


def fingerprints(values: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """Two sums over each set."""
    ends, marks = np.cumsum(counts), []
    for salt in (1, 2):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(values * np.uint64(2 * salt + 1) + np.uint64(salt)))])
        marks.append((sums[ends] - sums[ends - counts]).view(np.int64))
    return marks


def _sketched(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for block in text_blocks(texts, CHARACTERS):
                values, counts = shingle_sets([texts[i] for i in block], words)
                marks = fingerprints(values, counts)
                sketch = sketches(values, counts)
                keys = band_keys(sketch).view(np.int64)
                bands = pa.ListArray.from_arrays(pa.array(np.arange(len(block) + 1, dtype=np.int32) * keys.shape[1]), pa.array(keys.ravel()))
                short = [row.tobytes() for row in mix(sketch).astype(np.uint8)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(block)), pa.array(counts), pa.array(marks[0]), pa.array(marks[1]), bands, pa.array(short, pa.binary())], names=["id", "n", "mark", "mark2", "bands", "sketch"]
                )

    return run


def _rows_of(column: pa.Array | pa.ChunkedArray, rows: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(rows, -1)


def _alike(percent: int):
    """Pairs (a, b, na, nb, sa, sb) whose sizes and sketches are alike."""
    least = least_equal(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                na, nb = (batch.column(c).to_numpy() for c in ("na", "nb"))
                left, right = (_rows_of(batch.column(c), batch.num_rows) for c in ("sa", "sb"))
                yield batch.select(["a", "b"]).filter(pa.array((np.minimum(na, nb) * 100 >= np.maximum(na, nb) * percent) & ((left == right).sum(1) >= least)))

    return run


def forest(left: np.ndarray, right: np.ndarray, component: np.ndarray, linked: Callable[[int, np.ndarray], np.ndarray]) -> np.ndarray:
    """Links that join the components (which are renamed), one for each two that meet.

    Rows `left` meet rows `right`, which are the same or others; linked(i, rows) are those of the rows linked with i.
    """
    same, found = np.array_equal(left, right), [np.zeros((0, 2), np.int64)]
    for i in left:
        others = right[component[right] != component[i]]
        if same:
            others = others[others > i]
        if len(others):
            others = linked(i, others)
        if len(others):
            names, first = np.unique(component[others], return_index=True)
            found.append(np.stack([np.full(len(first), i), others[first]], 1))
            component[np.isin(component, names)] = component[i]
    return np.concatenate(found)


def _alike_rows(n: np.ndarray, sketch: np.ndarray, percent: int) -> Callable[[int, np.ndarray], np.ndarray]:
    least = least_equal(percent)

    def rows(i: int, others: np.ndarray) -> np.ndarray:
        others = others[np.minimum(n[others], n[i]) * 100 >= np.maximum(n[others], n[i]) * percent]
        return others[(sketch[others] == sketch[i]).sum(1) >= least]

    return rows


def _block_pairs(percent: int):
    """A forest of the families in one block (or between two blocks) of a bucket, by sketches."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids, n, component, block = (table.column(c).to_numpy() for c in ("id", "n", "component", "block"))
        sketch = _rows_of(table.column("sketch"), len(ids))
        left, right = (np.flatnonzero(block == table.column(c)[0].as_py()) for c in ("one", "two"))
        pairs = forest(left, right, component.copy(), _alike_rows(n, sketch, percent))
        return pa.table({"a": ids[pairs[:, 0]], "b": ids[pairs[:, 1]]})

    return run


def _links(words: int, percent: int):
    """A forest of the links in one block (or between two blocks) of a family, by full sets."""

    def run(table: pa.Table) -> pa.Table:
        texts, sets, sizes, marks = table.column("text").to_pylist(), [], [], []
        for at in text_blocks(texts, CHARACTERS):
            values, counts = shingle_sets([texts[i] for i in at], words)
            sets.append(values)
            sizes.append(counts)
            marks.append(np.stack([counts, *fingerprints(values, counts)]))
        table = table.drop_columns(["text"]).combine_chunks()
        n, marks, ids = np.concatenate(sizes), np.concatenate(marks, 1), table.column("id").to_numpy()
        # of rows that repeat an id one with the chosen set counts
        rows = np.flatnonzero((marks == np.stack([table.column(c).to_numpy() for c in ("n", "mark", "mark2")])).all(0))
        rows = rows[np.unique(ids[rows], return_index=True)[1]]
        known, flat = np.unique(np.concatenate(sets), return_inverse=True)
        begins = np.cumsum(n) - n
        block, sketch = table.column("block").to_numpy(), _rows_of(table.column("sketch"), len(ids))
        alike, own = _alike_rows(n, sketch, percent), np.zeros(len(known), np.uint8)

        def linked(i: int, others: np.ndarray) -> np.ndarray:
            others = alike(i, others)
            if not len(others):
                return others
            mine, many = flat[begins[i] : begins[i] + n[i]], n[others]
            stops = np.cumsum(many)
            own[mine] = 1
            common = np.add.reduceat(own[flat[np.repeat(begins[others] - stops + many, many) + np.arange(stops[-1])]], stops - many, dtype=np.int64)
            own[mine] = 0
            return others[100 * common >= percent * (n[i] + many - common)]

        left, right = (rows[block[rows] == table.column(c)[0].as_py()] for c in ("one", "two"))
        pairs = forest(left, right, np.arange(len(ids)), linked)
        return pa.table({"a": ids[pairs[:, 0]], "b": ids[pairs[:, 1]]})

    return run


def _perhaps(source: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of `source` whose id may be in `wanted`: a filter of fixed size that goes before a shuffle of texts."""
    slot = F.pmod(F.xxhash64(F.lit(5), "id"), F.lit(FILTER_BITS))
    words = wanted.select((slot / 64).cast("int").alias("word"), F.expr(f"shiftleft(1L, cast(pmod(pmod(xxhash64(5, id), {FILTER_BITS}), 64) as int))").alias("bit")).groupBy("word").agg(F.expr("bit_or(bit)").alias("bit")).toArrow()
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    bits[words.column("word").to_numpy()] = words.column("bit").to_numpy()
    shared = source.sparkSession.sparkContext.broadcast(bits.view(np.uint8))

    def may(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("slot").to_numpy(zero_copy_only=False)
            yield batch.select(["id", "text"]).filter(pa.array((shared.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)))

    return source.withColumn("slot", slot).mapInArrow(may, "id long, text string")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each doc_id: n_shingles, component_id (smallest reachable doc_id) and kept.

    Words are `[^\\x20\\x09-\\x0D]+` of the whole text after A-Z to a-z. Two documents are linked if
    100 * |intersection| >= percent * |union| of their sets of shingles of `words` words; a text with
    fewer words is one shingle, a text without words (or null) is linked with nothing. Rows that
    repeat a doc_id are taken together: the row with the largest text counts. Rows without a doc_id
    are left out. Needs percent >= 80, which the bands are laid out for.
    """
    if percent < 80:
        raise ValueError("the bands are laid out for a similarity of 0.8 or more")
    prepare_llm(docs.sparkSession)
    source = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text")).where("id is not null")
    made = source.mapInArrow(_sketched(words), "id long, n long, mark long, mark2 long, bands array<long>, sketch binary")
    sketched = stored(made, "sketches")
    ids = sketched.groupBy("id").agg(F.max(F.struct("n", "mark", "mark2")).alias("s")).select("id", "s.*")
    classes = stored(ids.where("n > 0").groupBy("n", "mark", "mark2").agg(F.min("id").alias("rep")), "classes")
    one_each = sketched.join(classes.withColumnRenamed("rep", "id"), ["id", "n", "mark", "mark2"], "left_semi").dropDuplicates(["id", "n", "mark", "mark2"])
    shown = stored(one_each, "shown")
    short = shown.select("id", "n", "sketch")
    banded = shown.select("id", F.explode("bands").alias("key"))
    leaders = banded.groupBy("key").agg(F.min("id").alias("leader"), F.max("id").alias("last")).where("leader < last").select("key", "leader")
    buckets = stored(banded.join(leaders, "key"), "buckets")

    def alike(pairs: DataFrame) -> DataFrame:
        one, two = (short.select(F.col("id").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"s{c}")) for c in "ab")
        return pairs.where("a <> b").distinct().join(one, "a").join(two, "b").mapInArrow(_alike(percent), "a long, b long")

    def unsettled(rows: DataFrame) -> DataFrame:
        named = rows.join(components.select(F.col("node").alias("id"), "component"), "id", "left").select("key", "id", F.coalesce("component", "id").alias("component"))
        several = named.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size")).where("low <> high")
        return stored(named.join(several.select("key", "size"), "key"), "unsettled")

    def meetings(rows: DataFrame, key: str, blocks: Column) -> DataFrame:
        dealt = rows.withColumn("block", F.pmod(F.xxhash64(F.lit(9), "id"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        both = dealt.withColumns({"one": F.least("block", "other").cast("int"), "two": F.greatest("block", "other").cast("int")})
        return both.drop("other").groupBy(key, "one", "two")

    components = stored(connected_components(alike(buckets.select(F.col("id").alias("a"), F.col("leader").alias("b")))), "components")
    left = unsettled(buckets)
    for final in (False, True):
        if left.isEmpty():
            break
        if final:
            near = meetings(left.join(short, "id"), "key", blocks_for(F.col("size"), BLOCK)).applyInArrow(_block_pairs(percent), "a long, b long")
        else:
            others = left.groupBy("key").agg(F.min(F.struct(F.xxhash64(F.lit(7), "id").alias("o"), "id")).alias("l")).select("key", F.col("l.id").alias("b"))
            near = alike(left.select("key", F.col("id").alias("a")).join(others, "key").select("a", "b"))
        components = stored(connected_components(components.select(F.col("node").alias("a"), F.col("component").alias("b")).union(near)), "components")
        left = left if final else unsettled(left.select("key", "id"))
    members = shown.drop("bands").join(components.select(F.col("node").alias("id"), F.col("component").alias("family")), "id")
    sizes = members.groupBy("family").agg(F.greatest(blocks_for(F.count("*"), FAMILY), blocks_for(F.sum("n"), SHINGLES)).alias("blocks"))
    members = stored(members.join(sizes, "family"), "members")
    read = _perhaps(source, members.select("id")).join(members, "id")
    links = meetings(read, "family", F.col("blocks")).applyInArrow(_links(words, percent), "a long, b long")
    found = connected_components(links)
    grouped = classes.join(found.select(F.col("node").alias("rep"), "component"), "rep", "left").select("n", "mark", "mark2", F.coalesce("component", "rep").alias("component"))
    joined = ids.join(grouped, ["n", "mark", "mark2"], "left")
    result = joined.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))
    return result.withColumn("kept", F.col("doc_id") == F.col("component_id"))
