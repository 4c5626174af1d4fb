"""Near-duplicate vectors with a forest of random-projection trees.

Every tree splits recursively at the median of a random direction, the same
direction for all nodes of a level. Rows within `spill` of a split go to both
sides, so a close pair is seldom torn apart, and hardly ever in every tree.
Splits are fitted on a bounded sample, until the leaves of the whole table are
small; every row is put into the leaves of every tree.

Rows meet in leaves, by label. A leaf with many rows is cut into blocks of
bounded size, and every pair of its blocks is one unit of work, so that no group
is too large for a task. Pairs are verified by their exact cosine. A pair that
meets in several leaves counts in the first leaf both share, so links are
counted without listing them; for the components a block hands on a spanning
forest of its links only.

Equal vectors of a label are one class at once: it is compared once and counts
as often as it has rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.llm.common import blocks_for, connected_components, prepare_llm, stored
from harborline.llm.vectors import matrix, usable

TREES, LEAF, BLOCK, SPILL = 6, 512, 512, 0.025
#: Vectors that the splits are fitted on, and levels of a tree at most.
SAMPLE, LEVELS = 16_384, 12


class Trees:
    """Directions by tree and level, and a threshold for every inner node (numbered as in a heap)."""

    def __init__(self, sample: np.ndarray, levels: int, trees: int = TREES):
        rng = np.random.default_rng(23)
        width = sample.shape[1]
        self.levels, self.trees = levels, trees
        self.directions = rng.normal(size=(trees, levels, width))
        self.directions /= np.maximum(1e-12, np.linalg.norm(self.directions, axis=2, keepdims=True))
        self.thresholds = np.zeros((trees, 1 << levels))
        for tree in range(trees):
            nodes = {1: np.arange(len(sample))}
            for level in range(levels):
                along = sample @ self.directions[tree, level]
                below = {}
                for node, rows in nodes.items():
                    cut = float(np.median(along[rows])) if len(rows) else 0.0
                    self.thresholds[tree, node] = cut
                    low = along[rows] < cut
                    below[2 * node], below[2 * node + 1] = rows[low], rows[~low]
                nodes = below

    def leaves(self, x: np.ndarray, spill: float = SPILL) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of every leaf of every tree a row belongs to; leaf numbers of later trees are larger."""
        rows_out, leaves_out = [], []
        for tree in range(self.trees):
            row, node = np.arange(len(x)), np.ones(len(x), np.int64)
            for level in range(self.levels):
                away = (x @ self.directions[tree, level])[row] - self.thresholds[tree, node]
                left, right = away < spill, away >= -spill
                row = np.concatenate([row[left], row[right]])
                node = np.concatenate([2 * node[left], 2 * node[right] + 1])
            rows_out.append(row)
            leaves_out.append(node + (tree << (self.levels + 1)))
        return np.concatenate(rows_out), np.concatenate(leaves_out)


def _first_shared(ids: list[np.ndarray], left: np.ndarray, right: np.ndarray, leaf: int) -> np.ndarray:
    """For each pair of rows whether they share no leaf before this one; ids: each row's leaves."""
    both = np.unique(np.concatenate([left, right]))
    before = [ids[i][ids[i] < leaf] for i in both]
    names, counts = np.unique(np.concatenate([np.zeros(0, np.int64), *before]), return_counts=True)
    names = names[counts > 1]
    if not len(names):
        return np.ones(len(left), bool)
    place = np.zeros(int(both.max()) + 1, np.int64)
    place[both] = np.arange(len(both))
    member = np.zeros((len(both), len(names)), np.float32)
    for row, some in enumerate(before):
        at = np.searchsorted(names, some)
        ok = (at < len(names)) & (names[np.minimum(at, len(names) - 1)] == some)
        member[row, at[ok]] = 1
    shared = member @ member.T
    return shared[place[left], place[right]] == 0


def _compared(least: float):
    """Of one pair of blocks: rows (class, other, links): counted links of a class, and edges of a spanning forest."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        classes, weight, block = (table.column(c).to_numpy() for c in ("class", "weight", "block"))
        leaf, one, two = (table.column(c)[0].as_py() for c in ("leaf", "one", "two"))
        x = matrix(table.column("vector"))
        norm = np.sqrt((x**2).sum(1))
        left, right = np.flatnonzero(block == one), np.flatnonzero(block == two)
        cosine = (x[left] @ x[right].T) / (norm[left][:, None] * norm[right])
        a, b = np.nonzero(cosine >= least)
        a, b = left[a], right[b]
        if one == two:
            a, b = a[a < b], b[a < b]
        none = pa.table({"class": pa.array([], pa.int64()), "other": pa.array([], pa.int64()), "links": pa.array([], pa.int64())})
        if not len(a):
            return none
        lists = table.column("leaves").combine_chunks() if isinstance(table.column("leaves"), pa.ChunkedArray) else table.column("leaves")
        flat, ends = np.asarray(lists.flatten()), np.cumsum(np.asarray(lists.value_lengths()))
        ids = np.split(flat, ends[:-1])
        first = _first_shared(ids, a, b, leaf)
        a, b = a[first], b[first]
        if not len(a):
            return none
        links = np.bincount(a, weight[b], minlength=len(x)) + np.bincount(b, weight[a], minlength=len(x))
        root = np.arange(len(x))
        while True:  # every row takes the smallest root of its neighbours
            new = root.copy()
            np.minimum.at(new, a, root[b])
            np.minimum.at(new, b, root[a])
            new = new[new]
            if (new == root).all():
                break
            root = new
        some = np.flatnonzero(links)
        return pa.table({"class": classes[some], "other": classes[root[some]], "links": links[some].astype(np.int64)})

    return run


def near_duplicates(rows: DataFrame, least: float = 0.98, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, n_links, component_id and kept of every row.

    Rows are linked if their labels are equal and not null and the cosine of their vectors, in double
    precision, is `least` or more. Vectors that are null, zero, of another length than the commonest, or
    hold null or non-finite components have no links, nor have rows without an id. A row that repeats an
    id is one more row to link with; its links add up under its id. component_id: the smallest vec_id
    reachable; rows without links are their own component.
    """
    spark = prepare_llm(rows.sparkSession)
    plain = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    valid = usable(plain.where("vec_id is not null and label is not null"), "vector")
    # the name of a class: its smallest vec_id, or a fresh number where that isn't unique
    classes = stored(valid.groupBy("label", "vector").agg(F.min("vec_id").alias("low"), F.count("*").alias("weight")).withColumn("class", F.monotonically_increasing_id()), "classes")
    total = classes.count()
    everyone = plain.select("vec_id")
    if not total:
        return everyone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    share = min(1.0, SAMPLE / total)
    sample = matrix(classes.where(F.pmod(F.xxhash64(F.lit(2), "class"), F.lit(1_000_003)) < share * 1_000_003).orderBy("class").select("vector").toArrow().column(0))
    levels = int(min(LEVELS, max(0, np.ceil(np.log2(total / LEAF))))) if len(sample) else 0
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True) if len(sample) else np.zeros((1, 1))
    shared = spark.sparkContext.broadcast(Trees(unit, levels))

    def planted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(1))
            row, leaf = shared.value.leaves(x / np.linalg.norm(x, axis=1, keepdims=True))
            order = np.lexsort((leaf, row))
            counts = np.bincount(row, minlength=len(x))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(leaf[order]))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["class", "leaves"])

    placed = stored(classes.select("class", "vector").mapInArrow(planted, "class long, leaves array<long>").join(classes.select("class", "label", "weight", "vector"), "class"), "planted")
    seats = placed.select("class", "label", F.explode("leaves").alias("leaf"))
    sizes = seats.groupBy("label", "leaf").agg(F.count("*").alias("size")).where("size > 1")
    blocks = blocks_for(F.col("size"), BLOCK)
    dealt = seats.join(sizes, ["label", "leaf"]).withColumn("block", F.pmod(F.xxhash64(F.lit(9), "class"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.select("class", "leaf", "block", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"))
    met = dealt.join(placed.select("class", "label", "weight", "vector", "leaves"), "class")
    found = stored(met.groupBy("label", "leaf", "one", "two").applyInArrow(_compared(least), "class long, other long, links long"), "found")
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    components = connected_components(found.select(F.col("class").alias("a"), F.col("other").alias("b")))
    named = classes.select("class", "low", "weight", "label", "vector").join(links, "class", "left").join(components.withColumnRenamed("node", "class"), "class", "left")
    named = stored(named.select("label", "vector", "low", "weight", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "class").alias("component")), "named")
    lowest = named.groupBy("component").agg(F.min("low").alias("component_id"))
    by_vector = named.join(lowest, "component").select("label", "vector", (F.col("links") + F.col("weight") - 1).alias("links"), "component_id")
    linked = valid.join(by_vector, ["label", "vector"]).groupBy("vec_id").agg(F.sum("links").alias("links"), F.min("component_id").alias("component_id"))
    result = everyone.join(linked, "vec_id", "left").select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return result.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
