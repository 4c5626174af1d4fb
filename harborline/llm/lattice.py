"""Language-model scores: the likelihood of a text summed over all its segmentations.

The model is a unigram over the pieces of an existing SentencePiece vocabulary.
A word's probability is the sum over all ways to cut it into pieces, by the
forward recursion in log space; a text's is the product over its words and one
end. As no piece reaches over a space, that is the whole text's lattice.

Start scores are the vocabulary's own (for a BPE vocabulary Zipf's law of its
ranks). One round of expectation-maximisation over the words of all training
documents then weights the pieces by how often their segmentations use them.

Words are counted over all documents. A word with at least 1 / FREQUENT of all
tokens (there are at most FREQUENT of them) goes to every task with its values;
the tokens of rarer words are joined with the table of words, so no key of that
join is hot.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.llm.common import prepare_llm, stored, words_of
from harborline.llm.sentencepiece import SPACE, vocabulary

FREQUENT = 1 << 20
#: Words of more bytes always go through the join.
SHORT = 64
#: Distinct words that a task gathers before it hands them on.
GATHER = 400_000
LOWEST = -1e30


class Trie:
    """Prefixes of pieces as numbered nodes, 0 the empty one; the next node by letter lies in a table by hash."""

    def __init__(self, pieces: dict[str, int]):
        number = {p: i for i, p in enumerate(["", *sorted({p[:k] for p in pieces for k in range(1, len(p) + 1)})])}
        self.piece = np.full(len(number), -1, np.int64)
        self.piece[[number[p] for p in pieces]] = list(pieces.values())
        steps = [(number[p[:-1]], ord(p[-1]), i) for p, i in number.items() if p]
        parent, letter, child = (np.array([x[k] for x in steps], np.int64) for k in range(3))
        key = parent << 21 | letter
        self.mask = (1 << max(10, (8 * len(key)).bit_length())) - 1
        self.keys, self.next = np.full(self.mask + 1, -1, np.int64), np.full(self.mask + 1, -1, np.int32)
        slot = self._slot(key)
        while len(key):  # a taken place sends a key on to the next one
            free = self.keys[slot] < 0
            _, first = np.unique(np.where(free, slot, -1), return_index=True)
            first = first[free[first]]
            self.keys[slot[first]], self.next[slot[first]] = key[first], child[first]
            left = np.ones(len(key), bool)
            left[first] = False
            key, child, slot = key[left], child[left], (slot[left] + 1) & self.mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(24)).astype(np.int64) & self.mask

    def after(self, node: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """The next node, or -1."""
        key = node.astype(np.int64) << 21 | letter
        slot = self._slot(key)
        held = self.keys[slot]
        out = np.where(held == key, self.next[slot], -1)
        other = np.flatnonzero((held != key) & (held >= 0))
        while len(other):
            slot[other] = (slot[other] + 1) & self.mask
            held = self.keys[slot[other]]
            hit = held == key[other]
            out[other[hit]] = self.next[slot[other[hit]]]
            other = other[~hit & (held >= 0)]
        return out


_tries: dict[str, Trie] = {}


class Lattice:
    """Log-space recursions over many words at once."""

    def __init__(self, path: str, log: np.ndarray | None = None):
        self.vocab = vocabulary(path)
        size = len(self.vocab.spelled)
        if log is None:
            log = np.full(size, LOWEST)
            for i, value in self.vocab.log.items():
                log[i] = value
            total = np.logaddexp.reduce(np.append(log[log > LOWEST / 2], -np.log(1000.0)))
            log = np.where(log > LOWEST / 2, log - total, LOWEST)
        self.log = log
        if path not in _tries:
            _tries[path] = Trie(self.vocab.pieces)
        self.trie = _tries[path]

    def arcs_of(self, texts: list[str]) -> tuple[np.ndarray, ...]:
        """(text, start, end, piece) of all arcs, and their value; a piece of -1 - c is the code point c spelled in bytes.

        Every text starts with the space sign. Of the arcs that end at one place the longer come first.
        """
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        sizes = np.array([len(t) for t in texts], np.int64)
        begins = np.cumsum(sizes) - sizes
        inner = codes == ord(SPACE)  # after the first letter the sign is a literal
        inner[begins] = False
        stops = np.repeat(begins + sizes, sizes)
        at = np.flatnonzero(~inner)
        node, size, alone = np.zeros(len(at), np.int64), 0, np.zeros(len(codes), bool)
        found = []
        while len(at):
            node = self.trie.after(node, codes[at + size])
            size += 1
            there = np.flatnonzero(node >= 0)
            at, node = at[there], node[there]
            piece = self.trie.piece[node]
            whole = np.flatnonzero(piece >= 0)
            found.append((at[whole], np.full(len(whole), size), piece[whole]))
            if size == 1:
                alone[at[whole]] = True
            there = np.flatnonzero(at + size < stops[at])
            there = there[~inner[at[there] + size]]
            at, node = at[there], node[there]
        bare = np.flatnonzero(~alone)
        found.insert(0, (bare, np.ones(len(bare), np.int64), -1 - codes[bare]))
        at, size, piece = (np.concatenate(x)[::-1] for x in zip(*found))
        row = np.repeat(np.arange(len(texts)), sizes)[at]
        start = at - begins[row]
        value = self.log[np.maximum(piece, 0)]
        strange, which = np.unique(piece[piece < 0], return_inverse=True)
        value[piece < 0] = np.array([self.log[self.spelling(p)].sum() for p in strange])[which] if len(strange) else 0
        return row, start, start + size, piece, value

    def spelling(self, piece: int) -> list[int]:
        """Byte pieces of the code point c, for a piece of -1 - c."""
        return [self.vocab.byte_id[b] for b in chr(-1 - piece).encode("utf-8", "surrogatepass")]

    def arcs(self, word: str) -> list[tuple[int, int, tuple[int, ...]]]:
        """(start, end, ids) of all pieces in a word with the space sign before it."""
        _, start, end, piece, _ = self.arcs_of([word])
        return [(a, e, (p,) if p >= 0 else tuple(self.spelling(p))) for a, e, p in zip(start.tolist(), end.tolist(), piece.tolist())]

    def words(self, words: list[bytes], counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural log probability of each word; with counts also the expected use of every piece."""
        out = np.zeros(len(words))
        used = np.zeros(len(self.log)) if counts is not None else None
        texts = [SPACE + w.decode("utf-8", "surrogatepass") for w in words]
        order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
        at = 0
        while at < len(order):
            width = len(texts[order[min(len(order), at + 4096) - 1]]) + 1
            some = order[at : at + max(1, min(4096, 2_000_000 // (width * 17)))]
            at += len(some)
            out[some] = self._block([texts[i] for i in some], None if counts is None else counts[some], used)
        return out, used

    def _block(self, texts: list[str], counts: np.ndarray | None, used: np.ndarray | None) -> np.ndarray:
        width = max(map(len, texts))
        row, start, end, piece, value = self.arcs_of(texts)
        by_end = _order(end)
        alpha = np.full((len(texts), width + 1), LOWEST)
        alpha[:, 0] = 0
        bounds = np.searchsorted(end[by_end], np.arange(1, width + 2))
        for e in range(1, width + 1):
            part = by_end[bounds[e - 1] : bounds[e]]
            alpha[:, e] = _sum(alpha[row[part], start[part]] + value[part], row[part], len(texts))
        last = np.array([len(t) for t in texts])
        total = alpha[np.arange(len(texts)), last]
        if used is not None:
            beta = np.full((len(texts), width + 1), LOWEST)
            by_start = _order(start)
            bounds = np.searchsorted(start[by_start], np.arange(0, width + 1))
            beta[np.arange(len(texts)), last] = 0
            for s in range(width - 1, -1, -1):
                part = by_start[bounds[s] : bounds[s + 1]]
                got = _sum(beta[row[part], end[part]] + value[part], row[part], len(texts))
                beta[:, s] = np.where(s < last, got, beta[:, s])
            share = np.exp(np.minimum(0, alpha[row, start] + value + beta[row, end] - total[row])) * counts[row]
            used += np.bincount(piece[piece >= 0], share[piece >= 0], minlength=len(used))
            strange, which = np.unique(piece[piece < 0], return_inverse=True)
            for code, sum_of in zip(strange, np.bincount(which, share[piece < 0], minlength=len(strange))):
                np.add.at(used, self.spelling(code), sum_of)
        return total


def _order(places: np.ndarray) -> np.ndarray:
    """A stable order; small numbers are sorted by their digits."""
    return np.argsort(places.astype(np.uint16) if not len(places) or places.max() < 1 << 16 else places, kind="stable")


def _sum(terms: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """For each row the logarithm of the sum of the exponentials of its terms."""
    high = np.full(n, LOWEST)
    np.maximum.at(high, rows, terms)
    total = np.bincount(rows, np.exp(np.maximum(terms - high[rows], -700)), minlength=n)
    return np.where(total > 0, high + np.log(np.maximum(total, 1e-300)), LOWEST)


def _together(batches: Iterator[pa.RecordBatch], rows: int = 8192, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about so many rows or bytes: the recursions take many words at once."""
    held = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows or sum(b.nbytes for b in held) >= size:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, training count, other count) of a task's documents, handed on in portions."""
    counts = (Counter(), Counter())

    def portion():
        for other, found in enumerate(counts):
            names = list(found)
            for at in range(0, len(names), 50_000):
                part = names[at : at + 50_000]
                n = pa.array([found[w] for w in part], pa.int64())
                none = pa.array([0] * len(part), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()), none if other else n, n if other else none], names=["word", "n", "other"])
            found.clear()

    for batch in batches:
        for text, out in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts[out].update(words_of(text))
        if len(counts[0]) + len(counts[1]) > GATHER:
            yield from portion()
    yield from portion()


def score(docs: DataFrame, training, path: str, doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every row.

    docs: doc_id and text (null: empty). training: a condition on doc_id, null counts as not.
    Tokens are the words `[^\\x20\\x09-\\x0D]+` after A-Z to a-z and one end. base_score: add-one
    unigram over training tokens; score: log10 probability under the piece lattice, whose end has the
    share (documents + 1) / (tokens + 2) of training. Without training documents the vocabulary's own
    scores are used, and the base is 0 for every token. Repeated rows are scored each. Words are cut
    nowhere, however long.
    """
    spark = prepare_llm(docs.sparkSession)
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col("text").cast("string").alias("text"), F.coalesce(training, F.lit(False)).alias("learned"))
    raw = source.select("text", (~F.col("learned")).cast("int").alias("out")).mapInArrow(_gathered, "word binary, n long, other long")
    words = stored(raw.groupBy("word").agg(F.sum("n").alias("n"), F.sum("other").alias("other")), "words")
    ends = source.where("learned").count()
    state = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum(F.expr("n + other")), F.lit(0)).alias("all"), F.count_if(F.col("n") > 0).alias("kinds")).first()
    total, kinds = int(state["n"]) + ends, int(state["kinds"]) + (ends > 0)

    def expected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, used = Lattice(path), 0
        for batch in _together(batches):
            if batch.num_rows:
                used = used + lattice.words(batch.column(0).to_pylist(), batch.column(1).to_numpy(zero_copy_only=False).astype(float))[1]
        if not isinstance(used, int):
            there = np.flatnonzero(used)
            yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(used[there])], names=["piece", "used"])

    uses = words.where("n > 0").select("word", "n").mapInArrow(expected, "piece int, used double").groupBy("piece").agg(F.sum("used").alias("used")).toArrow()
    log, end_log = None, np.log((ends + 1) / (total + 2))
    if uses.num_rows:
        known = Lattice(path).log > LOWEST / 2
        use = np.zeros(len(known))
        use[uses.column("piece").to_numpy()] = uses.column("used").to_numpy()
        use = np.where(known, use + 0.1, 0)
        log = np.where(known, np.log(np.maximum(use, 1e-300) / use.sum()), LOWEST)
    stay = np.log1p(-np.exp(end_log)) if total else -np.log(2.0)
    shared = spark.sparkContext.broadcast(log)

    def valued(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(path, shared.value)
        for batch in _together(batches):
            value = (lattice.words(batch.column(0).to_pylist())[0] + stay) / np.log(10) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(value)], names=["word", "n", "other", "value"])

    valued_words = stored(words.mapInArrow(valued, "word binary, n long, other long, value double"), "valued")
    often = valued_words.where(f"n + other >= {max(1, -(-int(state['all']) // FREQUENT))} and octet_length(word) <= {SHORT}").select("word", "n", "value").toArrow()
    frequent = spark.sparkContext.broadcast(dict(zip(often.column("word").to_pylist(), zip(often.column("n").to_pylist(), often.column("value").to_pylist()))))
    below = float(np.log10(total + kinds + 1))
    end_base = float(np.log10(ends + 1)) - below
    end_score = float(end_log / np.log(10))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = frequent.value
        for batch in batches:
            key, n_tokens, known, base, value, rare, times = [], [], [], [], [], [], []
            for number, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = Counter(words_of(text))
                seen, b, v, size = int(ends > 0), end_base, end_score, 1
                names, many = [], []
                for word, n in found.items():
                    size += n
                    hit = table.get(word)
                    if hit is None:
                        names.append(word)
                        many.append(n)
                    else:
                        seen += n if hit[0] else 0
                        b += n * (math.log10(hit[0] + 1) - below)
                        v += n * hit[1]
                key.append(number)
                n_tokens.append(size)
                known.append(seen)
                base.append(b)
                value.append(v)
                rare.append(names)
                times.append(many)
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(value, pa.float64()), pa.array(rare, pa.list_(pa.binary())), pa.array(times, pa.list_(pa.int64()))], names=["doc_id", "n_tokens", "n_known", "base", "value", "rare", "times"])

    summed = source.select(F.col("doc_id").cast("long"), "text").mapInArrow(rows, "doc_id long, n_tokens long, n_known long, base double, value double, rare array<binary>, times array<long>")
    summed = summed.withColumn("row", F.monotonically_increasing_id())
    parts = stored(summed, "parts")
    rare = parts.where("size(rare) > 0").select("row", F.explode(F.arrays_zip("rare", "times")).alias("r")).select("row", F.col("r.rare").alias("word"), F.col("r.times").alias("times"))
    joined = rare.join(valued_words.select("word", "n", "value"), "word")
    log10 = F.log10(F.col("n") + 1) - F.lit(below)
    more = joined.groupBy("row").agg(F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("known"), F.sum(F.col("times") * log10).alias("more_base"), F.sum(F.col("times") * F.col("value")).alias("more_value"))
    result = parts.select("row", "doc_id", "n_tokens", "n_known", "base", "value").join(more, "row", "left")
    return result.select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"), (F.col("value") + F.coalesce("more_value", F.lit(0.0))).alias("score"),
    )
