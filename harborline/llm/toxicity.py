"""Toxicity with a subsequence string kernel, Nyström landmarks and a linear SVM.

The kernel counts common subsequences of three characters of two strings,
each weighted by decay**(span in both strings), and is normalised. A gap or
an inserted character only costs a factor, so `i.d.i.o.t`, `idxiot` or an
inflected form stay close to `idiot`.

A text is cut into sentences and these into units: the words between white
space, and runs of single characters (`i d i o t`) as one unit. A unit longer
than WINDOW characters counts as overlapping windows. A sentence's value for a
landmark is the best kernel value of its units; the Nyström map K^-1/2 over the
landmarks turns these values into features of a linear SVM, trained on sentences
that carry their document's label. A document's score is the logistic of its
worst sentence's margin, fitted to the documents' labels.
"""

from __future__ import annotations

import re
import string
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.llm.common import beside, prepare_llm, remainder, stored, takes_over

DECAY = 0.6
LENGTH = 3
WINDOW = 24
#: Kernel values below this count as zero.
FLOOR = 0.25
#: A unit is compared with a landmark if it has so large a share of the landmark's distinct letters.
GATE = 0.75
#: Share of landmarks that may be there by chance, and documents of each label that are fitted for a landmark's sake.
FALSE, EACH_MARK = 0.01, 20
#: Share of a landmark's squared length that other landmarks need not span.
SPAN = 0.2
#: Bits of the filter that finds telling strings in a second pass.
FILTER_BITS = 1 << 23

_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
_SPACED = re.compile(r"(?<!\S)\S(?:\s+\S(?!\S)){2,}")
_ENDS = re.compile(r"^\W+|\W+$")
_MARKS = string.punctuation.replace("_", "")


def subsequence_kernel(left: list[str], right: list[str], length: int = LENGTH, decay: float = DECAY) -> np.ndarray:
    """Kernel values of the pairs (left[i], right[i]), all pairs at once, not normalised."""
    if not left:
        return np.zeros(0)
    a, b = _points(left), _points(right, 1)
    n, width, height = len(left), a.shape[1], b.shape[1]
    before = np.ones((width + 1, height + 1, n))  # K'_0
    total = np.zeros(n)
    for order in range(1, length + 1):
        after = np.zeros((width + 1, height + 1, n))
        for i in range(1, width + 1):
            run = np.zeros(n)
            same = a[:, i - 1, None] == b
            for j in range(1, height + 1):
                hit = same[:, j - 1] * before[i - 1, j - 1] * decay**2
                if order == length:
                    total += hit
                else:
                    run = decay * run + hit
                    after[i, j] = decay * after[i - 1, j] + run
        before = after
    return total


def _points(texts: list[str], pad: int = 0) -> np.ndarray:
    """Code points in rows of equal length; padding and marks only make gaps, they match nothing."""
    width = max(1, max(map(len, texts)))
    joined = "".join(text.ljust(width) for text in texts)
    out = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64).reshape(len(texts), width)
    out[_bits()[out] == 0] = 0x110000 + pad
    return out


_tables: dict[str, np.ndarray] = {}


def _bits() -> np.ndarray:
    """For every code point one of 64 bits if it is a letter or digit, otherwise 0."""
    if "bits" not in _tables:
        known = np.zeros(0x110000, np.uint64)
        for p in range(0x110000):
            if chr(p).isalnum():
                known[p] = 1 << (p - 97 if 97 <= p < 123 else 26 + p % 38)
        _tables["bits"] = known
    return _tables["bits"]


def _letters(texts: list[str]) -> np.ndarray:
    """The set of letters of each text (none is empty), as bits."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.bitwise_or.reduceat(_bits()[points], np.cumsum([0] + [len(t) for t in texts[:-1]]))


def windows(unit: str) -> list[str]:
    """A unit without the marks around it, in overlapping windows if it is long."""
    bare = unit.strip(_MARKS)
    unit = bare if bare.isalnum() else _ENDS.sub("", unit)
    if len(unit) <= WINDOW:
        return [unit] if len(unit) >= LENGTH else []
    return [unit[at : at + WINDOW] for at in range(0, len(unit) - WINDOW // 2, WINDOW // 2)]


_memos: dict[tuple, tuple[set[str], dict[str, np.ndarray]]] = {}
_triples: dict[int, tuple[np.ndarray, ...]] = {}


def _triples_of(n: int) -> tuple[np.ndarray, ...]:
    """Places i < j < k of the subsequences of a string of n characters, and the weight of each."""
    if n not in _triples:
        i, j, k = np.array(list(combinations(range(n), LENGTH))).T
        _triples[n] = i, j, k, DECAY ** (k - i + 1.0)
    return _triples[n]


@dataclass
class Landmarks:
    """The landmark strings with what the kernel needs of them.

    The kernel is an inner product over subsequences, so the landmarks' side of it is a fixed sparse
    table (subsequence, landmark, weight); a string is compared with all landmarks in one look-up
    of its own subsequences.
    """

    texts: list[str]
    own: np.ndarray = field(init=False)

    def __post_init__(self):
        self.own = np.sqrt(subsequence_kernel(self.texts, self.texts))
        self.masks = _letters(self.texts) if self.texts else np.zeros(0, np.uint64)
        self.need = np.array([max(2, int(np.ceil(GATE * int(m).bit_count()))) for m in self.masks], np.int64)
        letters = {c: k for k, c in enumerate(sorted({c for t in self.texts for c in t if c.isalnum()}), 1)}
        self.letter = np.zeros(0x110000, np.int32)  # 0: in no landmark
        self.letter[[ord(c) for c in letters]] = list(letters.values())
        weights: dict[tuple, Counter] = {}
        for mark, text in enumerate(self.texts):
            for at in combinations([k for k, c in enumerate(text) if c.isalnum()], LENGTH):
                weights.setdefault(tuple(letters[text[k]] for k in at), Counter())[mark] += DECAY ** (at[-1] - at[0] + 1)
        pairs = {p: k for k, p in enumerate(sorted({t[:2] for t in weights}), 1)}
        self.pair = np.zeros((len(letters) + 1, len(letters) + 1), np.int32)
        self.triple = np.zeros((len(pairs) + 1, len(letters) + 1), np.int32)
        for row, (one, two, three) in enumerate(weights, 1):
            self.pair[one, two] = pairs[one, two]
            self.triple[pairs[one, two], three] = row
        self.count = np.array([0, *map(len, weights.values())])
        self.first = np.cumsum(self.count) - self.count
        self.mark = np.array([m for found in weights.values() for m in found], np.int64)
        self.weight = np.array([w for found in weights.values() for w in found.values()], float)

    def __getstate__(self):
        return {"texts": self.texts}

    def __setstate__(self, state):
        self.texts = state["texts"]
        self.__post_init__()

    @property
    def memo(self) -> tuple[set[str], dict[str, np.ndarray]]:
        """Units seen by this process, and the values of those above the floor; one memo for all copies of the landmarks."""
        takes_over("toxicity", _memos.clear)
        mine = tuple(self.texts)
        if mine not in _memos:
            _memos.clear()
            _memos[mine] = set(), {}
        return _memos[mine]

    def kernels(self, texts: list[str]) -> np.ndarray:
        """Kernel values of texts (of at most WINDOW characters) with all landmarks, not normalised."""
        out = np.zeros((len(texts), len(self.texts)))
        lengths = np.array([len(t) for t in texts])
        for n in np.unique(lengths[lengths >= LENGTH]):
            i, j, k, weight = _triples_of(int(n))
            same = np.flatnonzero(lengths == n)
            step = max(1, 10_000_000 // (len(i) * max(50, len(self.texts))))
            for at in range(0, len(same), step):
                some = same[at : at + step]
                points = np.frombuffer("".join([texts[m] for m in some]).encode("utf-32-le", "surrogatepass"), np.uint32)
                letter = self.letter[points].reshape(len(some), n)
                row = self.triple[self.pair[letter[:, i], letter[:, j]], letter[:, k]]
                text, place = np.nonzero(row)
                row = row[text, place]
                many = self.count[row]
                entry = np.arange(many.sum()) + np.repeat(self.first[row] - (np.cumsum(many) - many), many)
                cell = np.repeat(text, many) * len(self.texts) + self.mark[entry]
                out[some] = np.bincount(cell, np.repeat(weight[place], many) * self.weight[entry], out[some].size).reshape(len(some), -1)
        return out

    def learn(self, units: list[str]) -> None:
        """Put new units into the memo, with their values where one is above the floor."""
        self.memo[0].update(units)
        parts, owner = [], []
        for unit in units:
            for w in windows(unit):
                parts.append(w)
                owner.append(unit)
        if not self.texts:
            return
        step = max(256, 250_000 // len(self.texts))
        for at in range(0, len(parts), step):
            self._learn(parts[at : at + step], owner[at : at + step])

    def _learn(self, parts: list[str], owner: list[str]) -> None:
        rows = self.memo[1]
        passing = np.bitwise_count(_letters(parts)[:, None] & self.masks) >= self.need
        which = np.flatnonzero(passing.any(1))
        if not len(which):
            return
        texts = [parts[i] for i in which]
        values = np.where(passing[which], self.kernels(texts), 0.0)
        # a kernel with itself is at least the sum of the squared weights of its subsequences
        lowest = [0.01] * LENGTH + [np.sqrt((_triples_of(n)[3] ** 2).sum()) * (1 - 1e-9) for n in range(LENGTH, WINDOW + 1)]
        least = np.array([lowest[len(t)] if t.isalnum() else 0.01 for t in texts])
        close = np.flatnonzero((values >= FLOOR * least[:, None] * self.own).any(1))
        for at in range(0, len(close), 1000):
            some = close[at : at + 1000]
            chosen = [texts[i] for i in some]
            selves = np.sqrt(subsequence_kernel(chosen, chosen))
            scaled = values[some] / np.maximum(1e-12, selves[:, None] * self.own)
            scaled[scaled < FLOOR] = 0
            for i in np.flatnonzero(scaled.any(1)):
                unit = owner[which[some[i]]]
                row = scaled[i].astype(np.float32)
                rows[unit] = np.maximum(rows[unit], row) if unit in rows else row

    def sentences(self, texts: list[str | None]) -> list[list[np.ndarray]]:
        """For each text the values of its sentences that have any above the floor."""
        (seen, memo), lowered = self.memo, [(t or "").lower() for t in texts]
        if len(seen) > 150_000 or len(memo) * len(self.texts) > 2_000_000:
            seen.clear()
            memo.clear()
        spaced = [_SPACED.findall(t) for t in lowered]
        words = [set(t.split()) for t in lowered]
        fresh = set().union(*words, ("".join(s.split()) for runs in spaced for s in runs))
        self.learn(list(fresh - seen))
        out = []
        for text, runs, some in zip(lowered, spaced, words):
            hits = memo.keys() & some
            close = {r for r in runs if "".join(r.split()) in memo}
            found = []
            if hits or close:
                for sentence in _SENTENCE.split(text):
                    rows = [memo[w] for w in sentence.split() if w in hits]
                    if rows:
                        found.append(np.max(rows, axis=0))
                found += [memo["".join(r.split())] for r in close]  # a run is a sentence of its own
            out.append(found)
        return out


@dataclass
class Model:
    """margin = weights . values + bias; score = logistic(slope * worst margin + offset)."""

    landmarks: Landmarks
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def scores(self, texts: list[str | None]) -> list[float]:
        worst = [max([self.bias, *(float(v @ self.weights) + self.bias for v in found)]) for found in self.landmarks.sentences(texts)]
        return (1 / (1 + np.exp(-np.clip(self.slope * np.array(worst) + self.offset, -500, 500)))).tolist()


def _strings(word: str) -> set[str]:
    """The strings of a word that can be landmarks: the word, or its windows, and how it begins."""
    bare = word.strip(_MARKS)
    if LENGTH <= len(bare) <= WINDOW and bare.isalnum():
        return {bare, *(bare[:k] for k in range(4, min(9, len(bare))))}
    parts = windows(word)
    if len(parts) == 1:
        parts += [parts[0][:k] for k in range(4, min(9, len(parts[0]))) if parts[0][k - 1].isalnum()]
    return {p for p in parts if sum(map(str.isalnum, p)) >= LENGTH}


def _found(texts: list[str | None], known: dict[str, set[str]]) -> Iterator[set[str]]:
    """For each text all strings that can be landmarks; known: a memo of words."""
    for text in texts:
        if len(known) > 50_000:
            known.clear()
        words = set((text or "").lower().split())
        known.update((w, _strings(w)) for w in words if w not in known)
        yield set().union(*(known[w] for w in words))


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many toxic and other documents have a word, or a word that begins so; a string can come more than once."""
    counts, known = (Counter(), Counter()), {}

    def told():
        for toxic, found in enumerate(counts):
            names = list(found)
            for at in range(0, len(names), 50_000):
                part = names[at : at + 50_000]
                here, none = pa.array([found[n] for n in part], pa.int64()), pa.array([0] * len(part), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), here if toxic else none, none if toxic else here], names=["word", "toxic", "clean"])
            found.clear()

    for batch in batches:
        for found, toxic in zip(_found(batch.column(0).to_pylist(), known), batch.column(1).to_pylist()):
            counts[toxic].update(found)
        if sum(map(len, counts)) > 100_000:
            yield from told()
    yield from told()


def _telling(counted: DataFrame, n: dict[int, int], toxic: str = "toxic", clean: str = "clean") -> DataFrame:
    """The rows of telling strings with `sure`, by Benjamini and Hochberg's cut.

    A string is tested if it is in so many documents that it could pass alone. Were labels dealt by chance, a string
    of s documents would be in this many toxic ones with a probability of at most exp(-sure) (Chernoff's bound);
    strings less than four times as frequent in toxic documents are never telling.
    """
    chance = n[1] / (n[0] + n[1])
    tested = counted.where(F.col(toxic) + F.col(clean) >= float(np.log(FALSE) / np.log(chance)))
    part = lambda count, share: F.when(F.col(count) == 0, 0.0).otherwise(F.col(count) * F.log(F.col(count) / (F.col(toxic) + F.col(clean)) / share))
    more = F.col(toxic) * n[0] > F.col(clean) * (4 * n[1])
    sure = stored(tested.withColumn("sure", F.when(more, part(toxic, chance) + part(clean, 1 - chance)).otherwise(0.0)), "sure")
    levels = sure.groupBy(F.floor(F.least("sure", F.lit(600.0)) * 100).alias("level")).agg(F.count("*").alias("n")).orderBy(F.desc("level")).collect()
    total, passed, least = sum(r["n"] for r in levels), 0, None
    for r in levels:
        passed += r["n"]
        if r["level"] > 0 and total * np.exp(-r["level"] / 100) <= FALSE * passed:
            least = r["level"] / 100
    return sure.where(F.col("sure") >= least) if least is not None else sure.limit(0)


def _credited(labelled: DataFrame, telling: DataFrame) -> DataFrame:
    """Telling strings with `t` and `c`: their credit for the toxic and the other documents they are in.

    A document's credit of 1 is dealt to its words by how sure their surest strings are, which get it. The accidental words of a group of
    copies share the credit of these copies, and get hardly any where an insult explains the label.
    """
    slot = F.pmod(F.crc32(F.encode("word", "utf-8")), F.lit(FILTER_BITS))
    words = telling.groupBy((slot / 8).cast("int").alias("byte")).agg(F.expr("bit_or(shiftleft(1, cast(pmod(crc32(encode(word, 'utf-8')), 8) as int)))").alias("bits")).toArrow()
    filled = np.zeros(FILTER_BITS // 8, np.uint8)
    filled[words.column("byte").to_numpy()] = words.column("bits").to_numpy()
    shared = labelled.sparkSession.sparkContext.broadcast(filled.tobytes())

    def may(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, known = shared.value, {}

        def passing(word: str) -> list[dict]:
            slots = ((zlib.crc32(p.encode("utf-8", "surrogatepass")) % FILTER_BITS, p) for p in _strings(word))
            return [{"of": word, "word": p} for at, p in slots if bits[at >> 3] >> (at & 7) & 1]

        for batch in batches:
            found = []
            for text in batch.column(1).to_pylist():
                if len(known) > 50_000:
                    known.clear()
                words = set((text or "").lower().split())
                known.update((w, passing(w)) for w in words if w not in known)
                found.append([p for w in words for p in known[w]])
            held = pa.array(found, pa.list_(pa.struct({"of": pa.string(), "word": pa.string()})))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), held], names=["doc_id", "kind", "held"])

    rows = labelled.mapInArrow(may, "doc_id long, kind int, held array<struct<of:string,word:string>>").select("doc_id", "kind", F.inline("held"))
    best = rows.join(telling.select("word", "sure"), "word").groupBy("doc_id", "kind", "of").agg(F.max(F.struct("sure", F.length("word").alias("n"), "word")).alias("best"))
    docs = best.groupBy("doc_id", "kind").agg(F.collect_set("best").alias("held"))
    total = F.aggregate("held", F.lit(0.0), lambda sofar, h: sofar + h["sure"])
    dealt = docs.select("kind", total.alias("total"), F.explode("held").alias("h")).groupBy("h.word").agg(*[F.sum(F.when(F.col("kind") == k, F.col("h.sure") / F.col("total")).otherwise(0.0)).alias(name) for k, name in ((1, "t"), (0, "c"))])
    return telling.drop("sure").join(dealt, "word")


def _spanning(rows: list) -> list:
    """Rows whose strings span the others, by pivoted incomplete Cholesky of the kernel: of every string no more than SPAN is left over.

    The pivot is the string with the most left over, of equals the most telling; memory is strings times pivots.
    """
    texts = [r["word"] for r in rows]
    own = np.sqrt(subsequence_kernel(texts, texts))
    left, factors, pivots = np.ones(len(texts)), np.zeros((0, len(texts))), []
    while len(texts) and left.max() > SPAN:
        at = int(np.argmax(np.round(left, 9)))
        column = subsequence_kernel([texts[at]] * len(texts), texts) / (own[at] * own)
        factor = (column - factors[:, at] @ factors) / np.sqrt(left[at])
        factors = np.vstack([factors, factor])
        left = np.maximum(0.0, left - factor**2)
        left[at] = 0
        pivots.append(at)
    return [rows[at] for at in sorted(pivots)]


@dataclass
class Sparse:
    """Rows of landmark values without their zeros."""

    row: np.ndarray
    cell: np.ndarray
    value: np.ndarray
    rows: int
    cells: int

    def __matmul__(self, x: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * x[self.cell], self.rows)

    def back(self, y: np.ndarray) -> np.ndarray:
        return np.bincount(self.cell, self.value * y[self.row], self.cells)


def _svm(x: Sparse, nystrom: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-5) -> np.ndarray:
    """Squared hinge loss with equally heavy classes, by accelerated gradient steps; the last coefficient is the bias."""
    weight = np.where(y > 0, weight / weight[y > 0].sum(), weight / weight[y < 0].sum()) / 2
    ahead_of = lambda w: x @ (nystrom @ w[:-1]) + w[-1]
    back = lambda v: np.append(nystrom.T @ x.back(v), v.sum())
    top, size = np.ones(x.cells + 1), 1.0
    for _ in range(100):  # the largest curvature, by powers
        top = back(weight * ahead_of(top / np.linalg.norm(top)))
        size = np.linalg.norm(top)
    step = 1 / (2 * 1.05 * size + penalty)
    w = ahead = np.zeros(x.cells + 1)
    for t in range(600):
        slack = np.maximum(0, 1 - y * ahead_of(ahead))
        gradient = -2 * back(weight * y * slack) + penalty * np.append(ahead[:-1], 0)
        new = ahead - step * gradient
        ahead, w = new + t / (t + 3) * (new - w), new
    return w


def _logistic(margin: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve that is 0.5 where the fewest documents fall on the wrong side.

    Of about equally good places (0.2 % of the weight) the middle of the widest gap is taken; the slope is the likeliest one there.
    """
    order = np.argsort(margin, kind="stable")
    m, heavy = margin[order], weight[order] * np.where(label[order] == 1, 1.0, -1.0)
    wrong = np.concatenate([[0], np.cumsum(heavy)])[1:-1]
    gaps = np.diff(m)
    wrong[gaps <= 0] = np.inf
    if not len(gaps) or np.isinf(wrong.min()):
        return 1.0, 0.0
    best = np.flatnonzero(wrong <= wrong.min() + 0.002 * weight.sum())
    at = best[np.argmax(gaps[best])]
    center = (m[at] + m[at + 1]) / 2
    slopes = np.geomspace(1, 30, 60)
    p = 1 / (1 + np.exp(-np.clip(np.outer(slopes, margin - center), -30, 30)))
    loss = -(weight * (label * np.log(p + 1e-9) + (1 - label) * np.log(1 - p + 1e-9))).sum(1)
    slope = slopes[np.argmin(loss)]
    return float(slope), float(-slope * center)


def _with_labels(texts: DataFrame, label: DataFrame) -> DataFrame:
    """Texts (doc_id, text) with their labels (doc_id, toxic).

    A filter of FILTER_BITS bits, the most that is broadcast, keeps texts without a label out of the shuffle. The join
    itself is a shuffle at every size.
    """
    slot = F.pmod(F.xxhash64(F.lit(6), F.col("doc_id").cast("string")), F.lit(FILTER_BITS))
    known = label.withColumn("slot", slot).groupBy((F.col("slot") / 64).cast("int").alias("place")).agg(F.expr("bit_or(shiftleft(1L, cast(slot % 64 as int)))").alias("bits"))
    may = texts.withColumn("slot", slot).withColumn("place", (F.col("slot") / 64).cast("int")).join(F.broadcast(known), "place")
    return may.where("shiftright(bits, cast(slot % 64 as int)) & 1 = 1").select("doc_id", "text").join(label.hint("merge"), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, each: int = 1500) -> Model:
    """Learn from docs (doc_id, text) and labels (doc_id, toxic 0 or 1, nulls left out; 1 wins over repeats).

    Words are counted in all labelled documents. A string is telling if it is more frequent in toxic documents
    than chance allows (of these about FALSE are wrong), once by the documents it is in and once by its credit
    for them; of the telling strings those become landmarks that span the others. The weights are fitted on
    about `each` toxic and twice as many other documents at most, and EACH_MARK of each label for every
    landmark, chosen by a hash of doc_id and weighted by their chance to be chosen; the driver gets the
    distinct values of their sentences, with summed weights. Without landmarks, or without toxic or other examples, every text scores 0.
    """
    spark = prepare_llm(docs.sparkSession)
    label = labels.where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    labelled = stored(_with_labels(docs.select("doc_id", F.col("text").cast("string").alias("text")).where("text is not null"), label), "labelled")
    n = {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    nothing = Model(Landmarks([]), np.zeros(0), 0.0, 1.0, -500.0)
    if not n.get(0) or not n.get(1):
        return nothing
    counted = labelled.select("text", "toxic").mapInArrow(_candidates, "word string, toxic long, clean long").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    telling = _telling(counted, n)
    alone = _telling(_credited(labelled, telling), n, "t", "c")
    chosen = _spanning(alone.orderBy(F.desc("sure"), F.desc(F.length("word")), "word").select("word", "toxic", "clean").collect())
    if not chosen:
        return nothing
    marks = Landmarks([r["word"] for r in chosen])
    share = [min(1.0, 2 * each / n[0]), min(1.0, each / n[1])]
    rates = {r["word"]: (min(1.0, EACH_MARK / max(1, r["clean"])), min(1.0, EACH_MARK / r["toxic"])) for r in chosen}
    shared = spark.sparkContext.broadcast((marks, rates))

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (own, rate), known = shared.value, {}
        for batch in batches:
            texts, toxic, draw = (batch.column(c).to_pylist() for c in (1, 2, 3))
            chances = []
            for text, t in zip(texts, toxic):
                if len(known) > 50_000:
                    known.clear()
                words = set((text or "").lower().split())
                known.update((w, _strings(w) & rate.keys()) for w in words if w not in known)
                chances.append(max([share[t], *(rate[p][t] for w in words for p in known[w])]))
            some = [i for i, c in enumerate(chances) if draw[i] < c]
            bags = []
            for found in own.sentences([texts[i] for i in some]):
                rows = np.unique(np.array(found), axis=0) if found else np.zeros((1, len(rate)), np.float32)
                bags.append([{"cells": (c := np.flatnonzero(r)).tolist(), "values": r[c].tolist()} for r in rows])
            kind = batch.column(2).take(pa.array(some, pa.int64()))
            arrays = [kind, pa.array([1 / chances[i] for i in some], pa.float64()), pa.array(bags, pa.list_(pa.struct({"cells": pa.list_(pa.int32()), "values": pa.list_(pa.float32())})))]
            yield pa.RecordBatch.from_arrays(arrays, names=["toxic", "weight", "bag"])

    drawn = labelled.select("doc_id", "text", "toxic", (F.pmod(F.xxhash64(F.lit(4), "doc_id"), F.lit(1_000_003)) / 1_000_003).alias("draw"))
    bags = stored(drawn.mapInArrow(values, "toxic int, weight double, bag array<struct<cells:array<int>,values:array<float>>>"), "bags")
    # equal rows are fitted once, with the sum of their weights; a document without rows has one of zeros
    equal = bags.select("toxic", "weight", F.explode("bag").alias("r")).groupBy("toxic", "r").agg(F.sum("weight").alias("weight"))
    got = equal.select("toxic", "weight", "r.cells", "r.values").orderBy("toxic", "cells", "values").toArrow().combine_chunks()
    toxic, weight = got.column("toxic").to_numpy(), got.column("weight").to_numpy()
    if len(set(toxic.tolist())) < 2:
        return nothing
    cells, some = (pa.concat_arrays(got.column(c).chunks) for c in ("cells", "values"))
    x = Sparse(np.repeat(np.arange(len(toxic)), cells.value_lengths().to_numpy()), cells.flatten().to_numpy(), some.flatten().to_numpy().astype(float), len(toxic), len(chosen))
    gram = marks.kernels(marks.texts) / np.outer(marks.own, marks.own)
    roots, vectors = np.linalg.eigh(gram)
    nystrom = vectors @ np.diag(1 / np.sqrt(np.maximum(roots, 0.05))) @ vectors.T
    w = _svm(x, nystrom, 2.0 * toxic - 1, weight)
    weights = nystrom @ w[:-1]
    rated = spark.sparkContext.broadcast(weights)

    def worst(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margins = [max([0.0, *(float(np.dot(r["values"], rated.value[r["cells"]])) for r in bag if r["cells"])]) for bag in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(margins, pa.float64())], names=["toxic", "weight", "margin"])

    # the driver gets margins in steps of 1e-4
    places = bags.mapInArrow(worst, "toxic int, weight double, margin double").groupBy("toxic", F.round("margin", 4).alias("margin")).agg(F.sum("weight").alias("weight"))
    margin, label, heavy = (places.orderBy("margin", "toxic").toArrow().column(c).to_numpy() for c in ("margin", "toxic", "weight"))
    slope, offset = _logistic(margin + w[-1], label.astype(float), heavy)
    return Model(marks, weights, float(w[-1]), slope, offset)


def score(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """Each row (`row`, a struct of its columns or of `keep`) and `made.score`, 0 to 1.

    Null and empty texts score as a text without any unit. One pass, no shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        for texts in batches:
            yield {"score": shared.value.scores(texts)}

    return beside(docs, "text", "score double", work, keep)


def held_out(identifier: str = "doc_id"):
    """Documents whose label is not learned from."""
    return remainder(F.col(identifier), 5) == 0
