"""Language identification with language-bitmask n-gram filters.

Every language has a Bloom filter of the character n-grams that are typical
of it. The filters are bit-sliced: slot s of all filters lies in one word whose
bit l belongs to language l, so that one AND over the k slots of an n-gram
returns all languages that contain it. Of a document, the set bits are counted
for each language; the count is corrected for the filter's false positives
(observed = true + (all - true) * rate), and the largest corrected count decides.

An n-gram belongs to a language if its rate there is at least `share` of its
highest rate in any language, and it was seen `least` times. Short foreign
passages inside documents therefore don't fill the filters of other languages,
however large the sample is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.llm.common import beside, mix, prepare_llm, remainder, stored, takes_over, text_blocks

UNKNOWN = "und"
GRAMS = (2, 3, 4)
HASHES = 2
#: Characters that are looked at together; the arrays made of them are some sixty times as large.
TOGETHER = 1 << 17


@dataclass
class LanguageFilter:
    """languages[l] is bit l % 64 of word l // 64; slots has shape (words, 2**bits)."""

    languages: list[str]
    slots: np.ndarray
    false_rate: np.ndarray


_tables: dict[str, np.ndarray] = {}


def _letters() -> np.ndarray:
    """For every code point its lower-case letter, or 0 if it is no letter."""
    takes_over("language_id", lambda: None)
    if "letters" not in _tables:
        known = np.zeros(0x110000, np.uint32)
        for point in range(0x110000):
            c = chr(point)
            if c.isalpha():
                low = c.lower()
                known[point] = ord(low[0])
        _tables["letters"] = known
    return _tables["letters"]


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all texts with a 0 before, between and after them; where each text starts."""
    joined = "\0" + "\0".join(texts) + "\0\0\0\0"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.cumsum([0] + [len(t) + 1 for t in texts])
    return _letters()[points], starts


def grams_of(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each n: hashes at all positions, which are n-grams of one padded word, and where each text starts."""
    codes, starts = _codes(texts)
    letter = codes != 0
    wide = codes.astype(np.uint64)
    end = int(starts[-1])
    for n in GRAMS:
        value = wide[:end].copy()
        valid = letter[: end] | letter[1 : end + 1] if n == 2 else letter[1 : end + 1].copy()
        for j in range(1, n):
            value *= np.uint64(0x100000001B3 + 2 * n)
            value += wide[j : j + end]
            if n > 2 and 1 < j < n - 1:
                valid &= letter[j : j + end]
        yield mix(value), valid, starts


def _pieces(text: str, most: int = 1 << 20) -> Iterator[str]:
    """Parts of a long text that together have the same n-grams, but for those across the few cuts."""
    for at in range(0, max(1, len(text)), most):
        yield text[at : at + most]


def _count(languages: list[str]):
    place = {name: i for i, name in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def merged(parts):
            keys = np.concatenate([p[0] for p in parts])
            unique, back = np.unique(keys, return_inverse=True)
            return unique, np.bincount(back, np.concatenate([p[1] for p in parts])).astype(np.int64)

        for batch in batches:
            by: dict[int, list[str]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by.setdefault(place[lang], []).extend(_pieces(text))
            for lang, texts in by.items():
                for block in text_blocks(texts, TOGETHER):
                    for hashes, valid, _ in grams_of([texts[i] for i in block]):
                        unique, counts = np.unique(hashes[valid], return_counts=True)
                        held.setdefault(lang, []).append((unique, counts))
                if sum(len(p[0]) for p in held[lang]) > 2_000_000:
                    held[lang] = [merged(held[lang])]
        for lang, parts in held.items():
            unique, counts = merged(parts)
            for at in range(0, len(unique), 100_000):
                part = slice(at, at + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(unique[part]), lang, np.int32)), pa.array(unique[part].view(np.int64)), pa.array(counts[part])], names=["lang", "gram", "n"])

    return run


def _slots(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    mask = np.uint64((1 << bits) - 1)
    return [((hashes >> np.uint64(j * 21)) & mask).astype(np.int64) for j in range(HASHES)]


def fit(docs: DataFrame, docs_per_language: int = 1500, bits: int = 20, share: float = 0.5, least: int = 3) -> LanguageFilter:
    """Learn the filters from the columns doc_id, text and lang; rows without text or lang don't count.

    At most about `docs_per_language` documents of a language are read (chosen
    by a hash of doc_id, whole texts); what reaches the driver are at most
    2**bits slots, whatever the size of the corpus.
    """
    spark = prepare_llm(docs.sparkSession)
    known = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where("text is not null and lang is not null")
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return LanguageFilter([], np.zeros((1, 1 << bits), np.uint8), np.zeros(0))
    rate = F.create_map(*[F.lit(x) for name in languages for x in (name, min(1.0, docs_per_language / sizes[name]))])
    chosen = known.where(F.pmod(F.xxhash64(F.col("doc_id")), F.lit(1_000_003)) < rate[F.col("lang")] * 1_000_003)
    counts = stored(
        chosen.select("lang", "text").mapInArrow(_count(languages), "lang int, gram long, n long").groupBy("gram", "lang").agg(F.sum("n").alias("n")), "grams"
    )
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    if not totals:
        return LanguageFilter(languages, np.zeros((1, 1 << bits), np.uint8), np.zeros(len(languages)))
    total = F.create_map(*[F.lit(x) for pair in sorted(totals.items()) for x in (pair[0], float(pair[1]))])
    rated = counts.withColumn("rate", F.col("n") / total[F.col("lang")])
    best = rated.groupBy("gram").agg(F.max("rate").alias("best"), F.collect_list(F.struct("lang", "n", "rate")).alias("each"))
    typical = best.select("gram", "best", F.explode("each").alias("e")).where((F.col("e.n") >= least) & (F.col("e.rate") >= share * F.col("best"))).select("gram", "e.lang")

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, lang = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), batch.column(1).to_numpy(zero_copy_only=False)
            bit = np.uint64(1) << (lang % 64).astype(np.uint64)
            for at in _slots(grams, bits):
                yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array((lang // 64).astype(np.int32)), pa.array(bit.view(np.int64))], names=["slot", "word", "bit"])

    filled = typical.mapInArrow(slots, "slot int, word int, bit long").groupBy("slot", "word").agg(F.expr("bit_or(bit)").alias("bit")).toArrow()
    words = (len(languages) + 63) // 64
    kind = next(k for k, n in ((np.uint8, 8), (np.uint16, 16), (np.uint32, 32), (np.uint64, 64)) if len(languages) <= n or n == 64)
    held = np.zeros((words, 1 << bits), np.uint64)
    held[filled.column("word").to_numpy(), filled.column("slot").to_numpy()] = filled.column("bit").to_numpy().view(np.uint64)
    full = np.array([np.mean((held[i // 64] >> np.uint64(i % 64)) & np.uint64(1)) for i in range(len(languages))])
    return LanguageFilter(languages, held.astype(kind), full**HASHES)


def _tally(model: LanguageFilter, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For each text, the number of its n-grams and, by language, of those found in its filter."""
    total, found = np.zeros(len(texts), np.int64), np.zeros((len(texts), len(model.languages)), np.int64)
    bits = model.slots.shape[1].bit_length() - 1
    for hashes, valid, starts in grams_of(texts):
        at = _slots(hashes, bits)
        total += np.add.reduceat(valid.astype(np.int64), starts[:-1])
        for word in range(len(model.slots)):
            mask = model.slots[word][at[0]]
            for other in at[1:]:
                mask &= model.slots[word][other]
            mask[~valid] = 0
            for lang in range(word * 64, min(len(model.languages), word * 64 + 64)):
                found[:, lang] += np.add.reduceat(((mask >> mask.dtype.type(lang % 64)) & mask.dtype.type(1)), starts[:-1], dtype=np.int64)
    return total, found


def judge(model: LanguageFilter, texts: list[str | None]) -> list[tuple[str, float, float]]:
    """(language, score, coverage) of each text; the whole text counts, in parts of a bounded size."""
    parts, owner = [], []
    for i, text in enumerate(texts):
        for piece in _pieces(text or ""):
            parts.append(piece)
            owner.append(i)
    total, found = np.zeros(len(texts), np.int64), np.zeros((len(texts), len(model.languages)), np.int64)
    of = np.array(owner, np.int64)
    for block in text_blocks(parts, TOGETHER):
        n, hits = _tally(model, [parts[i] for i in block])
        np.add.at(total, of[block], n)
        np.add.at(found, of[block], hits)
    true = np.maximum(0, (found - total[:, None] * model.false_rate) / np.maximum(1e-9, 1 - model.false_rate))
    out = []
    for i in range(len(texts)):
        if not total[i] or not model.languages:
            out.append((UNKNOWN, 0.0, 0.0))
            continue
        best = int(np.argmax(true[i]))
        whole = float(true[i].sum())
        out.append((model.languages[best], float(true[i, best] / whole) if whole else 0.0, float(min(1.0, true[i, best] / total[i]))))
    return out


def identify(docs: DataFrame, model: LanguageFilter, keep: list[str] | None = None) -> DataFrame:
    """Each row (`row`, a struct of its columns or of `keep`) and `made`: lang_pred, score, coverage.

    * lang_pred: a learned language; `und` if the text is null or has no letter,
      or nothing was learned. Equal counts go to the first name in order.
    * score (0 to 1): the language's share of all corrected counts.
    * coverage (0 to 1): which share of the n-grams its filter knows.

    One pass without a shuffle; repeated rows get the same answer each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        for texts in batches:
            found = judge(shared.value, texts)
            yield {"lang_pred": [f[0] for f in found], "score": [f[1] for f in found], "coverage": [f[2] for f in found]}

    return beside(docs, "text", "lang_pred string, score double, coverage double", work, keep)


def held_out(identifier: str = "doc_id"):
    """Documents whose language is not learned from."""
    return remainder(F.col(identifier), 4) == 2
