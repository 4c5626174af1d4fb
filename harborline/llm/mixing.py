"""Mixing sources to target weights with soft membership.

A classifier learned from the labels table says how likely a document belongs
to each domain (a value of a label column). For every document a rate r >= 0
is fitted, such that the expected tokens of each domain, the sum of
rate * tokens * posterior, meet the targets: least squares over all rates,
by projected gradient steps that start at rate 1.

A step needs one sum per domain over all documents, which Spark computes in one
pass over a narrow table of (tokens, posteriors). Rates aren't stored between
steps: a rate follows from the document's posteriors and the steps so far, so
each pass repeats the few steps of each document. Residuals are scaled by the
inverse Gram matrix of the posteriors, which makes a step of length 1 safe and
the way short.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.llm.common import beside, prepare_llm, stored, takes_over

FEATURES = 12
_CLASS = np.zeros(256, np.uint8)
for _bytes, _kind in ((range(65, 91), 1), (range(97, 123), 2), (range(48, 58), 3), (b" \t\r\x0b\x0c", 4), (b"\n", 5), (b".,;:'\"()-", 6), (range(128, 256), 7)):
    _CLASS[list(_bytes)] = _kind


def style(text: str | None) -> tuple[int, list[float]]:
    """White-space tokens of a text, and how it is written: shares of kinds of characters, repeats, lengths."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if not n:
        return 0, [0.0] * FEATURES
    kinds = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=8) / len(raw)
    lines = raw.split(b"\n")
    lengths = np.fromiter(map(len, words), np.int64, n)
    return n, [
        *kinds[[0, 1, 2, 3, 6, 7]].tolist(), len(set(words)) / n, len(set(lines)) / len(lines), float(np.log1p(n)), float(lengths.mean()) / 10, float((lengths > 20).mean()), len(lines) / n,
    ]


@dataclass
class Domains:
    """Softmax regression on standardised style features."""

    names: list[str]
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray

    def posteriors(self, features: np.ndarray) -> np.ndarray:
        x = np.clip((features - self.mean) / self.spread, -6, 6)
        z = np.hstack([x, x**2, np.ones((len(x), 1))]) @ self.weights
        p = np.exp(z - z.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)


def _styles(texts: list[str | None]) -> list[tuple[int, list[float]]]:
    takes_over("mixing", lambda: None)  # keeps nothing itself
    return [style(t) for t in texts]


def fit_domains(docs: DataFrame, labels: DataFrame, column: str = "quality", rows: int = 20_000) -> Domains:
    """Learn the domains from docs (doc_id, text) and labels (doc_id, a column of labels).

    At most about `rows` labelled documents are read, chosen by a hash of doc_id; the driver gets
    their dozen features each. Null labels are left out; of several labels of a document the
    largest counts. Without labels there is one domain, `all`.
    """
    spark = prepare_llm(docs.sparkSession)
    label = labels.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(F.col(column).cast("string")).alias("domain"))
    there = docs.select("doc_id").join(label, "doc_id").distinct()
    share = min(1.0, rows / max(1, there.count()))
    # about `rows` ids at most, so they may go to every task; no text is shuffled
    ids = there.where(F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(1_000_003)) < share * 1_000_003)
    chosen = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(ids), "doc_id").select("text", "domain")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([x for _, x in _styles(batch.column(0).to_pylist())], pa.list_(pa.float64()))], names=["domain", "x"])

    got = chosen.mapInArrow(features, "domain string, x array<double>").orderBy("domain", "x").toArrow()
    if not got.num_rows:
        return Domains(["all"], np.zeros(FEATURES), np.ones(FEATURES), np.zeros((2 * FEATURES + 1, 1)))
    x = np.array(got.column("x").to_pylist())
    names, y = np.unique(np.array(got.column("domain").to_pylist(), str), return_inverse=True)
    model = Domains(names.tolist(), x.mean(0), np.maximum(x.std(0), 1e-6), np.zeros((2 * FEATURES + 1, len(names))))
    scaled = np.clip((x - model.mean) / model.spread, -6, 6)
    design, target = np.hstack([scaled, scaled**2, np.ones((len(x), 1))]), np.eye(len(names))[y]
    step = 1 / (0.5 * np.linalg.eigvalsh(design.T @ design / len(x))[-1] + 1e-4)
    ahead = w = model.weights
    for t in range(500):
        z = design @ ahead
        p = np.exp(z - z.max(1, keepdims=True))
        gradient = design.T @ (p / p.sum(1, keepdims=True) - target) / len(x) + 1e-4 * ahead
        new = ahead - step * gradient
        ahead, w = new + t / (t + 3) * (new - w), new
    model.weights = w
    return model


def memberships(docs: DataFrame, model: Domains, keep: list[str] | None = None) -> DataFrame:
    """Each row (`row`) with `made`: tokens and posteriors (one for each of the model's names)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        for texts in batches:
            made = _styles(texts)
            p = shared.value.posteriors(np.array([m[1] for m in made]))
            yield {"tokens": [m[0] for m in made], "posteriors": p.tolist()}

    return beside(docs, "text", "tokens long, posteriors array<double>", work, keep)


def rate_of(posteriors: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Rates after the steps: each moves a rate along the posteriors and projects it to 0 or more."""
    rate = np.ones(len(posteriors))
    for step in steps:
        rate = np.maximum(0.0, rate - posteriors @ step)
    return rate


def fit_rates(members: DataFrame, domains: int, targets: np.ndarray, most: int = 60, close: float = 1e-6) -> np.ndarray:
    """The steps (one row of `domains` numbers each) whose rates meet the targets.

    members: tokens, posteriors. targets: each domain's share of all tokens kept; they needn't sum
    to 1, and a domain that no document can stand for is met as well as possible.
    """

    def sums(steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            reached, gram = np.zeros(domains), np.zeros((domains, domains))
            for batch in batches:
                if not batch.num_rows:
                    continue
                tokens = batch.column(0).to_numpy(zero_copy_only=False).astype(float)
                p = np.asarray(batch.column(1).flatten()).reshape(-1, domains)
                rate = rate_of(p, steps)
                reached += p.T @ (tokens * rate)
                gram += (p * (tokens * (rate > 0))[:, None]).T @ p
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(domains * (domains + 1), dtype=np.int32)), pa.array(np.concatenate([reached, gram.ravel()]))], names=["k", "v"])

        got = members.select("tokens", "posteriors").mapInArrow(part, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).toArrow()
        flat = np.zeros(domains * (domains + 1))
        flat[got.column("k").to_numpy()] = got.column("v").to_numpy()
        return flat[:domains], flat[domains:].reshape(domains, domains)

    steps = np.zeros((0, domains))
    reached, gram = sums(steps)
    goal = targets * reached.sum()
    for _ in range(most):
        gap = reached - goal
        if np.abs(gap).sum() <= close * max(1.0, goal.sum()):
            break
        ridge = 1e-9 * max(1e-12, np.trace(gram)) * np.eye(domains)
        steps = np.vstack([steps, np.linalg.solve(gram + ridge, gap)])
        reached, gram = sums(steps)
    return steps


def mix_to_targets(docs: DataFrame, labels: DataFrame, targets: dict[str, float], column: str = "quality", keep: list[str] | None = None) -> DataFrame:
    """Each row (`row`) with `made`: tokens, posteriors, rate and copies.

    rate: how often the document is to be shown, 0 or more; copies: the rate rounded up or down by a
    hash of doc_id, so that it is right in expectation and repeatable. Targets of domains that the
    labels don't name are ignored, named domains without a target get what remains of 1 in equal
    parts. Texts without words have no tokens and rate as their posteriors say; repeated rows count
    each. The narrow table of memberships is written to the shared folder once; the documents are
    read twice and never shuffled.
    """
    model = fit_domains(docs, labels, column)
    missing = [n for n in model.names if n not in targets]
    rest = max(0.0, 1 - sum(targets.get(n, 0.0) for n in model.names)) / max(1, len(missing))
    goal = np.array([targets.get(n, rest) for n in model.names])
    goal = goal / goal.sum() if goal.sum() > 0 else np.full(len(goal), 1 / len(goal))
    narrow = stored(memberships(docs.select("text"), model, []).select("made.*"), "memberships")
    steps = fit_rates(narrow, len(model.names), goal)
    shared = docs.sparkSession.sparkContext.broadcast((model, steps))

    def work(batches):
        model, steps = shared.value
        for texts in batches:
            made = _styles(texts)
            p = model.posteriors(np.array([m[1] for m in made]))
            yield {"tokens": [m[0] for m in made], "posteriors": p.tolist(), "rate": rate_of(p, steps).tolist()}

    rated = beside(docs, "text", "tokens long, posteriors array<double>, rate double", work, list({*(keep if keep is not None else docs.columns), "doc_id"}) if keep is not None else None)
    draw = F.pmod(F.xxhash64(F.lit(33), F.col("row.doc_id")), F.lit(1_000_003)) / F.lit(1_000_003.0)
    copies = (F.floor("made.rate") + (draw < F.col("made.rate") - F.floor("made.rate")).cast("int")).cast("int")
    return rated.withColumn("made", F.col("made").withField("copies", copies))
