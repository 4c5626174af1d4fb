"""Fill-in-the-middle by displacement scatter.

A text is cut between units (lines); prefix, middle and suffix then stand in
another order between marks. All texts of a batch lie in one run of bytes. A
scan finds the cuts, each segment's displacement (place in the output less
place in the input) enters a difference array at its first byte, a cumulative
sum gives every byte its place, and one numpy scatter writes the output. The
way back reads the cuts off the marks and gathers by the same places.

Nothing is shuffled: a row's choice of cuts and form comes from a hash of its
key, so a repeated task writes the same bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborline.llm.common import prepare_llm

MARKS = ("<P>", "<S>", "<M>")
#: Texts are worked on in blocks of so many bytes (a longer text stands alone), places in windows of so many.
BLOCK, WINDOW = 4 << 20, 1 << 20
_MADE = "n long, form string, prefix_chars long, middle_chars long, output string"


def hashes(key: Column, seed: int = 7) -> list[Column]:
    """Four unsigned 32-bit numbers: the first groups of the hex SHA-256 of `seed:key` (a null key counts as no characters)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def check_marks(marks: tuple[str, str, str]) -> list[bytes]:
    """The marks as bytes, if a mark can't be part of another or begin inside one: then every cut can be read back."""
    raw = [m.encode() for m in marks]
    if len(set(raw)) < 3 or not all(raw):
        raise ValueError("three different marks are needed")
    for a in raw:
        for b in raw:
            if a != b and a in b or any(a[-k:] == b[:k] for k in range(1, min(len(a), len(b)))):
                raise ValueError(f"marks {a!r} and {b!r} can overlap")
    return raw


def _places(starts: np.ndarray, moves: np.ndarray, length: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """Windows (from, to, place of every byte): the running sum of a difference array over all bytes.

    starts: ascending first bytes of the segments; moves: their displacements.
    """
    jumps = np.diff(moves, prepend=0)
    carry = -1
    for a in range(0, length, WINDOW):
        b = min(length, a + WINDOW)
        step = np.ones(b - a, np.int64)
        lo, hi = np.searchsorted(starts, [a, b])
        np.add.at(step, starts[lo:hi] - a, jumps[lo:hi])
        place = np.cumsum(step)
        place += carry
        carry = int(place[-1])
        yield a, b, place


def scatter(data: np.ndarray, starts: np.ndarray, moves: np.ndarray, out: np.ndarray) -> None:
    """Write every byte of `data` to its place in `out`."""
    for a, b, place in _places(starts, moves, len(data)):
        out[place] = data[a:b]


def gather(out: np.ndarray, starts: np.ndarray, moves: np.ndarray, length: int) -> np.ndarray:
    """The bytes that `scatter` wrote, in their old order."""
    data = np.empty(length, np.uint8)
    for a, b, place in _places(starts, moves, length):
        data[a:b] = out[place]
    return data


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a binary column in one run, and the ends of each; null counts as empty."""
    column = column.fill_null(b"")
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[ends[0] : ends[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, ends - ends[0]


def _strings(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.string(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])


def _blocks(ends: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most so many bytes together."""
    a = 0
    while a < len(ends) - 1:
        b = max(a + 1, int(np.searchsorted(ends, ends[a] + most, "right")) - 1)
        yield a, b
        a = b


def _segments(places: np.ndarray, sizes: np.ndarray, order: np.ndarray, heads: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Displacements of three segments a text: `order` tells which comes first, second and third behind the marks `heads`."""
    rows = np.arange(len(sizes))
    at, moves = begin.copy(), np.empty_like(places)
    for turn in range(3):
        which = order[:, turn]
        at += heads[:, turn]
        moves[rows, which] = at - places[rows, which]
        at += sizes[rows, which]
    return moves


#: Which segment (0 prefix, 1 middle, 2 suffix) comes first, second, third; the mark before a segment has its name's place.
_ORDER = {"plain": (0, 1, 2), "psm": (0, 2, 1), "spm": (2, 0, 1)}
_MARK_OF = (0, 2, 1)  # of MARKS: prefix, middle, suffix


def _transformed(data: np.ndarray, ends: np.ndarray, h: np.ndarray, rate: int, spm: int, marks: list[bytes]) -> dict:
    """The columns of _MADE for one block of texts."""
    count = len(ends) - 1
    first, last = ends[:-1], ends[1:]
    lines = np.flatnonzero(data == 10) + 1  # a unit ends behind each
    before = np.searchsorted(lines, first, "right")
    whole = np.searchsorted(lines, last, "right") - before
    tail = (last > first) & ~((whole > 0) & (lines[np.maximum(before + whole - 1, 0)] == last) if len(lines) else np.zeros(count, bool))
    n = whole + tail
    cut = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)

    def byte_at(k: np.ndarray) -> np.ndarray:
        at = np.where(k > whole, last, first)
        inner = (k > 0) & (k <= whole)
        at[inner] = lines[before[inner] + k[inner] - 1]
        return at

    one, two = byte_at(cut[:, 0]), byte_at(cut[:, 1])
    marked = np.zeros(count, bool)
    for hit in re.finditer(b"|".join(map(re.escape, marks)), data):
        text = int(np.searchsorted(last, hit.start(), "right"))
        if hit.end() <= last[text]:
            marked[text] = True
    plain = (last == first) | marked | (h[:, 2] % 100 >= rate)
    form = np.where(plain, "plain", np.where(h[:, 3] % 100 < spm, "spm", "psm"))
    one[plain], two[plain] = last[plain], last[plain]  # one segment
    places = np.stack([first, one, two], axis=1)
    sizes = np.stack([one - first, two - one, last - two], axis=1)
    order = np.array([_ORDER[f] for f in form], np.int64).reshape(count, 3)
    widths = np.array([len(marks[m]) for m in _MARK_OF], np.int64)
    heads = np.where(plain[:, None], 0, widths[order])
    out_ends = np.concatenate([[0], np.cumsum(sizes.sum(1) + heads.sum(1))])
    moves = _segments(places, sizes, order, heads, out_ends[:-1])
    out = np.empty(int(out_ends[-1]), np.uint8)
    scatter(data, places.ravel(), moves.ravel(), out)
    for segment, mark in zip(range(3), (marks[m] for m in _MARK_OF)):
        ahead = (places + moves)[~plain, segment]
        for i, byte in enumerate(mark):
            out[ahead - len(mark) + i] = byte
    begins = (data & 0xC0) != 0x80  # a code point each
    chars = [None if p else (int(np.count_nonzero(begins[a:b])), int(np.count_nonzero(begins[b:c]))) for p, a, b, c in zip(plain, first, one, two)]
    return {
        "n": pa.array(n, pa.int64()), "form": pa.array(form.tolist(), pa.string()),
        "prefix_chars": pa.array([x and x[0] for x in chars], pa.int64()), "middle_chars": pa.array([x and x[1] for x in chars], pa.int64()),
        "output": _strings(out, out_ends),
    }


def _restored(out: np.ndarray, ends: np.ndarray, forms: list[str | None], marks: list[bytes]) -> pa.Array:
    """The texts of one block, from outputs and forms alone."""
    count = len(forms)
    first, last = ends[:-1], ends[1:]
    order = np.array([_ORDER[f or "plain"] for f in forms], np.int64).reshape(count, 3)
    plain = np.array([f in (None, "plain") for f in forms], bool)
    widths = np.array([len(marks[m]) for m in _MARK_OF], np.int64)
    stands, sizes = np.repeat(last[:, None], 3, axis=1), np.zeros((count, 3), np.int64)
    stands[plain, 0], sizes[plain, 0] = first[plain], (last - first)[plain]
    for i in np.flatnonzero(~plain):
        raw, at = out[first[i] : last[i]].tobytes(), 0
        for turn, which in enumerate(order[i]):
            mark = marks[_MARK_OF[which]]
            found = raw.find(mark, at)
            if found < 0 or (turn == 0 and found):
                raise ValueError(f"output isn't of form {forms[i]}: no {mark!r} where one must stand")
            if turn:
                before = order[i][turn - 1]
                sizes[i, before] = first[i] + found - stands[i, before]
            at = found + widths[which]
            stands[i, which] = first[i] + at
        sizes[i, order[i][2]] = last[i] - stands[i, order[i][2]]
    text_ends = np.concatenate([[0], np.cumsum(sizes.sum(1))])
    places = text_ends[:-1, None] + np.cumsum(sizes, axis=1) - sizes
    return _strings(gather(out, places.ravel(), (stands - places).ravel(), int(text_ends[-1])), text_ends)


def _schema(packed: DataFrame, made: str) -> T.StructType:
    return T.StructType([packed.schema["row"], T.StructField("made", T._parse_datatype_string(f"struct<{made}>"))])


def _beside(rows: pa.Array, made: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([rows, pa.StructArray.from_arrays(list(made.values()), names=list(made))], names=["row", "made"])


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text", rate: int = 100, spm: int = 50, marks: tuple[str, str, str] = MARKS, seed: int = 7, keep: list[str] | None = None) -> DataFrame:
    """`row` (the row, or its columns `keep`) and `made`: n, form, prefix_chars, middle_chars, output.

    A text of n lines is cut behind two of them chosen by the hash of its key. Of 100 texts `rate` are
    transformed, and of those `spm` begin with the suffix (form spm), the others with the prefix (psm).
    Form plain is the text itself: an empty or null text, one that holds a mark, or one beyond the rate; its
    prefix_chars and middle_chars are null, else they count code points. Equal keys have equal choices; a
    null key counts as no characters. Columns of any name pass inside `row`.
    """
    prepare_llm(docs.sparkSession)
    raw = check_marks(marks)
    columns = docs.columns if keep is None else keep
    h = hashes(F.col(f"`{key}`"), seed)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(f"`{text}`").cast("string").cast("binary").alias("text"), *[x.alias(f"h{i}") for i, x in enumerate(h)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = _bytes_of(batch.column(1))
            chosen = np.stack([batch.column(2 + i).to_numpy(zero_copy_only=False) for i in range(4)], axis=1)
            for a, b in _blocks(ends, BLOCK):
                made = _transformed(data[ends[a] : ends[b]], ends[a : b + 1] - ends[a], chosen[a:b], rate, spm, raw)
                yield _beside(batch.column(0).slice(a, b - a), made)

    return packed.mapInArrow(run, _schema(packed, _MADE))


def restore(frame: DataFrame, output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """`row` (the whole row) and `made.text`: the exact texts behind outputs of `transform`. A null form counts as plain, a null output as empty."""
    prepare_llm(frame.sparkSession)
    raw = check_marks(marks)
    packed = frame.select(F.struct(*[F.col(f"`{c}`") for c in frame.columns]).alias("row"), output.cast("binary").alias("output"), form.alias("form"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, ends = _bytes_of(batch.column(1))
            forms = batch.column(2).to_pylist()
            for a, b in _blocks(ends, BLOCK):
                yield _beside(batch.column(0).slice(a, b - a), {"text": _restored(out[ends[a] : ends[b]], ends[a : b + 1] - ends[a], forms[a:b], raw)})

    return packed.mapInArrow(run, _schema(packed, "text string"))
