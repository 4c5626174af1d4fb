"""SentencePiece encoding by a max-plus scan, and decoding.

Encoding finds the best path through the lattice of vocabulary pieces. Seen as
a product of max-plus matrices it is associative, so a giant document is cut
into chunks: each chunk gives the matrix from the boundary states at its start
(how many characters the first piece boundary lies behind the cut) to those at
its end; the matrices of a document are multiplied in order; then each chunk is
traced back on its own, from its best scores at the start to its state at the
end. Scores are whole numbers, so that no grouping changes a result, and of
equally good paths the one with the longer last piece wins everywhere, so the
ids don't depend on the size of chunks.

A place that no piece crosses (before a space, around a newline) forces a
boundary. Between two such places text is short and repeats, and is encoded
once per task; a chunk with a forced boundary has a matrix of rank one.

A model of type unigram is used with its own scores. The scores of a BPE model
are merge ranks; piece number r then gets the logarithm of Zipf's law, 1 / (r + 1).
Characters without a piece, and a literal U+2581, are spelled in byte pieces, so
that decoding gives the exact text back.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.llm.common import beside, prepare_llm, stored, takes_over, text_blocks

SPACE = "▁"
CHUNK = 32_768
SCALE = 1_000_000
NONE = -(1 << 60)
_vocabularies: dict[str, Vocabulary] = {}


class Vocabulary:
    """Pieces with whole-number scores, byte pieces, and where a boundary is forced."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        ranks = sorted(plain, key=lambda i: (-model.get_score(i), i))
        rank_scores = [model.get_score(i) for i in ranks]
        is_rank = all(float(s).is_integer() for s in rank_scores) and min(rank_scores, default=0) < -100
        total = math.log(sum(1 / (r + 1) for r in range(len(ranks) + 256)))
        log = {i: -math.log(r + 1) - total for r, i in enumerate(ranks)} if is_rank else {i: model.get_score(i) for i in plain}
        self.pieces: dict[str, int] = {}
        self.score: dict[str, int] = {}
        for i in plain:
            piece = model.id_to_piece(i)
            self.pieces[piece], self.score[piece] = i, round(log[i] * SCALE)
        self.byte_id = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        rarest = min(self.score.values(), default=0) - SCALE
        self.byte_score = [rarest] * 256
        self.longest = max(map(len, self.pieces), default=1)
        self.log = {**{i: log[i] for i in plain}, **{i: rarest / SCALE for i in self.byte_id}}
        self.spelled = [b""] * size
        for piece, i in self.pieces.items():
            self.spelled[i] = piece.replace(SPACE, " ").encode("utf-8", "surrogatepass")
        for b, i in enumerate(self.byte_id):
            self.spelled[i] = bytes([b])
        inner = any(SPACE in p.lstrip(SPACE) for p in self.pieces)
        newline = not any("\n" in p for p in self.pieces)
        #: Units between forced boundaries; without a safe place the whole text is one unit.
        cut = r" *[^ \n]+| +|\n" if newline else r" *[^ ]+| +"
        self.units = re.compile(r"(?s).+" if inner else cut)
        #: Ids of units, as bytes of 32-bit numbers: small, and joined without a step per id.
        self.memo: dict[str, bytes] = {}
        self.id_score = np.zeros(size, np.int64)
        for piece, i in self.pieces.items():
            self.id_score[i] = self.score[piece]
        self.id_score[self.byte_id] = self.byte_score
        self.trie: tuple[np.ndarray, ...] | None = None
        known = "".join(re.escape(p) for p in self.pieces if len(p) == 1 and 128 <= ord(p) < 0x250)
        self.plain = re.compile(rf"[\x00-\x7f{known}]{{1,64}}")
        #: Every beginning of a piece, with the score if it is a piece itself.
        self.prefixes: dict[str, int | None] = {p[:k]: None for p in self.pieces for k in range(1, len(p))} | self.score
        self.reach: dict[str, int] = {}
        for piece in self.pieces:
            self.reach[piece[0]] = max(self.reach.get(piece[0], 1), len(piece))

    def arcs(self, text: str, at: int) -> Iterator[tuple[int, int]]:
        """(end, score) of the pieces that start here; a character without a piece is spelled in bytes."""
        first = text[at]
        if first == SPACE:
            yield at + 1, sum(self.byte_score[b] for b in SPACE.encode())
            return
        symbol = SPACE if first == " " else first
        score, alone = self.score, False
        for end in range(at + 1, min(len(text), at + self.reach.get(symbol, 1)) + 1):
            if text[end - 1] == SPACE:
                break
            found = score.get(text[at:end].replace(" ", SPACE))
            if found is not None:
                alone |= end == at + 1
                yield end, found
        if not alone:
            yield at + 1, sum(self.byte_score[b] for b in first.encode("utf-8", "surrogatepass"))

    def ids_of(self, text: str, at: int, end: int) -> list[int]:
        part = text[at:end]
        if SPACE not in part:
            found = self.pieces.get(part.replace(" ", SPACE) if part[0] == " " else part)
            if found is not None:
                return [found]
        return [self.byte_id[b] for b in text[at:end].encode("utf-8", "surrogatepass")]

    def forward(self, text: str, start: list[int], stop: int) -> tuple[list[int], list[int]]:
        """Best scores at places 0 .. stop + longest - 1 from the scores `start` at the first places, and from where."""
        n = min(len(text), stop + self.longest - 1)
        best, back = [NONE] * (n + 1), [-1] * (n + 1)
        for i, s in enumerate(start[: n + 1]):
            best[i] = s
        for at in range(min(stop, n)):
            here = best[at]
            if here == NONE:
                continue
            for end, score in self.arcs(text, at):
                if end <= n and here + score > best[end]:  # equal scores keep the earlier start: the longer piece
                    best[end], back[end] = here + score, at
        return best, back

    def unit(self, text: str) -> list[int]:
        """Ids of a text between forced boundaries."""
        n, plain = len(text), text
        if SPACE in text:
            best, back = self.forward(text, [0], n)
        else:
            text = text.replace(" ", SPACE)
            best, back, prefixes, missing = [NONE] * (n + 1), [-1] * (n + 1), self.prefixes, 0
            best[0] = 0
            for at in range(n):
                here, end = best[at], at + 1
                while end <= n:
                    found = prefixes.get(text[at:end], missing)
                    if found is missing:
                        break
                    if found is not None and here + found > best[end]:
                        best[end], back[end] = here + found, at
                    end += 1
                if prefixes.get(text[at], None) is None:
                    cost = here + sum(self.byte_score[b] for b in plain[at].encode("utf-8", "surrogatepass"))
                    if cost > best[at + 1]:
                        best[at + 1], back[at + 1] = cost, at
        parts, at = [], n
        while at > 0:
            parts.append((back[at], at))
            at = back[at]
        return [i for a, b in reversed(parts) for i in self.ids_of(plain, a, b)]

    def _trie(self) -> tuple[np.ndarray, ...]:
        """Pieces of plain characters (a space stands for U+2581): next node by letter, score and id of each node, letters."""
        plain = {p.replace(SPACE, " "): i for p, i in self.pieces.items() if " " not in p}
        plain = {p: i for p, i in plain.items() if self.plain.fullmatch(p)}
        alphabet = sorted({chr(c) for c in range(128)}.union(*plain))  # begins with ASCII
        letter = np.zeros(0x250, np.int16)
        letter[[ord(c) for c in alphabet]] = np.arange(len(alphabet))
        nodes = {p: n for n, p in enumerate(["", *sorted({p[:k] for p in plain for k in range(1, len(p) + 1)})], 1)}  # 0: no such prefix
        after = np.zeros((len(nodes) + 1, len(alphabet)), np.int32)
        score, piece = np.full(len(nodes) + 1, NONE, np.int64), np.full(len(nodes) + 1, -1, np.int32)
        for prefix, node in nodes.items():
            if prefix:
                after[nodes[prefix[:-1]], letter[ord(prefix[-1])]] = node
            if prefix in plain:
                score[node], piece[node] = self.score[prefix.replace(" ", SPACE)], plain[prefix]
        spelled = np.full(len(alphabet), NONE, np.int64)  # only ASCII letters can lack a piece
        spelled[:128] = self.byte_score[:128]
        spelled[score[after[1]] > NONE] = NONE
        return after, score, piece, letter, spelled, np.array(self.byte_id[:128], np.int32)

    def _units(self, units: list[str]) -> Iterator[tuple[str, bytes]]:
        """`unit` for many plain texts of similar length at once: the same comparisons in the same order."""
        if self.trie is None:
            self.trie = self._trie()
        after, scores, piece, letter, spelled, byte_id = self.trie
        n, width = len(units), max(map(len, units))
        codes = letter[np.frombuffer("".join([u.ljust(width, "\0") for u in units]).encode("utf-32-le"), np.uint32)].reshape(n, width)
        best, back, used = np.full((width + 1, n), NONE, np.int64), np.zeros((width + 1, n), np.int8), np.full((width + 1, n), -1, np.int32)
        best[0] = 0
        for at in range(width):
            rows, node = np.arange(n), np.ones(n, np.int32)
            for end in range(at + 1, min(width, at + self.longest) + 1):
                node = after[node, codes[rows, end - 1]]
                live = np.flatnonzero(node)
                rows, node = rows[live], node[live]
                if not len(rows):
                    break
                total = np.where(scores[node] > NONE, best[at, rows] + scores[node], NONE)
                better = np.flatnonzero(total > best[end, rows])
                to = rows[better]
                best[end, to], back[end, to], used[end, to] = total[better], at, piece[node[better]]
            code = codes[:, at]
            to = np.flatnonzero((spelled[code] > NONE) & (best[at] + spelled[code] > best[at + 1]))
            best[at + 1, to], back[at + 1, to], used[at + 1, to] = best[at, to] + spelled[code[to]], at, byte_id[code[to]]
        at, rows = np.array([len(u) for u in units]), np.arange(n)
        ids, many = np.zeros((n, width), np.int32), np.zeros(n, np.int64)
        while len(rows):
            many[rows] += 1
            ids[rows, width - many[rows]] = used[at[rows], rows]
            at[rows] = back[at[rows], rows]
            rows = rows[at[rows] > 0]
        raw, ends = ids.tobytes(), range(4 * width, 4 * width * (n + 1), 4 * width)
        for unit, end, size in zip(units, ends, (4 * many).tolist()):
            yield unit, raw[end - size : end]

    def learn(self, units: set[str]) -> None:
        """Put the ids of units into the memo."""
        fresh = units.difference(self.memo)
        plain = sorted(filter(self.plain.fullmatch, fresh), key=len) if len(fresh) > 20 else []
        for at in range(0, len(plain), 4096):
            self.memo.update(self._units(plain[at : at + 4096]))
        for unit in fresh.difference(plain):
            self.memo[unit] = np.array(self.unit(unit), np.int32).tobytes()

    def encode_all(self, texts: list[str]) -> list[tuple[np.ndarray, int]]:
        """Ids and score of each text, with the leading space already put before it."""
        takes_over("sentencepiece", _forget)
        if len(self.memo) > 400_000:
            self.memo.clear()
        units = [self.units.findall(text) for text in texts]
        every = set().union(*units)
        self.learn(every)
        ids = [np.frombuffer(b"".join(map(self.memo.__getitem__, u)), np.int32) for u in units]
        made = [(i, int(self.id_score[i].sum())) for i in ids]
        for unit in every:
            if len(unit) > 64:
                del self.memo[unit]
        return made

    def encode(self, text: str) -> tuple[np.ndarray, int]:
        """`encode_all` of one text."""
        return self.encode_all([text])[0]

    def decode(self, ids: list[int] | np.ndarray) -> str:
        """The text of the ids, without the space that encoding puts first; ids that stand for no text are left out."""
        ids = np.asarray(ids, np.int64)
        known = ids[(ids >= 0) & (ids < len(self.spelled))].tolist()
        raw = b"".join(map(self.spelled.__getitem__, known))
        text = raw.decode("utf-8", "surrogatepass") if b"\xed" in raw else raw.decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def _forget() -> None:
    for vocab in _vocabularies.values():
        vocab.memo.clear()
        vocab.trie = None


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a model file, loaded once in a process."""
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(path)
    return _vocabularies[path]


def forced(vocab: Vocabulary, text: str, stop: int) -> tuple[int, int]:
    """The first and the last forced boundary of a chunk, behind the states at its start; (0, 0) if there aren't two."""
    cuts = [m.start() for m in vocab.units.finditer(text, 0, stop + 1) if vocab.longest <= m.start() < stop]
    return (cuts[0], cuts[-1]) if len(cuts) >= 2 else (0, 0)


def walk(back: list[int], at: int) -> list[tuple[int, int]]:
    """The pieces (from, to) of the best path to a place, back to where it began."""
    parts = []
    while 0 <= at < len(back) and back[at] >= 0:
        parts.append((back[at], at))
        at = back[at]
    return parts[::-1]


def transfer(vocab: Vocabulary, text: str, stop: int) -> np.ndarray:
    """Max-plus matrix of a chunk: from place i at its start to place j behind its end (place `stop` of the text)."""
    states = vocab.longest
    out = np.full((states, states), NONE, np.int64)
    first, last = forced(vocab, text, stop)
    if first < last:  # entry side, the middle as one number, exit side
        middle = vocab.encode(text[first:last])[1]
        into = np.array([vocab.forward(text[:first], [NONE] * i + [0], first)[0][first] for i in range(states)])
        away = vocab.forward(text[last:], [0], stop - last)[0]
        away = np.array([away[stop - last + j] if stop - last + j < len(away) else NONE for j in range(states)])
        total = into[:, None] + middle + away[None, :]
        return np.where((into[:, None] > NONE) & (away[None, :] > NONE), total, NONE)
    for i in range(states):
        if i > len(text):
            break
        best = vocab.forward(text, [NONE] * i + [0], stop)[0]
        for j in range(states):
            if stop + j < len(best) and stop + j >= i:
                out[i, j] = best[stop + j]
    return out


def compose(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The max-plus product; NONE is its zero."""
    total = left[..., :, :, None] + right[..., None, :, :]
    total = np.where((left[..., :, :, None] > NONE) & (right[..., None, :, :] > NONE), total, NONE)
    return total.max(-2)


def _chunks(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = " " + text
                for no, at in enumerate(range(0, len(text), size)):
                    yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([no], pa.int32()), pa.array([min(size, len(text) - at)], pa.int32()), pa.array([text[at : at + size + 64]])], names=["key", "no", "stop", "text"])

    return run


def _giant(keyed: DataFrame, path: str, size: int) -> DataFrame:
    """(key, ids, score) of long texts (key, text), chunk by chunk; keys are unique."""
    spark = keyed.sparkSession
    chunks = stored(keyed.mapInArrow(_chunks(size), "key long, no int, stop int, text string").repartition("key", "no"), "chunks")

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            made = [transfer(vocab, t, s).ravel().tolist() for t, s in zip(batch.column(3).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.list_(pa.int64()))], names=["key", "no", "matrix"])

    def prefix(table: pa.Table) -> pa.Table:
        """Best scores at the start of every chunk: the running max-plus product over a document's matrices."""
        table = table.sort_by("no")
        states = vocabulary(path).longest
        now = np.full((1, states), NONE, np.int64)
        now[0, 0] = 0
        rows = []
        for flat in table.column("matrix"):
            rows.append(now[0].tolist())
            now = compose(now, np.array(flat.as_py(), np.int64).reshape(states, states))
        return pa.table({"key": table.column("key"), "no": table.column("no"), "start": pa.array(rows, pa.list_(pa.int64())), "total": pa.array([int(now[0, 0])] * len(rows), pa.int64())})

    starts = chunks.mapInArrow(matrices, "key long, no int, matrix array<long>").groupBy("key").applyInArrow(prefix, "key long, no int, start array<long>, total long")
    started = chunks.join(stored(starts, "starts"), ["key", "no"])

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each state at a chunk's end the state at its start that the best path came from."""
        vocab = vocabulary(path)
        for batch in batches:
            rows = []
            for start, stop, text in zip(*(batch.column(c).to_pylist() for c in ("start", "stop", "text"))):
                first, last = forced(vocab, text, stop)
                if first < last:  # every path runs through the first boundary
                    parts = walk(vocab.forward(text[:first], start, first)[1], first)
                    rows.append([parts[0][0] if parts else -1] * vocab.longest)
                    continue
                back = vocab.forward(text, start, stop)[1]
                row = []
                for at in range(stop, stop + vocab.longest):
                    parts = walk(back, at)
                    at = parts[0][0] if parts else at
                    row.append(at if at < vocab.longest else -1)
                rows.append(row)
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("no"), pa.array(rows, pa.list_(pa.int32()))], names=["key", "no", "entry"])

    def exits(table: pa.Table) -> pa.Table:
        """The state at each chunk's end: the entry maps of the later chunks, composed from the document's end."""
        table = table.sort_by([("no", "descending")])
        state, rows = 0, []
        for entry in table.column("entry").to_pylist():
            rows.append(state)
            state = entry[state]
        return pa.table({"key": table.column("key"), "no": table.column("no"), "leave": pa.array(rows, pa.int32())})

    ends = started.mapInArrow(entries, "key long, no int, entry array<int>").groupBy("key").applyInArrow(exits, "key long, no int, leave int")

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            rows = []
            for start, stop, text, leave in zip(*(batch.column(c).to_pylist() for c in ("start", "stop", "text", "leave"))):
                first, last = forced(vocab, text, stop)
                head = walk(vocab.forward(text[:first], start, first)[1], first) if first < last else []
                middle = vocab.encode(text[first:last])[0] if first < last else np.zeros(0, np.int32)
                away = text[last:] if first < last else text
                tail = walk(vocab.forward(away, [0] if first < last else start, stop - last)[1], stop - last + leave)
                sides = [np.array([i for a, b in parts for i in vocab.ids_of(source, a, b)], np.int32) for parts, source in ((head, text), (tail, away))]
                rows.append(np.concatenate([sides[0], middle, sides[1]]))
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("no"), batch.column("total"), pa.array(rows, pa.list_(pa.int32()))], names=["key", "no", "total", "ids"])

    traced = started.join(ends, ["key", "no"]).mapInArrow(trace, "key long, no int, total long, ids array<int>")
    whole = traced.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("no", "ids"))).alias("parts"), F.max("total").alias("score"))
    return whole.select("key", F.flatten(F.col("parts.ids")).alias("ids"), "score")


def encode(docs: DataFrame, path: str, keep: list[str] | None = None, chunk: int = CHUNK) -> DataFrame:
    """Each row (`row`, a struct of its columns or of `keep`) with `made`: ids and score.

    ids: piece ids of the whole text (null: empty; an empty text has none), score: the path's natural
    log score. Texts longer than `chunk` characters take the scan over chunks; a chunk is at least
    twice as long as the longest piece. Other rows take one pass without a shuffle. Repeated rows are
    encoded each; lone surrogates can't occur in Spark strings.
    """
    prepare_llm(docs.sparkSession)
    columns = docs.columns if keep is None else keep
    long_one = F.coalesce(F.length(F.col("text").cast("string")), F.lit(0)) > chunk

    def work(batches):
        vocab = vocabulary(path)
        for texts in batches:
            made = [([], 0)] * len(texts)
            for block in text_blocks(texts):
                some = [i for i in block if texts[i]]
                for i, found in zip(some, vocab.encode_all([" " + texts[i] for i in some])):
                    made[i] = found
            yield {"ids": [m[0] for m in made], "score": [m[1] / SCALE for m in made]}

    short = beside(docs.where(~long_one), "text", "ids array<int>, score double", work, columns)
    giants = docs.where(long_one).select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col("text").cast("string").alias("text"))
    keyed = stored((giants.drop("text") if "text" in columns else giants).withColumn("key", F.monotonically_increasing_id()), "giants")
    whole = F.col("row.text").cast("string").alias("text") if "text" in columns else F.col("text")
    made = _giant(keyed.select("key", whole), path, max(chunk, 64))
    long_rows = keyed.select("key", "row").join(made, "key").select("row", F.struct("ids", (F.col("score") / F.lit(float(SCALE))).alias("score")).alias("made"))
    return short.select("row", "made").union(long_rows)


def decode(encoded: DataFrame, path: str, ids: str = "ids", into: str = "text") -> DataFrame:
    """The rows with the text of their ids in a new last column; null ids give the empty text."""
    columns = [c for c in encoded.columns if c != into]
    kept = encoded.select(*[F.col(f"`{c}`") for c in columns])
    place = columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            lists = batch.column(place)
            flat = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
            ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            texts = [vocab.decode(ids) for ids in np.split(flat, ends)[: len(lists)]]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*columns, into])

    from pyspark.sql.types import StringType, StructField, StructType

    return kept.mapInArrow(run, StructType([*kept.schema.fields, StructField(into, StringType())]))
