"""Token ids in compressed blocks with a shared zstandard dictionary.

File format: a Parquet table in ascending doc_id order whose row is one block
of documents. A block has one zstandard frame for each document (its ids as
little-endian unsigned 32-bit integers), all frames one behind the other, the
offsets of the frames, the documents' ids and numbers of ids, the ids that its
partition holds before it, and the hash of the dictionary that the frames need.
The dictionary lies in a table of its own beside the blocks, found by its hash.
One document is read by its block's range of doc_ids, its offset and the
dictionary, nothing else.

The dictionary is trained on a bounded sample of short documents; frames of
short documents would otherwise spend most of their bytes on what all share.
"""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.llm.common import prepare_llm

END = 2
#: A block is closed at so many documents or bytes.
BLOCK_ROWS, BLOCK_BYTES = 1024, 4 << 20
#: Documents of at most SAMPLE_CHARS characters, SAMPLE_ROWS of them at most on average, train the dictionary.
SAMPLE_ROWS, SAMPLE_CHARS, DICTIONARY_BYTES, LEVEL = 1000, 4096, 32_768, 3
BLOCKS = "part int, first long, last long, ids_before long, dictionary string, doc_ids array<long>, counts array<long>, offsets array<long>, frames binary"

_loaded: dict[tuple[str, bool], Encoder] = {}
_UNIT = re.compile(r" ?\S+|\s+(?!\S)|\s+")
#: Characters that Python takes for white space and the tokenizer doesn't.
_ODD = re.compile("[\x1c-\x1f]")
# The tokenizer's own pattern for texts of ASCII and Latin-1 letters, marks and digits.
_LETTERS, _DIGITS = "a-zA-ZªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼½¾"
_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[{_DIGITS}]+| ?[^\s{_LETTERS}{_DIGITS}]+")
_PLAIN = re.compile(" ?[!-~¡-¬®-ÿ]+")
#: Texts of such characters are cut into pieces and white space at once.
_EASY = re.compile("[\t\n\r -~¡-¬®-ÿ]*")
_CUT = re.compile(rf"{_PIECES.pattern}|\s+(?!\S)|\s+")
#: Units kept per process; new pieces encoded as one text; longer units aren't kept.
MEMO, TOGETHER, LONG = 700_000, 500, 64
_BETWEEN = "\0"


class Encoder:
    """A byte-level BPE tokenizer whose results are remembered by unit: a word with the space before it, or white space.

    The tokenizer never merges across units. New units are cut into pieces by the tokenizer's own pattern,
    new pieces encoded many at once, and cut apart by the bytes that their ids stand for. In texts of ASCII
    and Latin-1 the units are the pieces themselves, so that a word is learned once, whatever mark follows it.
    """

    def __init__(self, path: str, special_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        names = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, names))) if names and not special_as_text else None
        # the same model behind a cut at a character that no piece holds
        self.pieces = Tokenizer.from_file(path)
        self.pieces.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(_BETWEEN, "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab()
        self.widths = np.zeros(1 + max(vocabulary.values()), np.int64)  # in this kind of vocabulary a character is a byte
        for token, number in vocabulary.items():
            self.widths[number] = len(token)
        self.memo: dict[str, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn_pieces(self, fresh: list[str]) -> None:
        """Ids of new pieces, none of white space, into the memory."""
        for at in range(0, len(fresh), TOGETHER):
            part = fresh[at : at + TOGETHER]
            ids = np.array(self.pieces.encode_batch_fast([_BETWEEN.join(part)], add_special_tokens=False)[0].ids, "<u4")
            bytes_to, ends = np.cumsum(self.widths[ids]), np.cumsum([len(p.encode()) for p in part])
            stops = np.searchsorted(bytes_to, ends) + 1
            if (bytes_to[stops - 1] != ends).any():
                raise ValueError("the tokenizer's ids don't cover these texts")
            raw, stops = ids.tobytes(), (4 * stops).tolist()
            self.memo.update((piece, raw[a:b]) for piece, a, b in zip(part, [0, *stops], stops))

    def _learn(self, units: list[str]) -> None:
        """Ids of new units and their pieces into the memory."""
        memo = self.memo
        easy = [u for u in units if _PLAIN.fullmatch(u)]
        hard = [u for u in units if not _PLAIN.fullmatch(u)] if len(easy) < len(units) else []
        # letters alone are one piece
        cut = [(u,) if u.isalpha() or u[0] == " " and u[1:].isalpha() else _PIECES.findall(u) for u in easy]
        self._learn_pieces(list(set().union(*cut).difference(memo)))
        memo.update((unit, b"".join([memo[p] for p in pieces])) for unit, pieces in zip(easy, cut) if len(pieces) > 1)
        memo.update(zip(hard, self._whole(hard)))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of whole texts as little-endian unsigned 32-bit integers."""
        if len(self.memo) > MEMO:
            self.memo.clear()
        whole = {i: t for i, t in enumerate(texts) if t and (_ODD.search(t) or (self.special and self.special.search(t)))}
        easy = [bool(t) and _EASY.fullmatch(t) is not None for t in texts]
        units = [[] if not t or i in whole else (_CUT if easy[i] else _UNIT).findall(t) for i, t in enumerate(texts)]
        pieces = set().union(*(u for u, e in zip(units, easy) if e)).difference(self.memo)
        blank = {p for p in pieces if p.isspace()}
        self._learn_pieces(list(pieces - blank))
        others = blank.union(*(u for u, e in zip(units, easy) if not e)).difference(self.memo)
        self._learn(list(others))
        out = [b"".join(map(self.memo.__getitem__, some)) for some in units]
        for (i, _), ids in zip(whole.items(), self._whole(list(whole.values()))):
            out[i] = ids
        for unit in pieces | others:
            if len(unit) > LONG:
                del self.memo[unit]
        return out


def encoder(path: str, special_as_text: bool = False) -> Encoder:
    if (path, special_as_text) not in _loaded:
        _loaded[path, special_as_text] = Encoder(path, special_as_text)
    return _loaded[path, special_as_text]


def train_dictionary(docs: DataFrame, tokenizer: str, special_as_text: bool = False) -> bytes:
    """A dictionary from the ids of short documents; empty if there are too few to train one."""
    import zstandard

    short = docs.select("doc_id", F.col("text").cast("string").alias("text")).where(F.length("text").between(1, SAMPLE_CHARS))
    total = docs.count()
    share = min(1.0, SAMPLE_ROWS / max(1, total))

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(encoder(tokenizer, special_as_text).encode(batch.column(1).to_pylist()), pa.binary())], names=["doc_id", "ids"])

    chosen = short.where(F.pmod(F.xxhash64(F.lit(9), "doc_id"), F.lit(1_000_003)) < share * 1_000_003)
    # a bounded sample; sorted here, as sorting there would encode it twice
    samples = chosen.mapInArrow(ids, "doc_id long, ids binary").toArrow().sort_by([("doc_id", "ascending"), ("ids", "ascending")]).column("ids").to_pylist()
    if sum(map(len, samples)) < 8 * DICTIONARY_BYTES or len(samples) < 50:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _frames(tokenizer: str, special_as_text: bool, dictionary: bytes, mark: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        held = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_content_size=True)
        encode, part = encoder(tokenizer, special_as_text), TaskContext.get().partitionId()
        keys, counts, frames, before = [], [], [], 0

        def block() -> pa.RecordBatch:
            offsets = np.cumsum([0] + [len(f) for f in frames]).tolist()
            values = [part, keys[0], keys[-1], before, mark, keys, counts, offsets, b"".join(frames)]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(), *[pa.list_(pa.int64())] * 3, pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=[c.split()[0] for c in BLOCKS.split(", ")])

        size = 0
        end = np.array([END], "<u4").tobytes()
        for batch in batches:
            for key, ids in zip(batch.column(0).to_pylist(), encode.encode(batch.column(1).to_pylist())):
                frame = press.compress(ids + end)
                keys.append(key)
                counts.append(len(ids) // 4 + 1)
                frames.append(frame)
                size += len(frame)
                if len(keys) >= BLOCK_ROWS or size >= BLOCK_BYTES:
                    yield block()
                    before += sum(counts)
                    keys, counts, frames, size = [], [], [], 0
        if keys:
            yield block()

    return run


def write(docs: DataFrame, path: str, tokenizer: str, special_as_text: bool = False) -> None:
    """Encode every row with a doc_id and write the blocks under `path`, in ascending doc_id order.

    Null text counts as empty; every document ends with id 2. Rows that repeat a doc_id are written
    each, ordered by text. Extra columns are left out. The strings of special tokens in a text become those
    tokens, as the library does it by default, or with special_as_text ordinary text.
    """
    spark = prepare_llm(docs.sparkSession)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null")
    dictionary = train_dictionary(source, tokenizer, special_as_text)
    mark = hashlib.sha256(dictionary).hexdigest()[:16]
    spark.createDataFrame([(mark, bytearray(dictionary))], "mark string, dictionary binary").coalesce(1).write.parquet(f"{path}/dictionary")
    ordered = source.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(_frames(tokenizer, special_as_text, dictionary, mark), BLOCKS).write.option("compression", "uncompressed").parquet(f"{path}/blocks")


def read(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and ids (little-endian bytes) of the files' documents.

    start: ids of all documents before it. With doc_ids only the blocks and frames of those documents are opened.
    """
    prepare_llm(spark)
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    sizes = blocks.groupBy("part").agg(F.max(F.expr("ids_before + aggregate(counts, 0L, (a, c) -> a + c)")).alias("n")).orderBy("part").collect()
    ahead, before = 0, []
    for row in sizes:
        before.append((row["part"], ahead))
        ahead += row["n"]
    dictionaries = {r["mark"]: bytes(r["dictionary"]) for r in spark.read.parquet(f"{path}/dictionary").collect()}
    shared = spark.sparkContext.broadcast((dict(before), dictionaries))
    wanted = None if doc_ids is None else set(doc_ids)
    if wanted is not None:
        hit = F.lit(False)
        for number in sorted(wanted):
            hit = hit | ((F.col("first") <= number) & (F.col("last") >= number))
        blocks = blocks.where(hit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        starts, known = shared.value
        unpack = {}
        for batch in batches:
            for row in batch.to_pylist():
                mark = row["dictionary"]
                if mark not in unpack:
                    raw = known[mark]
                    if hashlib.sha256(raw).hexdigest()[:16] != mark:
                        raise ValueError(f"dictionary {mark} isn't what the block was written with")
                    unpack[mark] = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw) if raw else None)
                start = starts[row["part"]] + row["ids_before"]
                out = ([], [], [], [], [])
                for i, (key, n) in enumerate(zip(row["doc_ids"], row["counts"])):
                    if wanted is None or key in wanted:
                        ids = unpack[mark].decompress(row["frames"][row["offsets"][i] : row["offsets"][i + 1]])
                        if len(ids) != 4 * n:
                            raise ValueError(f"document {key} has {len(ids) // 4} ids, not {n}")
                        for column, value in zip(out, (key, start, n, zlib.crc32(ids), ids)):
                            column.append(value)
                    start += n
                for at in range(0, len(out[0]), 256):
                    part = [c[at : at + 256] for c in out]
                    yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in part[:4]], pa.array(part[4], pa.binary())], names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"])

    return blocks.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")
