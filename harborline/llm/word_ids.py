"""Token ids of whole texts from a BPE with word ends, word by word.

Such a tokenizer drops white space and never merges across it, so a text's ids
are its words' ids, and a word is encoded once. A new word is cut into pieces
by the tokenizer's own pattern; new pieces are encoded many at once, as one
text, and cut apart again where a token carries the word end.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np

#: Words kept per process; beyond that the memory is cleared.
MEMO = 500_000
#: New pieces encoded as one text; longer words aren't kept.
TOGETHER, LONG = 500, 64

# The public tokenizer's pattern, and the same for words of ASCII and Latin-1 letters.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LETTERS = "a-zß-öø-ÿ"
_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\s{_LETTERS}0-9]+")
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
#: Characters that Python takes for white space and the tokenizer doesn't.
_ODD = re.compile("[\x1c-\x1f]")

_loaded: dict[str, WordIds] = {}


class WordIds:
    """Ids of whole texts as little-endian unsigned 32-bit integers, equal to the tokenizer's own."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        splits = [p for p in (made["pre_tokenizer"] or {}).get("pretokenizers", []) if p["type"] == "Split"]
        drops = len(splits) == 1 and splits[0]["behavior"] == "Removed" and splits[0]["invert"]
        self.by_word = bool(made["model"].get("end_of_word_suffix")) and drops and splits[0]["pattern"].get("Regex") == PATTERN
        names = [t["content"] for t in made["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, names))) if names else None
        self.mark = next((t for t in made["added_tokens"] if t["special"] and not t["normalized"]), None)
        # the same model behind a cut at spaces: for lower-case pieces
        self.pieces = Tokenizer.from_file(path)
        self.pieces.normalizer = normalizers.Sequence([])
        self.pieces.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.ends = np.zeros(1 + max(self.tokenizer.get_vocab().values()), bool)
        if self.by_word:
            suffix = made["model"]["end_of_word_suffix"]
            self.ends[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith(suffix)]] = True
        self.memo: dict[str, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> list[str]:
        """Ids of new words and their pieces into the memory; returns the long ones."""
        made: dict[str, bytes] = {}
        easy = [w for w in words if _PLAIN.fullmatch(w)]
        hard = [w for w in words if not _PLAIN.fullmatch(w)] if len(easy) < len(words) else []
        cut = [_PIECES.findall(w.lower()) for w in easy]
        memo, fresh = self.memo, list(set().union(*cut).difference(self.memo))
        for at in range(0, len(fresh), TOGETHER):
            part = fresh[at : at + TOGETHER]
            ids = np.array(self.pieces.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            stops = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
            if len(stops) != len(part):
                raise ValueError("the tokenizer cuts these words otherwise than its pattern says")
            raw = ids.tobytes()
            made.update((piece, raw[a:b]) for piece, a, b in zip(part, [0, *stops], stops))
        known = {p: memo[p] for p in set().union(*cut) if p not in made} | made
        made.update((word, known[pieces[0]] if len(pieces) == 1 else b"".join([known[p] for p in pieces])) for word, pieces in zip(easy, cut))
        if self.mark is None:
            made.update(zip(hard, self._whole(hard)))
            hard = []
        for at in range(0, len(hard), TOGETHER):  # a special token stands between the others
            part = hard[at : at + TOGETHER]
            ids = np.array(self.tokenizer.encode_batch_fast([self.mark["content"].join(part)], add_special_tokens=False)[0].ids, "<u4")
            marks = [*np.flatnonzero(ids == self.mark["id"]).tolist(), len(ids)]
            made.update((word, ids[a:b].tobytes()) for word, a, b in zip(part, [0, *(m + 1 for m in marks)], marks))
        memo.update(made)
        return [word for word in made if len(word) > LONG]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if not self.by_word:
            return self._whole([t or "" for t in texts])
        if len(self.memo) > MEMO:
            self.memo.clear()
        whole = {i: t for i, t in enumerate(texts) if t and (_ODD.search(t) or (self.special and self.special.search(t)))}
        words = [[] if not t or i in whole else t.split() for i, t in enumerate(texts)]
        long = self._learn(list(set().union(*words).difference(self.memo)))
        out = [b"".join(map(self.memo.__getitem__, some)) for some in words]
        for word in long:
            del self.memo[word]
        for (i, _), ids in zip(whole.items(), self._whole(list(whole.values()))):
            out[i] = ids
        return out


def word_ids(path: str) -> WordIds:
    """One for a process and a file."""
    if path not in _loaded:
        _loaded[path] = WordIds(path)
    return _loaded[path]
