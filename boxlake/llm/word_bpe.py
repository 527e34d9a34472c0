"""Splitting and encoding of one word at a time, as the tokenizers library does it for a whole text.

The tokenizer file is a BPE with word ends: white space only separates, and every pre-token is merged on
its own. A text's ids are therefore the ids of its words in order, whatever else the text holds.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from boxlake.llm.common import kept

FILE = "word_bpe_49k.json"
#: Below this code point characters are stable under NFC and stay there when lower-cased: plain patterns find the words.
PLAIN_END = 0x180
WHITE = "\\t\\n\\x0b\\x0c\\r \\x85\\xa0"


def _class(kind: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(PLAIN_END) if unicodedata.category(chr(c))[0] == kind)


_LETTERS, _NUMBERS = _class("L"), _class("N")
_WORDS = re.compile(rf"[{_LETTERS}]+|[{_NUMBERS}]|'(?:s|t|re|ve|m|ll|d)|[^{WHITE}{_LETTERS}{_NUMBERS}]+")
#: Bytes of UTF-8 that only occur in characters below PLAIN_END.
_PLAIN_BYTES = bytes(range(0x80)) + bytes(range(0x80, 0xC0)) + bytes(range(0xC2, 0xC6))


def spec(path: str | None = None) -> str:
    """The tokenizer file's content, to be sent along with a job: executors need no file."""
    with open(path or public_tokenizers.path(FILE), encoding="utf-8") as file:
        return file.read()


class WordTokenizer:
    """Words of a text, ids of a word, piece of an id."""

    def __init__(self, content: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        given = json.loads(content)
        self.special = {t["content"]: t["id"] for t in given["added_tokens"]}
        self.by_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        bare = {**given, "added_tokens": [], "truncation": None, "padding": None, "post_processor": None}
        steps = given["pre_tokenizer"]["pretokenizers"]
        self.splitting = Tokenizer.from_str(json.dumps({**bare, "pre_tokenizer": steps[0]}))
        self.merging = Tokenizer.from_str(json.dumps({**bare, "normalizer": None, "pre_tokenizer": steps[1]}))
        self.pieces: dict[int, str] = {i: p for p, i in given["model"]["vocab"].items()}
        self.pieces.update({i: p for p, i in self.special.items()})

    def words(self, text: str | None) -> list[str]:
        """Words in order; a special token's string is one word. Null is an empty text."""
        if not text:
            return []
        if self.by_special is None or "<|" not in text:
            return self._plain(text)
        out: list[str] = []
        for part in self.by_special.split(text):
            if part in self.special:
                out.append(part)
            elif part:
                out += self._plain(part)
        return out

    def _plain(self, text: str) -> list[str]:
        if text.isascii() or not text.encode("utf-8", "replace").translate(None, _PLAIN_BYTES):
            return _WORDS.findall(text.lower())
        splitting = self.splitting
        return [w for w, _ in splitting.pre_tokenizer.pre_tokenize_str(splitting.normalizer.normalize_str(text))]

    def ids(self, words: list[str]) -> list[list[int]]:
        special = self.special
        plain = [w for w in words if w not in special]
        found = iter(self.merging.encode_batch_fast(plain, add_special_tokens=False))
        return [[special[w]] if w in special else next(found).ids for w in words]


@kept
def tokenizer(content: str) -> WordTokenizer:
    return WordTokenizer(content)


class Codes(dict):
    """Numbers words in order of first sight."""

    def __missing__(self, word: str) -> int:
        self[word] = code = len(self)
        return code

    def array(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))


class Encoder:
    """Ids of texts, with a table of the words met so far that is emptied when it holds ``most_words``."""

    def __init__(self, content: str, most_words: int = 300_000):
        self.tokenizer, self.most = tokenizer(content), most_words
        self.clear()

    def clear(self) -> None:
        self.codes, self.known = Codes(), 0
        self.starts, self.flat = np.zeros(1, np.int64), np.zeros(0, np.int32)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """int32 ids of each text."""
        if self.known > self.most:
            self.clear()
        coded = [self.codes.array(self.tokenizer.words(t)) for t in texts]
        if len(self.codes) > self.known:
            new = self.tokenizer.ids(list(self.codes)[self.known :])
            ends = np.cumsum([len(i) for i in new]) + self.starts[-1]
            self.starts = np.concatenate([self.starts, ends])
            self.flat = np.concatenate([self.flat, np.array([i for ids in new for i in ids], np.int32)])
            self.known = len(self.codes)
        return [gather(self.starts, self.flat, c) for c in coded]


class Counter:
    """Numbers of ids of texts, with a table of the words met so far that is emptied when it holds ``most_words``."""

    def __init__(self, content: str, most_words: int = 300_000):
        self.tokenizer, self.most, self.known = tokenizer(content), most_words, {}

    def counts(self, texts: list[str | None]) -> list[int]:
        """Number of ids of each text."""
        if len(self.known) > self.most:
            self.known = {}
        known, split = self.known, [self.tokenizer.words(t) for t in texts]
        new = list(set().union(*split).difference(known))
        if new:
            known.update(zip(new, map(len, self.tokenizer.ids(new)), strict=True))
        return [sum(map(known.__getitem__, words)) for words in split]


@kept
def counter(content: str) -> Counter:
    """One table of words for each Python worker, kept from task to task."""
    return Counter(content)


@kept
def encoder(content: str) -> Encoder:
    """One table of words for each Python worker, kept from task to task."""
    return Encoder(content)


def gather(starts: np.ndarray, flat: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """flat[starts[c]:starts[c + 1]] of all codes in order, as one array."""
    begin = starts[codes]
    length = starts[codes + 1] - begin
    ends = np.cumsum(length)
    if not len(ends) or not ends[-1]:
        return flat[:0]
    return flat[np.arange(ends[-1]) - np.repeat(ends - length - begin, length)]
