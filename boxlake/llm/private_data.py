"""Personal data in texts, plain or disguised, with its place in the source characters.

Plain identifiers are found by fixed patterns. Disguised ones are found in a normalised text: a cascade of
transducers maps look-alike characters, digits written as words and the words and signs that stand for "at" and "dot",
and carries the source span of every character it writes. What the same patterns find there is mapped back through
those spans, and is added unless a plain identifier of its kind holds all of it: a plain fragment stays beside the whole.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxlake.llm.common import ending, packed, rows_of

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# From the start of a run of digits only: where that fails, every later start in the run fails as well.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def emails(text: str) -> Iterator[Span]:
    """Each @ with the run of characters before it that no earlier address has taken, and a domain after it."""
    taken, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > taken and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            taken = found.end()
            yield "email", start, taken
        at = text.find("@", max(at + 1, taken))


def _is_ip(found: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in found.split("."))


def _is_card(found: str) -> bool:
    digits = _NOT_DIGIT.sub("", found)
    if not 12 <= len(digits) <= 19:
        return False
    doubled = [int(d) for d in digits[-2::-2]]
    return (sum(int(d) for d in digits[-1::-2]) + sum(2 * d - 9 * (d > 4) for d in doubled)) % 10 == 0


def _is_phone(found: str) -> bool:
    return 9 <= len(_NOT_DIGIT.sub("", found)) <= 15


_NUMERIC: tuple[tuple[str, re.Pattern, Callable[[str], bool]], ...] = (("ip", _IP, _is_ip), ("card", _CARD, _is_card), ("phone", _PHONE, _is_phone))


def ordered(spans) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def plain_spans(text: str) -> list[Span]:
    """All plain identifiers, by start and kind; leftmost and without overlap within a kind."""
    spans = list(emails(text))
    for kind, pattern, holds in _NUMERIC:
        if {"phone": "+", "ip": "."}.get(kind, "") not in text:
            continue
        spans += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if holds(m[0])]
    return ordered(spans)


def _forms() -> Iterator[tuple[str, str]]:
    """Decimal and other single digits of every script, and compatibility forms of printable ASCII characters; none lie higher."""
    for c in map(chr, range(0x80, 0x20000)):
        plain = str(unicodedata.digit(c)) if c.isdigit() else unicodedata.normalize("NFKC", c)
        if len(plain) == 1 and "!" <= plain <= "~":
            yield c, plain


# Characters that look like others, digits as words, and writings of "at" and "dot".
#: What other dots become first: a mark that tells them from plain dots.
DOT = "．"
LOOK_ALIKES = {
    **dict(_forms()), "‐": "-", "‑": "-", "–": "-", "ı": "i", "İ": "I",
    **dict(zip("авекмнорстухіјѕһԁԛԝӏ", "abekmhopctyxijshdqwl", strict=True)), **dict(zip("АВЕКМНОРСТУХІЈЅԚԜӀ", "ABEKMHOPCTYXIJSQWI", strict=True)),
    **dict(zip("αεικνορτυχ", "aeikvoptux", strict=True)), **dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "ABEZHIKMNOPTYX", strict=True)),
    "。": DOT, "․": DOT, "﹒": DOT, "｡": DOT,
}
del LOOK_ALIKES[DOT]
INVISIBLE = "​‌‍⁠﻿­"
DIGIT_WORDS = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9"}
_WORD_CLASS = "|".join(DIGIT_WORDS)
_SPELLED = re.compile(rf"(?i)\b(?=[zotfsen])(?:{_WORD_CLASS})(?:(?:[ -]|[ ]?,[ ]?)(?:dot(?:[ -]|[ ]?,[ ]?))?(?:{_WORD_CLASS}|[0-9])\b)+")
_AT_MARK = r"(?=[\[({<])(?:\[\s*at\s*\]|\(\s*at\s*\)|\{\s*at\s*\}|<\s*at\s*>|\(\s*@\s*\)|\[\s*@\s*\])"
_DOT_MARK = r"(?=[\[({<])(?:\[\s*dot\s*\]|\(\s*dot\s*\)|\{\s*dot\s*\}|<\s*dot\s*>|\[\s*[.．]\s*\]|\(\s*[.．]\s*\))"
# With the blanks around them; the search goes into a run of blanks from its start only.
_AT_SIGN = re.compile(rf"(?i)(?:(?<!\s)\s*)?{_AT_MARK}\s*")
_DOT_SIGN = re.compile(rf"(?i)(?:(?<!\s)\s*)?{_DOT_MARK}\s*|{DOT}")
# A plain dot alone does not make an address of "at": the first of the other writings of a dot decides.
_AT_WORD = re.compile(rf"(?i) at (?<=[a-z0-9] at )(?=[a-z0-9-]+(?:\.[a-z0-9-]+)*(?: dot |\s*{_DOT_MARK}\s*|{DOT})[a-z0-9])")
_DOT_WORD = re.compile(r"(?i)(?<=[a-z0-9]) dot (?=[a-z0-9])")
_PLUS_WORD = re.compile(r"(?i)\bplus[ ]?(?=[0-9])")
_CHANGED = frozenset(LOOK_ALIKES) | frozenset(INVISIBLE)


class Transduced:
    """A rewritten text in which every character knows the source span that it stands for."""

    def __init__(self, text: str):
        self.text, self.starts, self.ends = text, list(range(len(text))), list(range(1, len(text) + 1))

    def characters(self, mapping: dict[str, str], dropped: str) -> Transduced:
        kept = [i for i, c in enumerate(self.text) if c not in dropped]
        self.starts, self.ends = [self.starts[i] for i in kept], [self.ends[i] for i in kept]
        self.text = "".join([mapping.get(self.text[i], self.text[i]) for i in kept])
        return self

    def rewrite(self, pattern: re.Pattern, put: Callable[[re.Match], list[tuple[str, int, int]]]) -> Transduced:
        """Replace each match by (character, start, end) triples, places within the text at hand."""
        text, starts, ends, at = [], [], [], 0
        for m in pattern.finditer(self.text):
            text.append(self.text[at : m.start()])
            starts += self.starts[at : m.start()]
            ends += self.ends[at : m.start()]
            for character, a, b in put(m):
                text.append(character)
                starts.append(self.starts[a])
                ends.append(self.ends[b - 1])
            at = m.end()
        self.text, self.starts, self.ends = "".join(text) + self.text[at:], starts + self.starts[at:], ends + self.ends[at:]
        return self


def _one(character: str) -> Callable[[re.Match], list[tuple[str, int, int]]]:
    return lambda m: [(character, m.start(), m.end())]


def _digits(m: re.Match) -> list[tuple[str, int, int]]:
    """Digits for a run of words; what separates them goes, but for a dot."""
    out = []
    for word in re.finditer(r"(?i)[a-z]+|[0-9]", m[0]):
        value = word[0] if word[0].isdigit() else "." if word[0].lower() == "dot" else DIGIT_WORDS[word[0].lower()]
        out.append((value, m.start() + word.start(), m.start() + word.end()))
    return out


#: The steps of the cascade after the look-alikes; the word "at" comes first, as it is decided by dots not yet replaced.
_REWRITES = (
    (_AT_WORD, _one("@")), (_AT_SIGN, _one("@")), (_DOT_SIGN, _one(".")), (_SPELLED, _digits), (_DOT_WORD, _one(".")), (_PLUS_WORD, _one("+")),
)
#: One for each step, signs without their blanks: found just where the step finds something.
_GATES = (re.compile(f"(?i){_AT_MARK}|{_DOT_MARK}|{DOT}"), _AT_WORD, _SPELLED, _DOT_WORD, _PLUS_WORD)


def is_rewritten(text: str) -> bool:
    """Whether any transducer finds something in the text; the first one that changes a text finds it in the text as given."""
    return not (text.isascii() or _CHANGED.isdisjoint(text)) or any(gate.search(text) for gate in _GATES)


def normalised(text: str) -> Transduced:
    out = Transduced(text).characters(LOOK_ALIKES, INVISIBLE)
    for pattern, put in _REWRITES:
        out.rewrite(pattern, put)
    return out


def all_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Plain spans, and those with the disguised ones added."""
    plain = plain_spans(text)
    if not is_rewritten(text):
        return plain, plain
    rewritten = normalised(text)
    if rewritten.text == text:
        return plain, plain
    held = {kind: [(a, b) for k, a, b in plain if k == kind] for kind in KINDS}
    added = set()
    for kind, a, b in plain_spans(rewritten.text):
        start, end = rewritten.starts[a], rewritten.ends[b - 1]
        near = bisect_right(held[kind], (start, len(text)))  # plain spans of a kind do not overlap
        if not (near and end <= held[kind][near - 1][1]):
            added.add((kind, start, end))
    return plain, ordered([*plain, *added])


def masked(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans go together, under the first kind."""
    out, at = [], 0
    for kind, a, b in spans:
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
_FOUND = pa.schema([("doc_id", pa.int64()), ("plain", pa.list_(_SPAN)), ("spans", pa.list_(_SPAN))])
_SPANS = "array<struct<kind:string,start:int,end:int>>"


def find_private_data(docs: DataFrame) -> DataFrame:
    """doc_id, plain and all spans (kind, start, end in code points, end exclusive) of every row of ``docs``.

    A null text counts as empty and has none. Other columns are ignored. Repeated rows give repeated results, an empty
    table none.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for doc_id, text in rows_of(batches):
            plain, spans = all_spans(text or "")
            yield doc_id, *([dict(zip(("kind", "start", "end"), s, strict=True)) for s in found] for found in (plain, spans))

    given = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return given.mapInArrow(lambda b: packed(find(b), _FOUND), f"doc_id long, plain {_SPANS}, spans {_SPANS}")


def mask_private_data(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` with identifiers in ``text`` replaced by their kind; other columns as they are, n_chars (if any) counted anew.

    Null texts stay null; rows without identifiers are unchanged. A very long text takes time in proportion to its length.
    """

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, 512):
                batch = whole.slice(begin, 512)
                texts = [t and masked(t, all_spans(t)[1]) for t in batch["text"].to_pylist()]
                at = batch.schema.get_field_index("text")
                yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    out = docs.mapInArrow(lambda batches: ending(mask(batches)), docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
