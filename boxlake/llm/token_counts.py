"""Token counts that follow edits without a second encoding of the whole text.

A document's text is cut after white space into segments of about ``SEGMENT`` characters. No pre-token spans white
space, so a segment's count depends on its own characters only. The tree over the segments keeps characters and
tokens of every node, level by level, leaves first. An edit descends by characters to the segments it touches; these
alone are encoded again, joined with the next one where the edit leaves no white space at their end (the boundary
context), and only sums above changed leaves are formed anew.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxlake.llm import word_bpe
from boxlake.llm.common import packed, rows_of

SEGMENT = 200
FANOUT = 8
_WHITE = re.compile(f"[{word_bpe.WHITE}]")

TREE = "chars array<array<int>>, tokens array<array<int>>"
_LEVELS = pa.list_(pa.list_(pa.int32()))
_TREES = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("chars", _LEVELS), ("tokens", _LEVELS)])
_EDITED = pa.schema([*_TREES, ("n_edits", pa.int32()), ("n_refused", pa.int32()), ("encoded_chars", pa.int64())])


def segments(text: str) -> list[str]:
    """Pieces of the text, each but the last ending in white space, of SEGMENT characters or up to the next white space."""
    out, at = [], 0
    while at < len(text):
        cut = _WHITE.search(text, at + SEGMENT - 1)
        end = cut.end() if cut else len(text)
        out.append(text[at:end])
        at = end
    return out


def levels(leaves: list[int]) -> list[list[int]]:
    """Sums of FANOUT nodes each, level by level up to the root. No leaves: a root of 0."""
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([sum(out[-1][i : i + FANOUT]) for i in range(0, len(out[-1]), FANOUT)])
    return out if leaves else [[], [0]]


def leaf_at(chars: list[list[int]], position: int) -> tuple[int, int]:
    """Leaf that holds a character position, and where that leaf begins; the last leaf for the text's end."""
    node, begin = 0, 0
    for level in range(len(chars) - 2, -1, -1):
        node *= FANOUT
        last = min(node + FANOUT, len(chars[level])) - 1
        while node < last and begin + chars[level][node] <= position:
            begin += chars[level][node]
            node += 1
    return node, begin


@dataclass
class Document:
    text: str
    chars: list[list[int]]
    tokens: list[list[int]]
    encoded: int = 0
    refused: int = 0
    done: int = 0

    def splice(self, first: int, last: int, lengths: list[int], counts: list[int]) -> None:
        """Replace leaves first..last; only sums above them change, unless the number of leaves does."""
        for tree, new in ((self.chars, lengths), (self.tokens, counts)):
            if len(new) != last - first + 1:
                tree[:] = levels(tree[0][:first] + new + tree[0][last + 1 :])
                continue
            tree[0][first : last + 1] = new
            low, high = first, last
            for below, above in zip(tree, tree[1:], strict=False):
                low, high = low // FANOUT, high // FANOUT
                above[low : high + 1] = [sum(below[i * FANOUT : (i + 1) * FANOUT]) for i in range(low, high + 1)]

    def edit(self, start: int, end: int, put: str, counts_of) -> None:
        if not self.chars[0]:
            new = segments(put)
            self.text, lengths = put, [len(s) for s in new]
            self.chars, self.tokens = levels(lengths), levels(counts_of(new))
            self.encoded += len(put)
            return
        first, begin = leaf_at(self.chars, start)
        last, last_begin = leaf_at(self.chars, max(start, end - 1))
        stop = last_begin + self.chars[0][last]
        # Boundary context: the leaf before still ends in white space; the next one joins if the region no longer does.
        region = self.text[begin:start] + put + self.text[end:stop]
        while last + 1 < len(self.chars[0]) and not (region and _WHITE.match(region[-1])):
            last += 1
            region += self.text[stop : stop + self.chars[0][last]]
            stop += self.chars[0][last]
        new = segments(region)
        self.splice(first, last, [len(s) for s in new], counts_of(new))
        self.text = self.text[:begin] + region + self.text[stop:]
        self.encoded += len(region)


def token_trees(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """doc_id, text, chars and tokens (tree levels, leaves first, root last) of every row of ``docs``.

    Other columns are ignored. A null text stays null and has an empty tree, whose root is 0. Repeated rows
    stay repeated; an empty table gives no rows.
    """
    content = word_bpe.spec(tokenizer_path)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        counts_of = word_bpe.counter(content).counts
        for doc_id, text in rows_of(batches):
            leaves = segments(text or "")
            yield doc_id, text, levels([len(s) for s in leaves]), levels(counts_of(leaves))

    given = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return given.mapInArrow(lambda batches: packed(build(batches), _TREES), f"doc_id long, text string, {TREE}")


def n_tokens(tokens="tokens"):
    """The root of a tree: its last level's only node."""
    return F.element_at(F.element_at(tokens, -1), 1).cast("long")


def apply_edits(trees: DataFrame, edits: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """Trees after ``edits`` (doc_id, start, end, put), with n_edits, n_refused and encoded_chars for each row.

    Offsets are code points of the text before any edit, end exclusive. Edits of one document are applied from its end
    to its start, which leaves earlier offsets as they are; equal edits count once. An edit that is null in a field, lies
    outside the text or overlaps one already applied is refused and counted. Documents without edits pass unchanged;
    edits for unknown or null doc_ids have no effect. Every row of a repeated doc_id gets the edits. A document's edits
    travel as one list: what is applied of it cannot exceed the document's own length.
    """
    content = word_bpe.spec(tokenizer_path)
    listed = (
        edits.select(F.col("doc_id").cast("long"), F.col("start").cast("int"), F.col("end").cast("int"), F.col("put").cast("string"))
        .filter("doc_id is not null").distinct()
        .groupBy("doc_id").agg(F.collect_list(F.struct("start", "end", "put")).alias("edits"))
    )

    def update(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        counts_of = word_bpe.counter(content).counts
        for doc_id, text, chars, tokens, wanted in rows_of(batches):
            if not wanted:
                yield doc_id, text, chars, tokens, 0, 0, 0
                continue
            document, reach = Document(text or "", chars, tokens), len(text or "")
            for e in sorted(wanted, key=lambda e: (-(e["end"] or 0), -(e["start"] or 0), e["put"] or "")):
                if None in e.values() or not 0 <= e["start"] <= e["end"] <= reach:
                    document.refused += 1
                    continue
                document.edit(e["start"], e["end"], e["put"], counts_of)
                document.done, reach = document.done + 1, e["start"]
            after = document.text if text is not None or document.done else None
            yield doc_id, after, document.chars, document.tokens, document.done, document.refused, document.encoded

    schema = f"doc_id long, text string, {TREE}, n_edits int, n_refused int, encoded_chars long"
    joined = trees.select("doc_id", "text", "chars", "tokens").join(listed, "doc_id", "left")
    return joined.mapInArrow(lambda batches: packed(update(batches), _EDITED), schema)
