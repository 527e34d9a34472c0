"""Sets of word n-grams as sorted 64-bit hashes, many texts at a time."""

from __future__ import annotations

import numpy as np

from boxlake.llm.common import kept

#: Texts are hashed in pieces of about so many bytes.
PIECE = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: A-Z become a-z; the separators (space and \x09-\x0D) become spaces.
_FOLD = bytes(32 if c == 32 or 9 <= c <= 13 else c + 32 if 65 <= c <= 90 else c for c in range(256))


def mix(x: np.ndarray) -> np.ndarray:
    """Every bit of a uint64 depends on every bit of the input."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@kept
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for factor in (_BASE, _INVERSE):
        p = np.full(size + 1, factor, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


def _word_hashes(buffer: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word of a folded buffer."""
    a = np.frombuffer(buffer, np.uint8)
    inside = np.concatenate([[False], a != 32, [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    begin, end = edge[::2], edge[1::2]
    power, inverse = _powers(1 << max(20, int(len(a)).bit_length()))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((a.astype(np.uint64) + np.uint64(1)) * power[: len(a)], dtype=np.uint64)])
    sums = (total[end] - total[begin]) * inverse[begin]
    return mix(sums + (end - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), begin


def _pieces(text: bytes) -> list[bytes]:
    """A folded text cut at separators into pieces of PIECE bytes, or up to the next separator."""
    out, at = [], 0
    while len(text) - at > PIECE:
        cut = text.find(b" ", at + PIECE)
        if cut < 0:
            break
        out.append(text[at:cut])
        at = cut
    out.append(text[at:])
    return out


def folded_pieces(text: bytes) -> list[bytes]:
    """A text with A-Z lower-cased and separators as spaces, cut into pieces at spaces."""
    return _pieces(text.translate(_FOLD))


_SPLIT = bytes(32 if 9 <= c <= 13 else c for c in range(256))


def word_pieces(text: bytes) -> list[bytes]:
    """A text with separators as spaces, cut into pieces at spaces."""
    return _pieces(text.translate(_SPLIT))


def shingle_sets(texts: list[str | None], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all sets, each sorted and without repeats, and the sets' offsets.

    Words are runs of anything but space and \\x09-\\x0D, A-Z lower-cased. A text of fewer than ``n`` words is one
    shingle; one without words (or null) has none.
    """
    owners, parts = [], []
    for i, text in enumerate(texts):
        if text:
            for piece in _pieces(text.encode("utf-8", "replace").translate(_FOLD)):
                owners.append(i)
                parts.append(piece)
    hashes, docs, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    while at < len(parts):
        end, size = at, 0
        while end < len(parts) and (end == at or size + len(parts[end]) <= PIECE):
            size += len(parts[end]) + 1
            end += 1
        found, begin = _word_hashes(b" ".join(parts[at:end]))
        starts = np.cumsum([0] + [len(p) + 1 for p in parts[at : end - 1]])
        hashes.append(found)
        docs.append(np.array(owners[at:end])[np.searchsorted(starts, begin, "right") - 1])
        at = end
    word, doc = np.concatenate(hashes), np.concatenate(docs)
    count = np.bincount(doc, minlength=len(texts)) if len(doc) else np.zeros(len(texts), np.int64)
    first = np.concatenate([[0], np.cumsum(count)])

    factors = mix(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)
    grams = np.zeros(max(0, len(word) - n + 1), np.uint64)
    for j in range(n):
        grams += word[j : j + len(grams)] * factors[j]
    whole = doc[: len(grams)] == doc[n - 1 :] if len(grams) else np.zeros(0, bool)
    gram, owner = [mix(grams[whole])], [doc[: len(grams)][whole]]
    for i in np.flatnonzero((count > 0) & (count < n)):
        some = word[first[i] : first[i + 1]]
        gram.append(mix((some * factors[: len(some)]).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(some) * 0xA0761D6478BD642F % (1 << 64))))
        owner.append(np.array([i]))
    gram, owner = np.concatenate(gram).view(np.int64), np.concatenate(owner)
    order = np.lexsort((gram, owner))
    gram, owner = gram[order], owner[order]
    if len(gram):
        fresh = np.concatenate([[True], (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])])
        gram, owner = gram[fresh], owner[fresh]
    return gram, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(texts)))]).astype(np.int64)
