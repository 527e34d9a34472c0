"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer


def tokenizer() -> Tokenizer:
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    t.no_padding()
    t.no_truncation()
    return t


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def bpe_rows(docs):
    """(doc_id, n_tokens, ids_sha256, decoded_sha256)"""
    t = tokenizer()
    out = []
    for doc_id, text in docs:
        ids = t.encode(text or "", add_special_tokens=False).ids
        out.append((doc_id, len(ids), sha(" ".join(map(str, ids))), sha(t.decode(ids, skip_special_tokens=False))))
    return out


def token_file_rows(docs, end=1):
    """(doc_id, start, n_tokens, ids_crc32) of documents with distinct ids."""
    t, start, out = tokenizer(), 0, []
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, end], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def words_of(text: str | None) -> list[str]:
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", folded)


def shingles(text: str | None, n: int) -> frozenset:
    words = words_of(text)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) or frozenset([tuple(words)])


def jaccard_rows(docs, n=4, percent=85):
    """(doc_id, n_shingles, component_id); rows of one doc_id are one document, null doc_ids stand alone."""
    sets = [(d, shingles(t, n)) for d, t in docs]
    parent = {d: d for d, _ in sets if d is not None}

    def find(d):
        while parent[d] != d:
            d = parent[d]
        return d

    by = defaultdict(set)
    for i, (d, s) in enumerate(sets):
        if d is not None:
            for g in s:
                by[g].add(i)
    for i, (a, s) in enumerate(sets):
        if a is None:
            continue
        shared = defaultdict(int)
        for g in s:
            for j in by[g]:
                if j < i:
                    shared[j] += 1
        for j, k in shared.items():
            if 100 * k >= percent * (len(s) + len(sets[j][1]) - k):
                x, y = find(a), find(sets[j][0])
                parent[max(x, y)] = min(x, y)
    return [(d, len(s), None if d is None else find(d)) for d, s in sets]


_PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def private_spans(text: str | None) -> list[tuple[str, int, int]]:
    out = []
    for order, (kind, pattern) in enumerate(_PATTERNS):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub(r"[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                "card": 12 <= len(digits) <= 19 and _luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), order, kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(out)]


def inner_rows(vectors, k=20, every=20):
    """(query_id, rank, vec_id, score)"""
    whole = [(i, [int(np.floor(64 * float(x))) for x in v]) for i, v in vectors if v is not None and all(x is not None and np.isfinite(x) for x in v) and v]
    out = []
    for q, a in whole:
        if q % every == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in whole if i != q)
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scores[:k], 1)]
    return out


def nearest_rows(vectors, k=10, every=100):
    """{query_id: [(vec_id, distance)]}"""
    good = [(i, np.array(v, np.float64)) for i, v in vectors if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    ids, x = np.array([i for i, _ in good]), np.array([v for _, v in good])
    out = {}
    for i, v in good:
        if i % every == 0:
            d = np.sqrt(((x - v) ** 2).sum(1))
            order = [j for j in np.lexsort((ids, d)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(d[j])) for j in order]
    return out
