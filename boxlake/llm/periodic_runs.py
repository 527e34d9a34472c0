"""Maximal periodic runs in the words of a text, found through string synchronising sets.

A set for the length t holds the positions i at which the least hash among the t-word windows that start in i..i+t is that of
the window at i or at i+t. Membership depends on the 2t words from i alone, so a stretch that repeats repeats its positions;
and of any t consecutive positions one is in the set, unless all windows there have a period of t/4 at most.

* Periods below 8 are detected directly. Runs of periods up to t/4 are the highly periodic regions at length t: windows
  inside them are left out of the minima, and their runs are known already.
* At each length t = 8, 16, 32, ... positions of the set whose 2t words agree are paired with the next such position. A gap of
  t to 2t - 1 words proposes that period. A run of four periods holds such a pair in every t positions of its first three, and
  the next position with equal words is one smallest period on, so no run is missed and no multiple of a period is proposed.
* Proposals of one period whose words overlap are one stretch; it is compared word by word and extended as far as it goes.

Texts are searched many at a time, each closed by a mark that equals nothing else. Longest texts come first, so those too
short for a length are cut off at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxlake.llm.common import packed, rows_of
from boxlake.llm.shingles import mix, word_pieces

#: A run has this many words at least, and holds its period this many times.
LEAST_LENGTH, LEAST_TIMES = 6, 4
#: Shorter periods are detected directly; longer ones are proposed by the sets from this length on.
FIRST = 8
#: Bytes of texts that are searched together.
TOGETHER = 1 << 21
_NONE = np.uint64(2**64 - 1)


def _stretches(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each stretch of consecutive numbers in a sorted array."""
    cut = np.flatnonzero(np.diff(at) > 1)
    return at[np.concatenate([[0], cut + 1])] if len(at) else at, at[np.concatenate([cut, [len(at) - 1]])] if len(at) else at


def _short_runs(ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Starts and ends of runs, and their period, for every period below FIRST."""
    for period in range(1, FIRST):
        first, last = _stretches(np.flatnonzero(ids[:-period] == ids[period:]))
        keep = last - first + 1 + period >= max(LEAST_LENGTH, LEAST_TIMES * period)
        first, last = first[keep], last[keep]
        for divisor in (d for d in range(1, period) if period % d == 0):
            # A stretch that has a divisor as its period over one period and a bit has it throughout.
            whole = np.array([bool((ids[a : a + period] == ids[a + divisor : a + divisor + period]).all()) for a in first.tolist()], bool)
            first, last = first[~whole], last[~whole]
        yield first, last + 1 + period, period


def _window_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values, from running minima of blocks."""
    blocks = -(-len(values) // width)
    full = np.full(blocks * width, _NONE)
    full[: len(values)] = values
    full = full.reshape(blocks, width)
    ahead = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(full, axis=1).ravel()
    return np.minimum(ahead[: len(values) - width + 1], behind[width - 1 : len(values)])


def _extended(ids: np.ndarray, start: int, end: int, period: int) -> tuple[int, int]:
    """``start`` and ``end`` of the widest stretch around them in which every word equals that ``period`` words on."""
    while start:
        low = max(0, start - period)
        unlike = np.flatnonzero(ids[low:start] != ids[low + period : start + period])
        if len(unlike):
            start = low + int(unlike[-1]) + 1
            break
        start = low
    while end + period < len(ids):
        high = min(end + period, len(ids) - period)
        unlike = np.flatnonzero(ids[end:high] != ids[end + period : high + period])
        if len(unlike):
            return start, end + int(unlike[0])
        end = high
    return start, end


def _proposed_runs(ids: np.ndarray, window: np.ndarray, wider: np.ndarray, length: int, known: list[tuple]) -> list[tuple[int, int, int]]:
    """Runs (start, end, period) of periods from ``length`` to 2 * ``length`` - 1.

    ``window`` and ``wider`` are hashes of the ``length`` and 2 * ``length`` words from each position, ``known`` the runs of
    shorter periods.
    """
    values, periodic = window, np.zeros(len(window) + 1, np.int32)
    regions = [(a, b - length) for a, b, p in known if 4 * p <= length and b - a >= length and b <= len(ids)]
    if regions:
        first, last = np.array(regions).T
        np.add.at(periodic, first, 1)
        np.add.at(periodic, last + 1, -1)
        values = np.where(np.cumsum(periodic[:-1]) > 0, _NONE, window)
    least = _window_least(values, length + 1)
    count = len(least)
    at = np.flatnonzero(((least == values[:count]) | (least == values[length : length + count])) & (least != _NONE))
    context = wider[at]
    order = np.argsort(context, kind="stable")
    at, context = at[order], context[order]
    gap = at[1:] - at[:-1]
    pairs = np.flatnonzero((context[1:] == context[:-1]) & (gap >= length) & (gap < 2 * length))
    if not len(pairs):
        return []
    place, period = at[pairs], gap[pairs]
    order = np.lexsort((place, period))
    place, period = place[order], period[order]
    fresh = np.concatenate([[True], (period[1:] != period[:-1]) | (place[1:] > place[:-1] + 2 * length)])
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(place)) - 1
    runs = set()
    for a, b, p in zip(place[first].tolist(), (place[last] + 2 * length).tolist(), period[first].tolist(), strict=True):
        if np.array_equal(ids[a:b], ids[a + p : b + p]):  # else hashes collided
            start, end = _extended(ids, a, b, p)
            if end - start + p >= LEAST_TIMES * p:
                runs.add((start, end + p, p))
    return list(runs)


def runs_of(texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of every text, by start, then period. A text is an array of word numbers from 0."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    sizes = np.array([len(texts[i]) + 1 for i in order], np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    ids = np.empty(offsets[-1], np.int64)
    for place, i in enumerate(order):
        ids[offsets[place] : offsets[place + 1] - 1] = texts[i]
        ids[offsets[place + 1] - 1] = -1 - place
    found = [(a, b, period) for first, end, period in _short_runs(ids) for a, b in zip(first.tolist(), end.tolist(), strict=True)]
    length, window = 1, mix(ids.view(np.uint64) + np.uint64(1))
    while len(ids):
        if length >= FIRST:
            size = offsets[np.searchsorted(-sizes, -LEAST_TIMES * length, "left")]  # texts of that many words or more
            if not size:
                break
            ids, window = ids[:size], window[: size - length + 1]
        if 2 * length > len(ids):
            break
        wider = mix(window[:-length] * np.uint64(0x9E3779B97F4A7C15) ^ mix(window[length:] + np.uint64(length)))
        if length >= FIRST:
            found += _proposed_runs(ids, window, wider, length, found)
        length, window = 2 * length, wider
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, end, period in sorted(found, key=lambda r: (r[0], r[2])):
        place = int(np.searchsorted(offsets, start, "right")) - 1
        out[order[place]].append((start - int(offsets[place]), end - start, period))
    return out


def kept_words(size: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``size`` words stay if each run keeps its first period only."""
    change = np.zeros(size + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) == 0


_RUN = "struct<start:long,length:long,period:long>"
_ARROW = pa.schema([("doc_id", pa.int64()), ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))), ("collapsed", pa.binary())])


def _search(rows: Iterator[tuple]) -> Iterator[tuple]:
    held: list[tuple] = []
    numbers: dict[bytes, int] = {}
    size = 0

    def found() -> Iterator[tuple]:
        names = list(numbers)
        for (doc_id, words), runs in zip(held, runs_of([w for _, w in held]), strict=True):
            left = words[kept_words(len(words), runs)] if runs else words
            yield doc_id, runs, b" ".join(map(names.__getitem__, left.tolist()))

    for doc_id, text in rows:
        parts = [np.fromiter((numbers.setdefault(w, len(numbers)) for w in piece.split()), np.int64) for piece in word_pieces(text or b"")]
        held.append((doc_id, np.concatenate(parts)))
        size += len(text or b"")
        if size >= TOGETHER or len(held) >= 2000:
            yield from found()
            held, numbers, size = [], {}, 0
    if held:
        yield from found()


def find_runs(docs: DataFrame) -> DataFrame:
    """doc_id, runs (array of start, length, period, by start, then period) and collapsed of every row of ``docs``.

    Words are runs of anything but space and \\x09-\\x0D, numbered from 0. A run is a stretch with a smallest period that it
    holds four times at least, six words or more, and that cannot be extended by a neighbouring word. ``collapsed`` has the
    words that no run contains after its first period, joined by one space. A text without words, or null, has no runs and an
    empty ``collapsed``. Only doc_id and text are read; repeated rows and null doc_ids are rows like any other, and an empty
    table gives no rows. A very long text is split in pieces and searched whole.
    """
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    found = given.mapInArrow(lambda batches: packed(_search(rows_of(batches)), _ARROW), f"doc_id long, runs array<{_RUN}>, collapsed binary")
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def strongest(runs: Column) -> Column:
    """The run that holds its period most often, parts of it counted; the first of several. Null without runs."""
    more = lambda best, r: r["length"] * best["period"] > best["length"] * r["period"]
    return F.aggregate(runs, F.get(runs, F.lit(0)), lambda best, r: F.when(more(best, r), r).otherwise(best))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text, in which the words of every tenth document repeat from some word on, as doc_id decides.

    With h the CRC-32 of the decimal doc_id, g = h div 10 and n words: where h is divisible by 10, word a + i becomes word
    a + i mod p, for a = g mod n and p = 1 + (n - a) div (3 + g mod 8). Other texts stay, those without doc_id among them.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")).alias("words"))
    placed = chosen.withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, F.expr("cast(h div 10 % n as int)"))).withColumn("p", F.expr("cast(1 + (n - a) div (3 + h div 10 % 8) as int)"))
    repeated = F.flatten(F.array_repeat(F.expr("slice(words, a + 1, p)"), F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")))
    text = F.array_join(F.concat(F.expr("slice(words, 1, a)"), F.slice(repeated, F.lit(1), F.col("n") - F.col("a"))), " ")
    return placed.select("doc_id", F.when(F.col("n") > 0, text).otherwise(F.col("text")).alias("text"))
