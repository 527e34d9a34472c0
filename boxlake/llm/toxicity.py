"""Toxicity of texts by a weighted finite-state grammar over clauses.

Words become symbols: insult, threat, target, negation, report, quotation mark, or none. Insults are a short list and
the words and word stems that labelled texts show to be toxic. Small transducers read a clause one after another, each
marking what the next one reads: negation turns an insult or threat into a denied one, reported speech into a reported
one, and a target nearby (read in both directions) into a directed one. A text's score is a logistic sum over the
marks of its matched clauses; their weights are fitted to labelled texts and pulled towards set values, which hold for
marks that the labels do not show.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxlake.llm.common import packed, rows_of, stored

THRESHOLD = 0.3
#: Bounds of the training sample, in texts of each label, and of the learned lexicon.
TOXIC_TEXTS, CLEAN_TEXTS, MOST_ENTRIES = 1500, 3500, 2000
#: A learned entry explains so many toxic texts (and this part of them) that no better entry does, at least, and its share
#: of toxic texts is so many times its share of clean ones.
LEAST_TEXTS, LEAST_PART, LEAST_RATIO = 4, 0.004, 40.0
#: In the second round an entry explains this part of toxic texts.
SECOND_PART, CLEAN_COST = 0.02, 10.0
STEMS = range(4, 9)

# Word lists of the grammar.
INSULTS = "idiot moron stupid scum trash loser worthless pathetic disgusting clown imbecile vermin filth coward".split()
THREATS = "kill hurt destroy murder beat stab shoot burn strangle crush".split()
TARGETS = "you your yours yourself u he she they them him her his their du dich ihr euch vous toi tú usted ustedes".split()
NEGATIONS = "not no never isn aren wasn don neither nor nicht kein keine nie pas jamais ne nunca".split()
REPORTS = "said says say saying called calls wrote writes claimed quoted reported told sagte sagt nannte dit disait dijo dice".split()

NONE, INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE, END = "oITYNRQ."
_TOKEN = re.compile(r"[^\W\d_]+|[.!?;\n]|[\"“”„«»]")
_WORD = re.compile(r"[^\W\d_]+")
_END_MARKS, _QUOTE_MARKS = frozenset(".!?;\n"), frozenset("\"“”„«»")


@dataclass(frozen=True)
class Transducer:
    """arcs: (state, symbol) to (next state, written symbol); a missing symbol is copied by the state's default arc."""

    arcs: dict[tuple[int, str], tuple[int, str]]
    default: dict[int, int]
    backward: bool = False

    def read(self, clause: str) -> str:
        state, out = 0, []
        for symbol in reversed(clause) if self.backward else clause:
            state, written = self.arcs.get((state, symbol)) or (self.default[state], symbol)
            out.append(written)
        return "".join(reversed(out) if self.backward else out)


def _near(trigger: str, reach: int, marks: dict[str, str], backward: bool = False) -> Transducer:
    """Writes ``marks`` for symbols at most ``reach`` places after ``trigger``; states count what is left of the reach."""
    arcs = {(s, trigger): (reach, trigger) for s in range(reach + 1)}
    arcs |= {(s, symbol): (s - 1, mark) for s in range(1, reach + 1) for symbol, mark in marks.items()}
    return Transducer(arcs, {s: max(0, s - 1) for s in range(reach + 1)}, backward)


def _after(triggers: str, marks: dict[str, str]) -> Transducer:
    """Writes ``marks`` for symbols anywhere after one of ``triggers``."""
    arcs = {(s, t): (1, t) for s in (0, 1) for t in triggers} | {(1, symbol): (1, mark) for symbol, mark in marks.items()}
    return Transducer(arcs, {0: 0, 1: 1})


#: Insult I: denied i, reported r, directed D. Threat T: denied t, reported s, directed K.
GRAMMAR = (
    _near(NEGATION, 3, {INSULT: "i", THREAT: "t"}),
    _after(REPORT + QUOTE, {INSULT: "r", THREAT: "s"}),
    _near(TARGET, 4, {INSULT: "D"}),
    _near(TARGET, 4, {INSULT: "D", THREAT: "K"}, backward=True),
)
MARKS = "IDirTKts"
#: Set values: base, then weight of one more clause with each mark.
BASE, WEIGHTS = -3.0, np.array([3.5, 4.5, -0.5, 0.5, 0.5, 4.0, -0.5, 0.2])
MOST_CLAUSES = 3


def marks(symbols: str) -> list[int]:
    """Number of clauses with each mark; clauses without an insult or threat are not read."""
    counts = Counter()
    for clause in symbols.split(END):
        if INSULT in clause or THREAT in clause:
            for transducer in GRAMMAR:
                clause = transducer.read(clause)
            counts.update(set(clause))
    return [counts[m] for m in MARKS]


class Symbols(dict):
    """Symbol of each token met so far."""

    def __init__(self, words: frozenset[str], stems: frozenset[str], most: int = 200_000):
        super().__init__()
        self.stems, self.lengths, self.most = stems, sorted({len(s) for s in stems}), most
        self.fixed = dict.fromkeys(THREATS, THREAT) | dict.fromkeys(TARGETS, TARGET) | dict.fromkeys(NEGATIONS, NEGATION) | dict.fromkeys(REPORTS, REPORT)
        self.fixed |= dict.fromkeys([*INSULTS, *words], INSULT) | dict.fromkeys(_END_MARKS, END) | dict.fromkeys(_QUOTE_MARKS, QUOTE)

    def __missing__(self, token: str) -> str:
        found = self.fixed.get(token) or (INSULT if any(token[:n] in self.stems for n in self.lengths) else NONE)
        if len(self) >= self.most:
            self.clear()
        self[token] = found
        return found

    def of(self, text: str | None) -> str:
        return "".join(map(self.__getitem__, _TOKEN.findall(text.lower()))) if text else ""


@dataclass(frozen=True)
class Model:
    words: frozenset[str]
    stems: frozenset[str]
    base: float
    weights: np.ndarray

    def score(self, counts) -> np.ndarray:
        z = self.base + np.minimum(counts, MOST_CLAUSES) @ self.weights
        return 1 / (1 + np.exp(-z))


def sample(docs: DataFrame, labels: DataFrame, toxic_texts: int = TOXIC_TEXTS, clean_texts: int = CLEAN_TEXTS) -> DataFrame:
    """toxic and text of a bounded sample of labelled rows, chosen by a hash of doc_id within each label; each text once."""
    known = labels.filter("doc_id is not null and toxic in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    chosen = [
        known.filter(F.col("toxic") == label).orderBy(F.xxhash64("doc_id", F.lit("toxic")), "doc_id").limit(most)
        for label, most in ((1, toxic_texts), (0, clean_texts))
    ]
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("text is not null")
    # At most toxic_texts + clean_texts rows are broadcast.
    return texts.join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id").groupBy("text").agg(F.max("toxic").alias("toxic"))


def _keys(text: str) -> set[str]:
    """Words ("=word") and stems of a text."""
    words = set(_WORD.findall(text.lower()))
    return {f"={w}" for w in words} | {w[:n] for w in words for n in STEMS if len(w) >= n}


def _cover(lists: list[list[str]], cost: dict[str, float], least: int, without: set[str]) -> set[str]:
    """Entries by how many lists they explain beyond those taken before them, less their cost; ``least`` at least.

    Entries that begin those in ``without``, or begin with them, are left out.
    """
    bare = tuple({t.removeprefix("=") for t in without})
    akin = {k: k.removeprefix("=").startswith(bare) or any(b.startswith(k.removeprefix("=")) for b in bare) for k in cost}
    texts = {i: {k for k in keys if not akin[k]} for i, keys in enumerate(lists)}
    holders: dict[str, set[int]] = {}
    for i, keys in texts.items():
        for key in keys:
            holders.setdefault(key, set()).add(i)
    taken: set[str] = set()
    while holders and len(taken) < MOST_ENTRIES:
        best = max(holders, key=lambda k: (len(holders[k]) - cost[k], k[0] == "=", len(k), k))
        if len(holders[best]) < least:
            break
        taken.add(best)
        for i in holders.pop(best).copy():
            for key in texts.pop(i):
                holders.get(key, set()).discard(i)
    return taken


def lexicon(rows: DataFrame) -> tuple[frozenset[str], frozenset[str]]:
    """Words and stems that mark toxic texts in ``rows`` (toxic, text), a bounded sample.

    Of all entries over the ratio, the one that explains most texts is taken first (of equals, a word before a stem, and a
    longer one), then the one that explains most of the rest; a clean text counts against an entry as CLEAN_COST toxic ones
    of a balanced sample. Words that only come along in copies of a toxic text explain little more and stay out. A second
    round without the entries taken finds those that mostly occur beside them.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        toxic, clean = Counter(), Counter()
        for label, text in rows_of(batches):
            (toxic if label else clean).update(_keys(text))
            (toxic if label else clean)[""] += 1
        for key in toxic.keys() | clean.keys():
            yield key, toxic[key], clean[key]

    schema = pa.schema([("key", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])
    counted = rows.select("toxic", "text").mapInArrow(lambda b: packed(count(b), schema), "key string, toxic long, clean long")
    sums = counted.groupBy("key").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    total = sums.filter("key = ''").first()
    if total is None or not total["toxic"] or not total["clean"]:
        return frozenset(), frozenset()
    ratio = (F.col("toxic") / total["toxic"]) / ((F.col("clean") + 0.5) / total["clean"])
    least = max(LEAST_TEXTS, int(LEAST_PART * total["toxic"]))
    good = sums.filter((F.col("key") != "") & (F.col("toxic") >= least) & (ratio >= LEAST_RATIO))
    ordered = good.orderBy(F.desc("toxic"), F.desc(F.length("key")), "key").limit(20 * MOST_ENTRIES)
    cost = {r["key"]: CLEAN_COST * r["clean"] * total["toxic"] / total["clean"] for r in ordered.collect()}
    entries = frozenset(cost)

    def explain(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for label, text in rows_of(batches):
            if label:
                yield (sorted(_keys(text) & entries),)

    lists = rows.select("toxic", "text").mapInArrow(lambda b: packed(explain(b), pa.schema([("keys", pa.list_(pa.string()))])), "keys array<string>")
    lists = sorted(r["keys"] for r in lists.collect())
    taken = _cover(lists, cost, least, set())
    taken |= _cover(lists, cost, max(least, int(SECOND_PART * total["toxic"])), taken)
    return frozenset(k[1:] for k in taken if k[0] == "="), frozenset(k for k in taken if k[0] != "=")


def fit(counts: np.ndarray, toxic: np.ndarray, pull: float = 1.0, steps: int = 300) -> tuple[float, np.ndarray]:
    """Base and weights by gradient steps on the logistic loss, pulled towards the set values."""
    x = np.concatenate([np.ones((len(counts), 1)), np.minimum(counts, MOST_CLAUSES)], 1)
    start = np.concatenate([[BASE], WEIGHTS])
    w = start.copy()
    rate = 4.0 / (np.linalg.norm(x, 2) ** 2 + 4 * pull)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ w))
        w -= rate * (x.T @ (p - toxic) + pull * (w - start))
    return float(w[0]), w[1:]


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from ``labels`` (doc_id, toxic 0 or 1; others are ignored) and their texts in ``docs``.

    Without labels of both kinds the fixed lists and set weights stand alone.
    """
    rows = stored(sample(docs, labels), "toxic-sample")
    words, stems = lexicon(rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        symbols = Symbols(words, stems)
        for label, text in rows_of(batches):
            yield label, marks(symbols.of(text))

    schema = pa.schema([("toxic", pa.int32()), ("marks", pa.list_(pa.int32()))])
    found = rows.select(F.col("toxic").cast("int"), "text").mapInArrow(lambda b: packed(count(b), schema), "toxic int, marks array<int>").collect()
    found.sort(key=lambda r: (r["toxic"], r["marks"]))
    if len({r["toxic"] for r in found}) < 2:
        return Model(words, stems, BASE, WEIGHTS)
    base, weights = fit(np.array([r["marks"] for r in found], float), np.array([r["toxic"] for r in found], float))
    return Model(words, stems, base, weights)


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1) and marks (clauses with each of MARKS) of every row of ``docs``; only the text is used.

    A null or empty text has no clause and gets the base score. Repeated rows give repeated results, an empty table none.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("marks", pa.list_(pa.int32()))])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        symbols = Symbols(model.words, model.stems)
        for doc_id, text in rows_of(batches):
            counts = marks(symbols.of(text))
            yield doc_id, float(model.score(np.array(counts, float))), counts

    given = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return given.mapInArrow(lambda b: packed(score(b), schema), "doc_id long, score double, marks array<int>")
