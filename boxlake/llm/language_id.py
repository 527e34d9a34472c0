"""Language of every word by a linear-chain conditional random field, and of a text by its words.

A word's score for each language is a sum over hashed features: the word itself (lexicon), prefixes and suffixes
(affixes) and inner n-grams. A learned matrix scores the step from one word's language to the next. Training sees
bounded samples of labelled texts, cut and spliced so that languages change inside a sequence; forward-backward
then gives each word's probabilities. A whole batch of texts runs as one chain that is reset at each text's start,
scanned in blocks, so that long texts and short ones cost the same for each word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxlake.llm.common import ending, packed, rows_of

UNDETERMINED = "und"
BITS = 17
#: Bounds of the training sample: about so many texts of each language, and fewer each where all together would be more
#: than MOST_TEXTS; but one of every language.
TEXTS_EACH, MOST_TEXTS = 300, 19_200
SEQUENCES, STEPS, EPOCHS = 2500, 64, 3
#: With more languages, sequences grow in number, and blocks of words and texts shrink, in proportion.
WIDE = 64
#: A run of letters is cut into pieces of at most so many, each a word of its own in the chain.
LONGEST = 40
#: Superscripts, fractions, Roman numerals and the like: "word characters" to a pattern, but no letters. None lie higher.
_NUMBER_SIGNS = "".join(c for c in map(chr, range(0x80, 0x20000)) if c.isalnum() and not c.isalpha() and not c.isdecimal())
_WORD = re.compile(rf"[^\W\d_]{{1,{LONGEST}}}")
_LETTERS_ONLY = re.compile(rf"[^\W\d_{_NUMBER_SIGNS}]{{1,{LONGEST}}}")


def words_of(text: str) -> list[str]:
    """Runs of letters, lower-cased, in pieces of LONGEST at most."""
    words = _WORD.findall(text.lower())
    # the pattern without the signs takes many times as long, and few texts hold one
    return words if "".join(words).isalpha() else _LETTERS_ONLY.findall(text.lower())


_ODD = np.uint64(0x9E3779B97F4A7C15)


def _hashed(kind: int, columns: list[np.ndarray]) -> np.ndarray:
    """One hash for each row of code points; ``kind`` keeps equal letters in different roles apart."""
    h = np.full(len(columns[0]), kind + 1, np.uint64) * _ODD
    for column in columns:
        h = (h ^ column) * _ODD
        h ^= h >> np.uint64(29)
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed lexicon, affix and n-gram features of non-empty lower-case words, word after word, and each word's number of them.

    All words are hashed together, one kind of feature at a time.
    """
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    size = np.fromiter(map(len, words), np.int64, len(words))
    codes = np.frombuffer(("<" + "><".join(words) + ">").encode("utf-32-le", "replace"), "<u4").astype(np.uint64)
    ends = np.cumsum(size + 2)
    begins, every = ends - size - 2, np.arange(len(words))
    owner = np.repeat(every, size + 2)
    place = np.arange(len(codes)) - begins[owner]

    letters = _hashed(0, [codes, place.astype(np.uint64)]).astype(np.uint64) * _ODD
    owners, hashes = [every], [_hashed(1, [np.add.reduceat(letters, begins)])]
    for n in (1, 2, 3, 4):
        long = np.flatnonzero(size >= n)
        owners += [long, long]
        hashes.append(_hashed(10 + n, [codes[begins[long] + 1 + i] for i in range(n)]))
        hashes.append(_hashed(20 + n, [codes[ends[long] - 1 - n + i] for i in range(n)]))
    for n in (1, 2, 3):
        at = np.flatnonzero(place <= size[owner] + 2 - n)
        owners.append(owner[at])
        hashes.append(_hashed(30 + n, [codes[at + i] for i in range(n)]))
    owned = np.concatenate(owners)
    return np.concatenate(hashes)[np.argsort(owned, kind="stable")], np.bincount(owned, minlength=len(words))


@dataclass
class Field:
    """A trained model: weights by feature and language, start and step scores."""

    languages: list[str]
    weights: np.ndarray
    start: np.ndarray
    step: np.ndarray

    def emissions(self, words: list[str]) -> np.ndarray:
        """Scores (word, language) of non-empty lower-case words."""
        out = np.empty((len(words), len(self.languages)), np.float32)
        block = max(1, 4096 * WIDE // max(WIDE, len(self.languages)))
        for at in range(0, len(words), block):
            flat, counts = features(words[at : at + block])
            out[at : at + block] = np.add.reduceat(self.weights[flat], np.cumsum(counts) - counts)
        return out


def _soft(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def marginals(emissions: np.ndarray, first: np.ndarray, start: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Probabilities (word, language) by forward-backward over many chains laid end to end.

    ``first`` marks words that begin a chain; there the forward value forgets what came before. Blocks of equal length
    are scanned side by side: once for each block's transfer matrix, then from the values that enter each block. With
    many languages these matrices cost more than they save, and chains are scanned side by side instead.
    """
    n, k = emissions.shape
    if not n:
        return emissions.astype(np.float64)
    if k > WIDE:
        return _by_chains(emissions, first, start, step)
    width = max(1, int(np.sqrt(n)))
    blocks = -(-n // width)
    pad = blocks * width - n
    e = np.exp(np.clip(emissions - emissions.max(1, keepdims=True), -60, 0))
    e = np.concatenate([e, np.ones((pad, k))]).reshape(blocks, width, k)
    new = np.concatenate([first, np.ones(pad, bool)]).reshape(blocks, width)
    steps, starts = np.exp(step - step.max()), np.exp(start - start.max())

    moved = np.tile(np.eye(k), (blocks, 1, 1))
    for t in range(width):
        through = moved @ steps
        reset = new[:, t]
        if reset.any():
            through[reset] = moved[reset].sum(2, keepdims=True) * starts
        moved = through * e[:, t, None, :]
        moved /= moved.sum((1, 2), keepdims=True)

    entering, leaving = np.empty((blocks, k)), np.empty((blocks, k))
    value = np.ones(k)
    for b in range(blocks):
        entering[b] = value
        value = value @ moved[b]
        value = value / value.sum()
    value = np.ones(k)
    for b in range(blocks - 1, -1, -1):
        leaving[b] = value
        value = moved[b] @ value
        value = value / value.sum()

    forward = np.empty((blocks, width, k))
    value = entering
    for t in range(width):
        value = np.where(new[:, t, None], starts, value @ steps) * e[:, t]
        value = value / value.sum(1, keepdims=True)
        forward[:, t] = value
    value = leaving
    for t in range(width - 1, -1, -1):
        forward[:, t] *= value
        ahead = e[:, t] * value
        value = np.where(new[:, t, None], (ahead @ starts)[:, None], ahead @ steps.T)
        value = value / value.sum(1, keepdims=True)
    out = forward.reshape(-1, k)[:n]
    return out / out.sum(1, keepdims=True)


def _by_chains(emissions: np.ndarray, first: np.ndarray, start: np.ndarray, step: np.ndarray) -> np.ndarray:
    """The same probabilities, one step of all chains at a time."""
    e = np.exp(np.clip(emissions - emissions.max(1, keepdims=True), -60, 0))
    steps, starts = np.exp(step - step.max()), np.exp(start - start.max())
    begins = np.unique(np.append(np.flatnonzero(first), 0))
    lengths = np.diff(np.append(begins, len(e)))
    order = np.argsort(-lengths, kind="stable")
    begins, lengths = begins[order], lengths[order]
    going = np.searchsorted(-lengths, -np.arange(lengths[0]), "left")  # chains longer than t
    out, value = np.empty(e.shape), None
    for t, some in enumerate(going.tolist()):
        at = begins[:some] + t
        value = (starts if value is None else value[:some] @ steps) * e[at]
        value /= value.sum(1, keepdims=True)
        out[at] = value
    value = np.ones((len(begins), e.shape[1]))
    for t in range(len(going) - 1, -1, -1):
        at = begins[: going[t]] + t
        out[at] *= value[: going[t]]
        ahead = (e[at] * value[: going[t]]) @ steps.T
        value[: going[t]] = ahead / ahead.sum(1, keepdims=True)
    return out / out.sum(1, keepdims=True)


def _log_product(scores: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Logarithm of exp(scores) @ factors."""
    most = scores.max(-1, keepdims=True)
    return np.log(np.exp(scores - most) @ factors) + most


def train(rows: list[tuple[str, str]], seed: int = 7) -> Field:
    """A field fitted to (text, language) rows by AdaGrad on the conditional likelihood of spliced sequences."""
    languages = sorted({language for _, language in rows})
    words = [(words_of(text), languages.index(language)) for text, language in rows]
    words = [(w, y) for w, y in words if w]
    languages = languages or [UNDETERMINED]
    k, chance = len(languages), np.random.default_rng(seed)
    weights, start, step = np.zeros((1 << BITS, k)), np.zeros(k), np.zeros((k, k))
    if k == 1 or not words:
        return Field(languages, weights.astype(np.float32), start, step)
    by = [[w for w, y in words if y == l] for l in range(k)]
    present = [l for l in range(k) if by[l]]
    vocabulary: dict[str, int] = {}
    sequences = max(SEQUENCES, -(-SEQUENCES * k // WIDE))
    x, y = np.empty((sequences, STEPS), np.int64), np.empty((sequences, STEPS), np.int64)
    for i in range(sequences):
        filled = 0
        while filled < STEPS:
            label = present[chance.integers(len(present))]
            source = by[label][chance.integers(len(by[label]))]
            length = min(int(chance.geometric(1 / 20)), STEPS - filled, len(source))
            at = int(chance.integers(len(source) - length + 1))
            for w in source[at : at + length]:
                x[i, filled], y[i, filled] = vocabulary.setdefault(w, len(vocabulary)), label
                filled += 1
    flat, counts = features(list(vocabulary))
    ends = np.cumsum(counts)
    begins = ends - counts

    square = [np.full_like(p, 1e-6) for p in (weights, start, step)]
    first = np.zeros((1, STEPS), bool)
    first[0, 0] = True
    for _ in range(EPOCHS):
        order = chance.permutation(sequences)
        for some in np.array_split(order, max(1, sequences // 100)):
            xs, ys = x[some], y[some]
            used, inverse = np.unique(xs, return_inverse=True)
            inverse = inverse.reshape(-1)
            length = ends[used] - begins[used]
            inside = flat[np.arange(length.sum()) - np.repeat(np.cumsum(length) - length - begins[used], length)]
            owner = np.repeat(np.arange(len(used)), length)
            sums = [np.add.reduceat(weights[inside, l : l + WIDE], np.cumsum(length) - length) for l in range(0, k, WIDE)]
            scores = np.concatenate(sums, 1)
            e = scores[inverse].reshape(len(some), STEPS, k)
            alpha, beta, steps = np.empty_like(e), np.zeros_like(e), np.exp(step)
            alpha[:, 0] = start + e[:, 0]
            for t in range(1, STEPS):
                alpha[:, t] = e[:, t] + _log_product(alpha[:, t - 1], steps)
            for t in range(STEPS - 2, -1, -1):
                beta[:, t] = _log_product(e[:, t + 1] + beta[:, t + 1], steps.T)
            total = np.logaddexp.reduce(alpha[:, -1], 1)
            p = np.exp(alpha + beta - total[:, None, None])
            left, right = alpha[:, :-1].reshape(-1, k), (e[:, 1:] + beta[:, 1:]).reshape(-1, k)
            tops = left.max(1, keepdims=True), right.max(1, keepdims=True)
            scale = np.exp(tops[0] + tops[1] - np.repeat(total, STEPS - 1)[:, None])
            pairs = steps * ((np.exp(left - tops[0]) * scale).T @ np.exp(right - tops[1]))
            p.reshape(-1, k)[np.arange(p.size // k), ys.ravel()] -= 1
            at = np.add.reduceat(p.reshape(-1, k)[np.argsort(inverse, kind="stable")], np.searchsorted(np.sort(inverse), np.arange(len(used))))
            seen = np.unique(inside)
            spot = np.searchsorted(seen, inside)
            g = np.stack([np.bincount(spot, at[owner, l], len(seen)) for l in range(k)], 1) / len(some) + 1e-6 * weights[seen]
            square[0][seen] += g * g
            weights[seen] -= 0.15 * g / np.sqrt(square[0][seen])
            counts = np.zeros((k, k))
            np.add.at(counts, (ys[:, :-1].ravel(), ys[:, 1:].ravel()), 1)
            for i, (value, g) in enumerate(((start, p[:, 0].mean(0)), (step, (pairs - counts) / len(some) + 1e-3 * step)), 1):
                square[i] += g * g
                value -= 0.1 * g / np.sqrt(square[i])
    return Field(languages, weights.astype(np.float32), start, step)


def training_rows(labelled: DataFrame, texts_each: int = TEXTS_EACH, most_texts: int = MOST_TEXTS) -> list[tuple[str, str]]:
    """A bounded sample (text, lang) with every language that has a labelled row, by a hash of doc_id (of the text without one).

    About ``texts_each`` rows of each language, or ``most_texts`` shared out equally if that is less, but one at least.
    Counts are taken over all rows; the hash decides who is in the sample, never a row's place.
    """
    named = labelled.filter("lang is not null and text is not null")
    counts = {r["lang"]: r["count"] for r in named.groupBy("lang").count().collect()}
    if not counts:
        return []
    each = min(texts_each, max(1, most_texts // len(counts)))
    shares = labelled.sparkSession.createDataFrame([(lang, min(1.0, each / n)) for lang, n in counts.items()], "lang string, share double")
    key = F.when(F.col("doc_id").isNull(), F.xxhash64("text", F.lit("language"))).otherwise(F.xxhash64("doc_id", F.lit("language")))
    point = F.pmod(key, F.lit(1 << 40)) / float(1 << 40)
    chosen = named.select("doc_id", "text", "lang").join(F.broadcast(shares), "lang").filter(point < F.col("share"))
    rows = [(r["doc_id"], r["lang"], r["text"]) for r in chosen.limit(2 * each * len(counts)).collect()]
    lacking = sorted(counts.keys() - {lang for _, lang, _ in rows})
    for at in range(0, len(lacking), 1000):
        one = named.filter(F.col("lang").isin(lacking[at : at + 1000])).groupBy("lang").agg(F.min(F.struct("doc_id", "text")).alias("row"))
        rows += [(r["row"]["doc_id"], r["lang"], r["row"]["text"]) for r in one.collect()]
    return [(text, lang) for _, lang, text in sorted(rows, key=lambda r: (r[0] or 0, r[1], r[2]))]


class _Scorer:
    """Predictions for blocks of texts; the scores of words met before are kept, up to ``most_words`` of them."""

    def __init__(self, model: Field, most_words: int):
        self.model, self.most_words = model, most_words * WIDE // max(WIDE, len(model.languages))
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.emissions = np.empty((1024, len(self.model.languages)), np.float32)

    def learn(self, words: set[str]) -> None:
        at, new = len(self.known), list(words)
        while at + len(new) > len(self.emissions):
            self.emissions = np.concatenate([self.emissions, np.empty_like(self.emissions)])
        self.emissions[at : at + len(new)] = self.model.emissions(new)
        self.known.update(zip(new, range(at, at + len(new)), strict=True))

    def score(self, texts: list[str | None]) -> list[tuple]:
        """Language, its share, all shares and the mean of each word's largest probability, for every text."""
        if len(self.known) > self.most_words:
            self.forget()
        split = [words_of(text) if text else [] for text in texts]
        self.learn({w for words in split for w in words if w not in self.known})
        lengths = np.array([len(words) for words in split], np.int64)
        flat = np.fromiter((self.known[w] for words in split for w in words), np.int64, int(lengths.sum()))
        first = np.zeros(len(flat), bool)
        starts = np.cumsum(lengths) - lengths
        first[starts[lengths > 0]] = True
        k = len(self.model.languages)
        p = marginals(self.emissions[flat].astype(np.float64), first, self.model.start, self.model.step)
        sure = np.concatenate([np.zeros(1), np.cumsum(p.max(1))])
        p = np.concatenate([np.zeros((1, k)), np.cumsum(p, 0)])
        out = []
        for a, n in zip(starts.tolist(), lengths.tolist(), strict=True):
            if not n:
                out.append((UNDETERMINED, 0.0, [0.0] * k, 0.0))
                continue
            share = (p[a + n] - p[a]) / n
            best = int(share.argmax())
            out.append((self.model.languages[best], float(min(1.0, max(0.0, share[best]))), share.tolist(), float((sure[a + n] - sure[a]) / n)))
        return out


def _predictions(model: Field, most_words: int = 200_000) -> callable:
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[tuple]]]:
        scorer, most = _Scorer(model, most_words), 1_000_000 * WIDE // max(WIDE, len(model.languages))
        for whole in batches:
            for begin in range(0, whole.num_rows, 256):
                batch = whole.slice(begin, 256)
                texts, found, at = batch["text"].to_pylist(), [], 0
                while at < len(texts):  # about a million characters together, fewer with many languages
                    end, size = at, 0
                    while end < len(texts) and (end == at or size < most):
                        size += len(texts[end] or "")
                        end += 1
                    found += scorer.score(texts[at:end])
                    at = end
                yield batch, found

    return predict


def identify(docs: DataFrame, model: Field) -> DataFrame:
    """doc_id, lang_pred, score and shares (of each learned language) for every row of ``docs``; only the text is used.

    A text that is null or has no letter gets ``und`` with score 0. The score is the mean probability of the predicted
    language over the text's words; equal shares go to the first language by name. Repeated rows give repeated results,
    an empty table none.
    """
    predict = _predictions(model)
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("shares", pa.list_(pa.float64()))])

    def rows(batches):
        for batch, found in predict(batches):
            yield from ((doc_id, *f[:3]) for doc_id, f in zip(batch["doc_id"].to_pylist(), found, strict=True))

    given = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return given.mapInArrow(lambda b: packed(rows(b), schema), "doc_id long, lang_pred string, score double, shares array<double>")


def keep_identified(docs: DataFrame, model: Field, least_score: float = 0.35) -> DataFrame:
    """Rows of ``docs``, all columns as they are, whose words have languages: the mean of each word's largest probability
    is at least ``least_score``, and the largest share is not of ``und``.

    A text in several languages stays, however small the share of each. Null texts and texts without a letter are
    rejected. A model that has learned no language (no row was labelled) can judge no text: all with a letter stay. No
    other column decides, whatever its name.
    """
    predict, judges = _predictions(model), model.languages != [UNDETERMINED]

    def rows(batches):
        for batch, found in predict(batches):
            yield batch.filter(pa.array([sure >= least_score and (lang != UNDETERMINED or not judges) for lang, _, _, sure in found], pa.bool_()))

    return docs.mapInArrow(lambda b: ending(rows(b)), docs.schema)


def labelled_fold(docs: DataFrame) -> DataFrame:
    """Rows whose labels may be learned from: crc32 of doc_id as text, modulo 5, is not 0."""
    return docs.filter(~held_out())


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


