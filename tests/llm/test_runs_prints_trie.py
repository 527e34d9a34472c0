"""Periodic runs, SimHash links and the prefix trie against plain versions."""

import hashlib
import os
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from boxlake.llm import periodic_runs, prefix_trie, simhash
from boxlake.llm.queries import QUERIES
from tests.llm.test_text_operators import ODD, SCHEMA

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Periodic runs


def plain_runs(w):
    """Every period of every stretch, by comparison of words q apart."""
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            stretch, size = w[i : j + q], j - i + q
            if j > i and size >= max(6, 4 * q) and all(any(stretch[x] != stretch[x + d] for x in range(size - d)) for d in range(1, q)):
                out.append((i, size, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def sequences(chance):
    a, n = chance.choice([1, 2, 3, 50]), chance.randrange(300)
    base = [chance.randrange(a) for _ in range(chance.randrange(1, 60))]
    yield [chance.randrange(a) for _ in range(n)]
    noisy = (base * (n // len(base) + 1))[:n]
    for _ in range(chance.randrange(3) if noisy else 0):
        noisy[chance.randrange(n)] = chance.randrange(a + 1)
    yield noisy
    yield [bin(i).count("1") % 2 for i in range(n)]  # no word three times in a row
    x, y = [0], [0, 1]
    while len(y) < n:
        x, y = y, y + x
    yield y[:n] * chance.choice([1, 2])
    yield ([*[0] * chance.randrange(1, 9), 1] * chance.randrange(1, 9) + [2]) * chance.randrange(1, 6)


def test_runs_agree_with_a_comparison_of_all_periods():
    chance, seen = random.Random(3), 0
    for _ in range(40):
        texts = list(sequences(chance))
        chance.shuffle(texts)
        want = [plain_runs(w) for w in texts]
        seen += sum(r[2] >= periodic_runs.FIRST for runs in want for r in runs)
        assert periodic_runs.runs_of([np.array(w, np.int64) for w in texts]) == want
    assert seen > 30 and periodic_runs.runs_of([]) == []


def test_a_long_text_with_long_periods():
    chance = random.Random(4)
    base = [chance.randrange(1000) for _ in range(3001)]
    w = [*range(2000, 2050), *base * 5, *base[:700], -5, *[7] * 9000]
    assert periodic_runs.runs_of([np.array(w, np.int64)]) == [[(50, 5 * 3001 + 700, 3001), (50 + 5 * 3001 + 701, 9000, 1)]]


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def run_row(doc_id, text):
    words = planted(doc_id, [w.decode() for w in WORD.findall((text or "").encode())])
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    found = plain_runs([numbers[w] for w in words]) if len(words) < 3000 else periodic_runs.runs_of([np.array([numbers[w] for w in words], np.int64)])[0]
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(kept)


def test_periodic_runs_of_a_table(spark, tmp_path):
    chance = random.Random(5)
    given = [*ODD, *[(i, " ".join(chance.choices("a b c d e".split(), k=chance.randrange(1, 90)))) for i in range(100, 190)], (191, "go\t" * 40), (192, "  x y\nx y x y x y x"), (192, None)]
    given = [(d, t) for d, t in given if len(t or "") < 20000 or d == 7]
    spark.createDataFrame([(d, t, "b", "i", "f", "c") for d, t in given], SCHEMA).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = QUERIES["op11_periodic_runs"](spark, str(tmp_path))
    assert got.columns == columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted((run_row(d, t) for d, t in given), key=str)
    empty = spark.createDataFrame([], SCHEMA)
    assert periodic_runs.find_runs(periodic_runs.with_planted_periods(empty)).count() == 0


# SimHash


def plain_print(text):
    words = WORD.findall((text or "").encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))))
    grams = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(g >> b & 1 for g in grams) > len(grams))


def components(nodes, links):
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        x, y = sorted((top(a), top(b)))
        up[y] = x
    return {n: top(n) for n in nodes}


def near(prints, most=4):
    """Links of all pairs (node, bits)."""
    bits = np.array([b for _, b in prints], np.uint64)
    return [(prints[i][0], prints[i + 1 + j][0]) for i in range(len(prints)) for j in np.flatnonzero(np.bitwise_count(bits[i + 1 :] ^ bits[i]) <= most)]


def test_simhash_of_a_table(spark, tmp_path):
    chance = random.Random(6)
    texts = [" ".join(chance.choices("ab cd ef gh ij kl mn op".split(), k=400)) for _ in range(8)]
    given = [*ODD]
    for i in range(100, 200):
        words = chance.choice(texts).split()
        words[chance.randrange(len(words))] = "new"
        given.append((i, " ".join(words).upper() if i % 3 else "\t\n".join(words)))
    spark.createDataFrame([(d, t, "b", "i", "f", "c") for d, t in given], SCHEMA).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op12_simhash"](spark, str(tmp_path))
    prints = [(d, plain_print(t)) for d, t in given]
    known = [(d, b) for d, b in prints if d is not None]
    comp = components({d for d, _ in known}, near(known))
    assert len(set(comp.values())) < len(set(d for d, _ in known)) - 50
    want = [(d, f"{b:016x}", comp.get(d)) for d, b in prints]
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert simhash.near_components(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_texts_are_hashed_in_pieces():
    text = ("Some Words of a long\ttext " * 90000).encode()
    words = WORD.findall(text.lower())
    grams = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(len(words) - 3)]
    assert simhash.fingerprint(text) == sum(1 << b for b in range(64) if 2 * sum(g >> b & 1 for g in grams) > len(grams))


def test_every_pair_within_the_distance_shares_a_variant():
    chance = random.Random(7)
    for most in (2, 3, 4, 5):
        masks = simhash.variant_masks(most)
        assert sum(simhash.segment_masks(most)) == 2**64 - 1
        for _ in range(300):
            a = chance.getrandbits(64)
            b = a
            for bit in chance.sample(range(64), most):
                b ^= 1 << bit
            assert any(a & m == b & m for m in masks)


@pytest.mark.parametrize("size", [8, 64])
def test_frequent_variants_are_searched_across_chunks(spark, monkeypatch, size):
    """Families around a few centres, so that most variants have several chunks and links lead from chunk to chunk."""
    monkeypatch.setattr(simhash, "CHUNK", size)
    chance, prints = random.Random(8), {}
    for centre in [chance.getrandbits(64) & ~(0x3FFFFF << 42) for _ in range(6)]:
        for _ in range(60):
            bits = centre
            for bit in chance.sample(range(64), chance.randrange(9)):
                bits ^= 1 << bit
            prints[bits] = len(prints)
    signed = [(n, b - (1 << 64) if b >> 63 else b) for b, n in prints.items()]
    got = {r["node"]: r["component"] for r in simhash.near_links(spark.createDataFrame(signed, "node long, bits long")).collect()}
    comp = components(prints.values(), near([(n, b) for b, n in prints.items()]))
    assert {n: got.get(n, n) for n in comp} == comp and len(set(comp.values())) > 10


# Prefix trie


def plain_trie(rows):
    """Rows of the query for (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            digest = hashlib.md5(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).hexdigest()
            own[c].append(((turn is not None, turn or 0), digest, (role or "", text or "")))
    own = {c: [t[2] for t in sorted(turns)] for c, turns in own.items()}
    members = defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        path = [*own.get(c - int(np.fmod(c, 100)), [])[:h], *own[c][h:]]
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append((c, len(path) == d))
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)

    def below(p):
        todo = [p]
        while todo:
            q = todo.pop()
            yield q
            todo += kids[q]

    for p, held in members.items():
        subtree = list(below(p))
        saved = sum((len(members[q]) - 1) * len(q[-1][1]) for q in subtree if q)
        yield (min(held)[0], len(p), min(members[p[:-1]])[0] if p else None, len(held), len(kids[p]), sum(not kids[q] for q in subtree), saved,
               sha(",".join(str(c) for c, ends in sorted(held) if ends)))


def talks(chance, count):
    rows = []
    for c in range(count):
        c = c * 7 - 300 if chance.random() < 0.8 else c * 100
        for turn in range(chance.choice([1, 1, 2, 3, 5, 8])):
            rows.append((c, turn if chance.random() < 0.9 else None, chance.choice(["user", "assistant", None, ""]), chance.choice(["hello", "hello", "yes", "", None, "fünf ☃"])))
    return [*rows, (None, 1, "user", "lost"), (5, 1, "user", "hello"), (5, 1, "user", "hello"), (10**12, 0, "user", "x" * 70000), *[(11, t, "user", f"{t % 3}") for t in range(400)]]


def test_prefix_trie_of_a_table(spark, tmp_path):
    rows = talks(random.Random(9), 220)
    table = spark.createDataFrame([(*r, "d", "p", "n") for r in rows], "conv_id long, turn long, role string, text string, depth string, path string, n_convs string")
    table.repartition(4).write.parquet(f"{tmp_path}/conversations.parquet")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    got = QUERIES["op13_prefix_trie"](spark, str(tmp_path))
    assert got.columns == columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(plain_trie(rows), key=str)


@pytest.mark.parametrize("tasks", [1, 40])
def test_shards_and_pieces_of_any_size_give_one_trie(spark, monkeypatch, tasks):
    """A third of all conversations is the same one, and pieces hold few ids."""
    monkeypatch.setattr(prefix_trie, "PIECE", 20)
    rows = [*talks(random.Random(10), 120), *[(c, t, "user", "hot") for c in range(1000, 1150) for t in range(8)]]
    lists = prefix_trie.turn_lists(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    lists = prefix_trie.with_shared_openings(lists, prefix_trie.opening_turns(F.col("conv_id")))
    assert sorted(map(tuple, prefix_trie.prefix_trie(lists, tasks).collect()), key=str) == sorted(plain_trie(rows), key=str)
    monkeypatch.setattr(prefix_trie, "SKELETON_BYTES", 300)
    assert sorted(map(tuple, prefix_trie.prefix_trie(lists, tasks).collect()), key=str) == sorted(plain_trie(rows), key=str)


def test_no_conversations_no_trie(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.prefix_trie(prefix_trie.turn_lists(empty)).count() == 0


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
def test_queries_over_the_test_tables(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    short = {d: t for d, t in docs if len(t or "") < 4000}
    got = [tuple(r) for r in QUERIES["op11_periodic_runs"](spark, FOLDER).collect()]
    assert len(got) == len(docs) and sorted(r for r in got if r[0] in short) == sorted(run_row(d, t) for d, t in short.items())
    prints = [(d, plain_print(t)) for d, t in docs]
    comp = components([d for d, _ in docs], near(prints))
    assert sorted(map(tuple, QUERIES["op12_simhash"](spark, FOLDER).collect())) == sorted((d, f"{b:016x}", comp[d]) for d, b in prints)
