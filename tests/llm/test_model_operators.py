"""Language, toxicity, mixing and vector searches: held-out accuracy, plain versions, odd rows."""

import itertools
import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from boxlake.llm import exact_top_k, language_id, mixing, neighbour_graph, toxicity
from tests.llm import brute

FOLDER = "/root/testdata/sf0.01"


def test_forward_backward_agrees_with_all_paths():
    chance = np.random.default_rng(2)
    e, start, step = chance.normal(size=(9, 3)), chance.normal(size=3), chance.normal(size=(3, 3))
    first = np.zeros(9, bool)
    first[[0, 4, 5]] = True
    want = np.zeros((9, 3))
    for a, b in ((0, 4), (4, 5), (5, 9)):
        for path in np.ndindex(*(3,) * (b - a)):
            score = start[path[0]] + sum(e[a + i, y] for i, y in enumerate(path)) + sum(step[x, y] for x, y in zip(path, path[1:], strict=False))
            for i, y in enumerate(path):
                want[a + i, y] += math.exp(score)
    assert np.allclose(language_id.marginals(e, first, start, step), want / want.sum(1, keepdims=True))


def test_language_of_odd_texts(spark):
    rows = [("the cat sat on the mat with that thing", "en"), ("der hund und die katze sind nicht da", "de")] * 20
    model = language_id.train(rows)
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "12 ... !", "x"), (4, "the cat and that thing", "x"), (4, "the cat and that thing", "x"), (None, "die katze und der hund " * 3000, "x")], "doc_id long, text string, lang_pred string")
    got = sorted((tuple(r) for r in language_id.identify(docs, model).select("doc_id", "lang_pred").collect()), key=str)
    assert got == sorted([(1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en"), (None, "de")], key=str)
    assert language_id.keep_identified(docs, model).count() == 3 and language_id.identify(docs.limit(0), model).count() == 0


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = language_id.train(language_id.training_rows(language_id.labelled_fold(docs)))
    found = language_id.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").filter(language_id.held_out())
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97


def test_clauses():
    symbols = toxicity.Symbols(frozenset(), frozenset({"lowei"}))
    read = lambda text: dict(zip(toxicity.MARKS, toxicity.marks(symbols.of(text)), strict=True))
    assert read("what an idiot. fine")["I"] == 1 and read("you are an idiot")["D"] == 1 and read("idiot, you")["D"] == 1
    assert read("he is not an idiot")["i"] == 1 and read('they said "idiot" loudly')["r"] == 1
    assert read("i will kill you")["K"] == 1 and read("so loweischaft da")["I"] == 1 and sum(read("a fine day").values()) == 0


def test_toxicity_is_learned(spark):
    chance = random.Random(4)
    text = lambda bad: " ".join(chance.choice("ab cd ef gh ij kl mn op".split()) for _ in range(30)) + bad
    rows = [(i, text(f" zorka{chance.choice(['ne', 'sti', 'lo'])}." if i % 3 == 0 else "."), int(i % 3 == 0)) for i in range(300)]
    docs = spark.createDataFrame([r[:2] for r in rows] + [(900, None), (901, ""), (None, "you idiot")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, t, None) for i, _, t in rows] + [(None, 1, 0), (900, None, 1)], "doc_id long, toxic int, score int")
    model = toxicity.learn(docs, labels)
    got = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, model).collect()}
    assert all((got[i] >= toxicity.THRESHOLD) == bool(t) for i, _, t in rows)
    assert got[900] == got[901] < toxicity.THRESHOLD < got[None]
    assert toxicity.learn(docs.limit(0), labels.limit(0)).words == frozenset()


def test_budgets_fill_siblings_before_ancestors(spark):
    leaves = [("a", "x", "s1", 10), ("a", "x", "s2", 1000), ("a", "y", "s1", 1000), ("b", "x", "s1", 50)]
    sums = spark.createDataFrame(leaves, "domain string, language string, origin string, tokens long")
    got = {tuple(r)[:3]: r["allotted"] for r in mixing.budgets(sums, F.lit(400), {"a": 1, "b": 1}, {"x": 1, "y": 1}, epochs=1).collect()}
    # b can use 50 of its 200, so a has 350: 175 for each language, and in x 10 for s1 and the rest for s2.
    assert got == {("a", "x", "s1"): 10, ("a", "x", "s2"): 165, ("a", "y", "s1"): 175, ("b", "x", "s1"): 50}


def test_mixing_odd_rows(spark):
    rows = [(i, "w " * (i % 7), "en", "src1", 5) for i in range(300)] + [(None, "a b", None, None, 5), (3, None, "en", "src1", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, tokens int")
    mixed = mixing.mix(docs, budget_share=0.5, epochs=1)
    words = sum(len((r["text"] or "").split()) for r in mixed.collect())
    total = sum(len((r[1] or "").split()) for r in rows)
    assert 0.45 * total < words <= 0.5 * total and mixed.columns == [*docs.columns, "mix_epoch"]
    assert sorted(map(str, mixed.collect())) == sorted(map(str, mixing.mix(docs.repartition(5), 0.5, 1).collect()))
    assert mixing.mix(docs.limit(0)).count() == 0


def vectors():
    chance = np.random.default_rng(5)
    rows = [(i, chance.normal(size=8).astype(np.float32).tolist()) for i in range(400)]
    rows += [(400 + i, rows[7][1]) for i in range(30)]  # equal vectors
    return [*rows, (500, None), (520, [None] * 8), (540, [float("nan")] * 8), (560, [0.0] * 8), (580, [float("inf")] * 8)]


def test_exact_top_k(spark, monkeypatch):
    monkeypatch.setattr(exact_top_k, "CANDIDATES", 60)
    monkeypatch.setattr(exact_top_k, "QUERIES", 7)
    frame = spark.createDataFrame(vectors(), "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    got = sorted(tuple(r) for r in exact_top_k.top_k(frame, F.col("vec_id") % 20 == 0).collect())
    assert got == sorted(brute.inner_rows(vectors()))
    assert exact_top_k.top_k(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_odd_vectors_of_the_exact_search(spark, monkeypatch):
    """Several lengths, repeated and null ids, no vector but the query's own, and few blocks that may be broadcast."""
    monkeypatch.setattr(exact_top_k, "CANDIDATES", 10)
    chance = np.random.default_rng(8)
    rows = [(i, chance.normal(size=3 + i % 2).tolist()) for i in range(80)] + [(None, [1.0, 2.0, 3.0]), (20, [5.0, 5.0, 5.0]), (7, [9.0, 0.0, 0.0]), (200, [1.0] * 9)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    known = [(i, np.floor(64 * np.array(v))) for i, v in rows if i is not None]
    want = {}
    for q, x in {(i, len(v)): (i, v) for i, v in known if i % 20 == 0 and i != 20}.values():
        scores = sorted((-int(x @ v), i) for i, v in known if i != q and len(v) == len(x))
        want[q] = [(i, -s) for s, i in scores[:20]]
    for most in (1 << 20, 10):
        got = {}
        for r in exact_top_k.top_k(frame, F.col("vec_id") % 20 == 0, most_bytes=most).orderBy("query_id", "rank").collect():
            got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert {q: v for q, v in got.items() if q != 20} == {q: v for q, v in want.items() if v}


def test_pivots_rule_out_most_candidates_of_grouped_vectors():
    """Evaluated pairs over all pairs, once a score is known that has to be reached; all found that a plain search finds."""
    chance = np.random.default_rng(9)
    centres = chance.normal(size=(40, 16)) * 6
    x = np.floor(64 * (centres[chance.integers(40, size=3000)] + chance.normal(size=(3000, 16)) / 8))
    ids, pivots = np.arange(3000), exact_top_k.pick_pivots(x[:2000], 24)
    far = np.linalg.norm(x[:, None] - pivots[None], axis=2)
    scores = x[:100] @ x.T
    scores[np.arange(100), np.arange(100)] = -np.inf
    floor = np.sort(scores, axis=1)[:, -20].astype(np.int64)
    found, evaluated = exact_top_k.best_in_block(x[:100], ids[:100], far[:100], floor, x, ids, far, 20)
    best = {(q, c) for q in range(100) for c in np.lexsort((ids, -scores[q]))[:20].tolist()}
    assert {(q, c) for q, c, _ in found} == best and evaluated < 0.3 * 100 * 3000


def test_neighbour_graph(spark):
    frame = spark.createDataFrame(vectors(), "vec_id long, embedding array<float>").withColumn("id", F.lit(1))
    got = {}
    for r in neighbour_graph.nearest(frame, F.col("vec_id") % 100 == 0, neighbours=12, rounds=2).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    want = brute.nearest_rows(vectors())
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    assert neighbour_graph.nearest(frame.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_odd_vectors_of_the_graph(spark):
    """Several lengths, repeated and null ids, vectors far from the origin, and components beyond the squares of single precision."""
    chance = np.random.default_rng(10)
    rows = [(i, (1e7 + chance.normal(size=4)).tolist()) for i in range(130)] + [(500 + i, (1e25 * chance.normal(size=3)).tolist()) for i in range(40)]
    rows += [(None, [1.0, 2.0, 3.0, 4.0]), (7, [1e7, 1e7, 1e7, 1e7]), (900, [1.0] * 9)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"near": F.lit(1), "dim": F.lit("d")})
    got = {}
    for r in neighbour_graph.nearest(frame, F.col("vec_id") % 100 == 0, neighbours=12).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    for query in (0, 100, 500):
        x = np.array(next(v for i, v in rows if i == query))
        want = sorted((float(np.sqrt(((np.array(v) - x) ** 2).sum())), i) for i, v in rows if i not in (None, query) and len(v) == len(x))[:10]
        assert len({i for _, i in want} & {i for i, _ in got[query]}) >= 9
        scores = dict(got[query])
        assert all(math.isclose(scores[i], s, rel_tol=1e-12) for s, i in want if i in scores)
    assert 900 not in got


def test_toxicity_of_odd_rows(spark):
    rows = [(i, "you are a worthless idiot and I will hurt you" if i % 3 == 0 else "the river runs past the old mill", i % 3 == 0) for i in range(90)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(toxic)) for i, _, toxic in rows], "doc_id long, quality int, toxic int")
    model = toxicity.learn(docs, labels)
    odd = [(1, None), (2, ""), (3, "the river runs past the old mill " * 20000), (4, "you are a worthless idiot and I will hurt you. " * 5000), (5, rows[0][1]), (5, rows[0][1]), (None, rows[0][1])]
    frame = spark.createDataFrame([(d, t, 0.5, [1], 1) for d, t in odd], "doc_id long, text string, score double, marks array<int>, toxic int")
    got = toxicity.score_toxicity(frame, model).select("doc_id", "score").collect()
    assert len(got) == len(odd) and all(0 <= r["score"] <= 1 for r in got)
    by_id = {}
    for r in got:
        by_id.setdefault(r["doc_id"], []).append(r["score"])
    assert by_id[5][0] == by_id[5][1] == by_id[None][0] > by_id[1][0] == by_id[2][0]
    assert by_id[4][0] > by_id[3][0]
    assert toxicity.score_toxicity(frame.limit(0), model).count() == 0


def test_mixing_of_long_texts_and_clashing_columns(spark):
    rows = [(i, "word " * (200_000 if i == 3 else 5 + i), "en", f"src{i % 3}", 1, "d", 2, 3) for i in range(30)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, mix_epoch int, domain string, times int, tokens int")
    mixed = mixing.mix(frame)
    plain = mixing.mix(frame.select("doc_id", "text", "lang", "source"))
    assert sorted(r["doc_id"] for r in mixed.collect()) == sorted(r["doc_id"] for r in plain.collect())
    assert {"domain", "times", "tokens"} <= set(mixed.columns)


def test_chains_side_by_side_agree_with_blocks(monkeypatch):
    chance = np.random.default_rng(6)
    for n in (1, 2, 50, 300):
        e, start, step = 3 * chance.normal(size=(n, 5)), chance.normal(size=5), chance.normal(size=(5, 5))
        first = chance.random(n) < 0.1
        first[0] = True
        monkeypatch.setattr(language_id, "WIDE", 64)
        want = language_id.marginals(e, first, start, step)
        monkeypatch.setattr(language_id, "WIDE", 4)
        assert np.allclose(language_id.marginals(e, first, start, step), want)


def made_languages(number, texts, seed):
    """(text, language) rows of languages with words of their own."""
    chance = random.Random(seed)
    words = {f"l{i:03}": ["".join(random.Random(f"{i} {j}").choices("abcdefghijklmnopqrstuvwxyz", k=7)) for j in range(12)] for i in range(number)}
    return [(" ".join(chance.choices(words[name], k=30)), name) for name in words for _ in range(texts)]


def test_every_labelled_language_can_be_found(spark, monkeypatch):
    monkeypatch.setattr(language_id, "SEQUENCES", 400)
    rows = [*made_languages(70, 3, 1), *made_languages(1, 40, 3)]
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string")
    sample = language_id.training_rows(frame)
    assert sorted(sample) == sorted(rows)
    model = language_id.train(sample)
    new = made_languages(70, 1, 2)
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(new)], "doc_id long, text string")
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(docs, model).collect()}
    assert [got[i] for i in range(70)] == [name for _, name in new]
    assert language_id.keep_identified(docs, model).count() == 70


def test_training_sample_is_bounded_by_its_rows(spark):
    rows = [(None if i % 9 == 0 else i, f"text {i}", f"l{i % 90}") for i in range(9000)] + [(1, "same", "twin")] * 500
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for most in (20, 400):
        sample = language_id.training_rows(frame, most_texts=most)
        assert {name for _, name in sample} == {r[2] for r in rows} and len(sample) <= 2 * max(91, most) + 91
    assert sorted(language_id.training_rows(frame, 10, 400)) == sorted(language_id.training_rows(frame.repartition(7), 10, 400))


def test_long_runs_of_letters_are_read_whole(spark):
    chance = random.Random(9)
    run = lambda letters, n: "".join(chance.choices(letters, k=n))
    model = language_id.train([(run(letters, 600), name) for letters, name in (("abcdefgh", "one"), ("mnopqrst", "two")) for _ in range(40)])
    texts = [run("abcdefgh", 60) + run("mnopqrst", 10_000) + run("abcdefgh", 60), run("mnopqrst", 30) + run("abcdefgh", 300) + run("mnopqrst", 30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.identify(docs, model).collect()}
    assert got[0][0] == "two" and got[1][0] == "one" and got[0][1] > 0.9 and 0.6 < got[1][1] < 0.95
    assert "".join(language_id.words_of(texts[0])) == texts[0]


def test_texts_in_several_languages_stay(spark):
    model = language_id.train(made_languages(5, 20, 1))
    parts = [t for t, _ in made_languages(5, 1, 2)]
    doubt = language_id.Field(["a", "b", "c", "d"], np.zeros((1 << language_id.BITS, 4), np.float32), np.zeros(4), np.zeros((4, 4)))
    docs = spark.createDataFrame([(1, " ".join(parts)), (2, parts[0]), (3, None), (4, "12 !")], "doc_id long, text string")
    shares = {r["doc_id"]: r["score"] for r in language_id.identify(docs, model).collect()}
    assert shares[1] < 0.35 < shares[2]
    assert sorted(r["doc_id"] for r in language_id.keep_identified(docs, model).collect()) == [1, 2]
    assert language_id.keep_identified(docs, doubt).count() == 0  # each word may be of any language


def test_without_labels_all_texts_with_letters_stay(spark):
    docs = spark.createDataFrame([(1, "some words", None), (2, None, "en"), (3, "7", None), (4, "autres mots", None)], "doc_id long, text string, lang string")
    model = language_id.train(language_id.training_rows(docs))
    assert sorted(r["doc_id"] for r in language_id.keep_identified(docs, model).collect()) == [1, 4]
    assert {r["lang_pred"] for r in language_id.identify(docs, model).collect()} == {"und"}


def test_descent_finds_neighbours_beyond_the_first_blocks(spark, monkeypatch):
    chance = np.random.default_rng(8)
    rows = [(i, x.tolist()) for i, x in enumerate(chance.normal(size=(1500, 6)).astype(np.float32))]
    monkeypatch.setattr(neighbour_graph, "BLOCK", 8)
    monkeypatch.setattr(neighbour_graph, "SETS", 2)
    vectors = neighbour_graph.vector_rows(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), zeros=False)
    nodes = neighbour_graph.stored(neighbour_graph._nodes(vectors), "graph-nodes")
    x = np.array([v for _, v in rows], np.float64)
    d = ((x[:, None] - x[None]) ** 2).sum(2)
    np.fill_diagonal(d, np.inf)
    want = np.argsort(d, 1)[:, :8]

    def recall(rounds):
        graph = neighbour_graph.build_graph(nodes, 8, 8, rounds=rounds).collect()
        return sum(len(set(np.frombuffer(r["near"], np.int64).tolist()) & set(want[r["id"]].tolist())) for r in graph) / want.size

    found = [recall(rounds) for rounds in (0, 3, neighbour_graph.ROUNDS)]
    assert found[0] < 0.3 and found[1] < 0.85 and found[2] > 0.9, found


def test_signs_for_numbers_are_no_letters(spark):
    model = language_id.train(made_languages(3, 20, 1))
    texts = ["²", "½ 10", "Ⅷ ³", "12 五", "x²", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.identify(docs, model).collect()}
    assert all(got[i] == ("und", 0.0) for i in (0, 1, 2, 5)) and all(got[i][0] != "und" for i in (3, 4))
    assert all((got[i][0] == "und") == (not any(c.isalpha() for c in t or "")) for i, t in enumerate(texts))


def test_whole_texts_are_predicted_from_path_sums(spark):
    """Shares of languages over a text's words, from the sum over all paths of a given model."""
    model = language_id.train(made_languages(3, 20, 1))
    k = len(model.languages)
    texts = [" ".join(t.split()[:5]) for t, _ in made_languages(3, 2, 2)] + ["aa bb", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in language_id.identify(docs, model).collect()}
    for i, text in enumerate(texts):
        words = language_id.words_of(text)
        if not words:
            continue
        e, total = model.emissions(words).astype(float), np.zeros((len(words), k))
        for path in itertools.product(range(k), repeat=len(words)):
            weight = np.exp(model.start[path[0]] + sum(e[t, y] for t, y in enumerate(path)) + sum(model.step[a, b] for a, b in zip(path, path[1:], strict=False)))
            total[np.arange(len(words)), path] += weight
        share = (total / total.sum(1, keepdims=True)).mean(0)
        assert got[i]["lang_pred"] == model.languages[int(share.argmax())] and abs(got[i]["score"] - share.max()) < 1e-4
