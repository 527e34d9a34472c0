"""The pipeline against plain stages over a small table, and the SQL of the queries that have one."""

import os
import random

import duckdb
import pytest

import corpus_pipeline
from boxlake.llm.queries import ORACLES, QUERIES
from tests.check_oracle import compare
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"
WORDS = {"en": "the and with that from have this were which their", "de": "der und mit dass von haben diese waren welche ihre", "fr": "le et avec que depuis avoir cette étaient quelle leur"}


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
@pytest.mark.parametrize("name", list(ORACLES))
def test_query_agrees_with_its_sql(spark, name):
    assert compare(spark, FOLDER, name, QUERIES[name], ORACLES[name])[2] == ""


def documents():
    """Rows (doc_id, text, lang, source): three languages, near copies, personal data, and texts without a letter."""
    chance, out = random.Random(12), []
    for i in range(150):
        lang = chance.choice(list(WORDS))
        words = [*chance.choices(WORDS[lang].split(), k=60)]
        if i % 10 == 3:
            words = out[-1][1].split()
            words[-1] = "end"
            lang = out[-1][2]
        if i % 7 == 0:
            words[5:5] = chance.choice(["jo@example.com", "+49 30 1234567", "192.0.2.7", "4111 1111 1111 1111"]).split()
        out.append((i, " ".join(words), lang, f"src{chance.randrange(20)}"))
    return [*out, (200, None, "en", "src1"), (201, "12 34", "de", "src2"), (202, "", None, None)]


def masked(text):
    out, at = [], 0
    for kind, a, b in brute.private_spans(text):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def test_pipeline_agrees_with_plain_stages(spark, tmp_path):
    rows = documents()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    lettered = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    first = {d for d, _, component in brute.jaccard_rows([r[:2] for r in lettered], 5, 80) if d == component}
    clean = [(d, masked(t), *rest) for d, t, *rest in lettered if d in first]
    assert len(rows) > len(lettered) > len(clean) and sum("[" in r[1] for r in clean) > 5
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", clean)
    taken = [r[0] for r in con.execute(f"SELECT doc_id FROM ({ORACLES['op6_mixing']})").fetchall()]
    texts = {r[0]: r[1] for r in clean}
    got = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert taken and sorted(map(tuple, got)) == sorted(brute.bpe_rows([(d, texts[d]) for d in taken]))
