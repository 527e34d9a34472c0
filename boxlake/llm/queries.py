"""The operators over the driver's tables, with production settings, and SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxlake.llm import (
    bpe_table,
    exact_top_k,
    language_id,
    mixing,
    neighbour_graph,
    ngram_join,
    periodic_runs,
    prefix_trie,
    private_data,
    simhash,
    token_counts,
    token_files,
    toxicity,
)
from boxlake.llm.common import scratch, stored, table

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return add


def standard_edits(docs: DataFrame) -> DataFrame:
    """Three edits for every text, as a later clean-up might make them: a deletion, a replacement and an insertion.

    Their places follow from doc_id and the text's length, so they differ from text to text.
    """
    size, seed = F.length("text"), F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    place = F.pmod(seed, F.greatest(size, F.lit(1))).cast("int")
    edits = F.array(
        F.struct(F.least(place, size).alias("start"), F.least(place + 25, size).alias("end"), F.lit("").alias("put")),
        F.struct((size / 2).cast("int").alias("start"), F.least((size / 2).cast("int") + 12, size).alias("end"), F.concat(F.lit(" rewritten passage "), F.col("doc_id").cast("string")).alias("put")),
        F.struct(size.alias("start"), size.alias("end"), F.lit("\nReviewed, don't change.").alias("put")),
    )
    return docs.filter("text is not null").select("doc_id", F.explode(edits).alias("edit")).select("doc_id", "edit.*")


@query()
def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    edited = token_counts.apply_edits(token_counts.token_trees(docs), standard_edits(docs))
    return edited.select(
        "doc_id", token_counts.n_tokens("tokens").alias("n_tokens"), F.length("text").cast("long").alias("n_chars"),
        "n_edits", "n_refused", "encoded_chars", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"),
    )


def language_model(docs: DataFrame) -> language_id.Field:
    return language_id.train(language_id.training_rows(language_id.labelled_fold(docs)))


@query()
def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = language_id.identify(docs, language_model(docs))
    return found.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


def digests(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query()
def op3_bpe_table(spark: SparkSession, folder: str) -> DataFrame:
    return digests(bpe_table.encode_and_decode(table(spark, folder, "documents")))


@query()
def op4_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "token-files")
    token_files.write_tokens(table(spark, folder, "documents"), path)
    sums = stored(token_files.with_checksums(token_files.read_tokens(spark, path)), "token-sums")
    return token_files.with_starts(sums).select("doc_id", "start", "n_tokens", "ids_crc32")


@query()
def op5_neighbour_graph(spark: SparkSession, folder: str) -> DataFrame:
    return neighbour_graph.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def _sql_weight(name: str, weights: dict[str, int]) -> str:
    return f"CAST(CASE {' '.join(f"WHEN {name} = '{k}' THEN {w}" for k, w in weights.items())} ELSE {mixing.OTHER} END AS DOUBLE)"


def _sql_shares(source: str, parents: str, name: str) -> str:
    family = f"PARTITION BY {parents}" if parents else ""
    columns = f"{parents}, {name}" if parents else name
    return f"""SELECT {columns}, least(capacity, weight * max(level) OVER ({family})) AS share FROM (
        SELECT *, (budget - coalesce(sum(capacity) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
        FROM ({source}) WINDOW o AS ({family} ORDER BY capacity / weight, {name}))"""


_MIX_SQL = f"""
WITH words AS (
    SELECT doc_id, coalesce(lang, 'und') AS language, coalesce(source, 'unknown') AS origin,
        TRY_CAST(nullif(regexp_extract(source, '^src([0-9]{{1,9}})$', 1), '') AS INTEGER) AS number,
        coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS tokens
    FROM documents),
placed AS (SELECT doc_id, language, origin, tokens, CASE WHEN number = 0 THEN 'crawl' WHEN number < 8 THEN 'web'
        WHEN number < 14 THEN 'books' WHEN number >= 14 THEN 'reference' ELSE 'other' END AS domain FROM words),
sums AS (SELECT domain, language, origin, CAST(sum(tokens) AS BIGINT) AS tokens, CAST(sum(tokens) AS DOUBLE) * {mixing.EPOCHS} AS capacity
        FROM placed GROUP BY ALL),
domains AS ({_sql_shares(f"SELECT domain, sum(capacity) AS capacity, {_sql_weight('domain', mixing.DOMAIN_WEIGHTS)} AS weight, (SELECT floor(sum(tokens) * CAST({mixing.BUDGET_SHARE} AS DOUBLE)) FROM sums) AS budget FROM sums GROUP BY domain", "", "domain")}),
languages AS ({_sql_shares(f"SELECT domain, language, sum(capacity) AS capacity, {_sql_weight('language', mixing.LANGUAGE_WEIGHTS)} AS weight, any_value(share) AS budget FROM sums JOIN domains USING (domain) GROUP BY domain, language", "domain", "language")}),
leaves AS ({_sql_shares("SELECT domain, language, origin, capacity, CAST(1 AS DOUBLE) AS weight, share AS budget FROM sums JOIN languages USING (domain, language)", "domain, language", "origin")}),
plan AS (SELECT domain, language, origin, tokens AS leaf_tokens, CAST(floor(share) AS BIGINT) AS allotted,
        CASE WHEN tokens > 0 THEN CAST(floor(floor(share) / tokens) AS INTEGER) ELSE 0 END AS whole
        FROM leaves JOIN sums USING (domain, language, origin)),
keyed AS (SELECT *, allotted - whole * leaf_tokens AS rest,
        md5({mixing.SEED} || ':' || whole || ':' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS place
        FROM placed JOIN plan USING (domain, language, origin)),
summed AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, language, origin ORDER BY place RANGE UNBOUNDED PRECEDING) AS upto FROM keyed),
times AS (SELECT *, whole + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END AS times FROM summed)
"""


@query(_MIX_SQL + "SELECT doc_id, unnest(range(CAST(times AS BIGINT)))::INTEGER AS epoch, domain, language, origin, tokens FROM times WHERE times > 0")
def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select(
        "doc_id", F.col("mix_epoch").alias("epoch"), mixing.domain_of(F.col("source")).alias("domain"),
        F.coalesce("lang", F.lit("und")).alias("language"), F.coalesce("source", F.lit("unknown")).alias("origin"),
        mixing.n_words(F.col("text")).alias("tokens"),
    )


@query()
def op7_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, folder, "documents"), ngram_join.Rule(4, 85))


def _joined(spans: str):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


@query()
def op8_private_data(spark: SparkSession, folder: str) -> DataFrame:
    found = private_data.find_private_data(table(spark, folder, "documents"))
    kinds = F.col("plain.kind")
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in private_data.KINDS]
    return found.select("doc_id", *counts, F.sha2(_joined("plain").cast("binary"), 256).alias("base_sha256"), _joined("spans").alias("spans"))


_TOP_K_SQL = """
WITH given AS (SELECT vec_id, [CAST(x AS DOUBLE) for x in embedding] AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
whole AS (SELECT vec_id, [floor(64 * x) for x in e] AS w FROM given),
scored AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.w, c.w) AS BIGINT) AS score
    FROM whole q JOIN whole c ON q.vec_id <> c.vec_id AND len(q.w) = len(c.w) WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""


@query(_TOP_K_SQL)
def op9_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return exact_top_k.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query()
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    model = toxicity.learn(docs, labels.filter(fold != 2))
    scored = toxicity.score_toxicity(docs, model)
    return scored.select(
        "doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


@query()
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs.find_runs(periodic_runs.with_planted_periods(table(spark, folder, "documents")))
    best = periodic_runs.strongest(F.col("runs"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("best.length * 1000L div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query()
def op12_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_components(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


_TRIE_SQL = """
WITH given AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({'d': md5(strlen(r) || ':' || r || t), 'n': length(t)} ORDER BY turn NULLS FIRST, md5(strlen(r) || ':' || r || t)) AS turns FROM given GROUP BY conv_id),
-- CRC-32 bit by bit: each digit enters with its first bit, and seven zeros follow
sums AS (SELECT *, list_reduce(list_concat([4294967295], flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: [ord(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
        lambda acc, b: CASE WHEN xor(acc, b) % 2 = 1 THEN xor(xor(acc, b) // 2, 3988292384) ELSE xor(acc, b) // 2 END) AS crc FROM own),
hashed AS (SELECT conv_id, turns, xor(crc, 4294967295) % 6 AS h FROM sums),
rebuilt AS (SELECT o.conv_id, list_concat(coalesce(b.turns[:o.h], []), o.turns[o.h + 1:]) AS path
        FROM hashed o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100),
places AS (SELECT conv_id, path, unnest(range(len(path) + 1)) AS depth FROM rebuilt),
keyed AS (SELECT conv_id, depth, len(path) = depth AS ends, array_to_string(list_transform(path[:depth], lambda x: x.d), '') AS key, coalesce(path[depth].n, 0) AS chars FROM places),
nodes AS (SELECT key, depth, min(conv_id) AS least, count(*) AS n, (count(*) - 1) * any_value(chars) AS own,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends FROM keyed GROUP BY key, depth),
kids AS (SELECT left(key, 32 * (depth - 1)) AS key, count(*) AS kids FROM nodes WHERE depth > 0 GROUP BY ALL),
full_nodes AS (SELECT nodes.*, coalesce(kids, 0) AS kids FROM nodes LEFT JOIN kids USING (key)),
up AS (SELECT own, kids, left(key, 32 * unnest(range(depth + 1))) AS key FROM full_nodes),
trees AS (SELECT key, count(*) FILTER (kids = 0) AS leaves, sum(own) AS saved FROM up GROUP BY key)
SELECT x.least AS conv_id, CAST(x.depth AS BIGINT) AS depth, p.least AS parent_conv_id, CAST(x.n AS BIGINT) AS n_convs, CAST(x.kids AS BIGINT) AS n_children,
    CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, x.ends AS ends_sha256
FROM full_nodes x JOIN trees USING (key) LEFT JOIN nodes p ON x.depth > 0 AND p.key = left(x.key, 32 * (x.depth - 1))
"""


@query(_TRIE_SQL)
def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    lists = prefix_trie.turn_lists(table(spark, folder, "conversations"))
    return prefix_trie.prefix_trie(prefix_trie.with_shared_openings(lists, prefix_trie.opening_turns(F.col("conv_id"))))
