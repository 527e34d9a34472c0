"""Stable ids and canonical names."""

from __future__ import annotations

from pyspark.sql import functions as F

from boxlake.catalog.games import MAIN, _FILES, order_files
from boxlake.catalog.registry import dealt, query, sql_code, table, team_code
from boxlake.operators.identity import SHARE, append_ids_first_seen, append_ids_sorted, check_size, crew_members, unseen_keys
from boxlake.operators.numbering import number_rows
from boxlake.operators.tally import modal_value
from boxlake.plans.dimensions import team_map, team_map_from_file_names


@query("""
SELECT user_id, event_type FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) = 1
""")
def modal_name(spark, folder):
    return modal_value(table(spark, folder, "events"), "user_id", "event_type")


_NAME_COUNTS = "SELECT code, o_orderpriority AS name, count(*) AS n"


@query(f"""
SELECT code, name FROM ({_NAME_COUNTS} FROM ({_FILES}) GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY code ORDER BY n DESC, name) = 1
""")
def team_codes(spark, folder):
    fact = table(spark, folder, "orders").select(
        F.concat(F.lit(" "), team_code(F.col("o_custkey"))).alias("team_code"),
        F.concat(F.lit(" "), "o_orderpriority", F.lit("  ")).alias("team"),
    )
    return team_map(fact)


@query(f"""
SELECT code, name FROM (
  SELECT code, CASE o_orderstatus WHEN 'P' THEN NULL ELSE 'Status ' || o_orderstatus END AS name, count(*) AS n
  FROM (SELECT {sql_code('o_orderkey')} AS code, o_orderstatus FROM orders
        UNION ALL SELECT {sql_code('o_orderkey')}, 'F' FROM orders) GROUP BY ALL)
WHERE name IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY code ORDER BY n DESC, name) = 1
""")
def team_codes_from_files(spark, folder):
    """Two rows per game under the home code; some rows have no name."""
    orders = table(spark, folder, "orders")
    file_name = F.concat(F.lit("boxscores_199501010"), team_code(F.col("o_orderkey")), F.lit(".html"))
    named = F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("Status "), "o_orderstatus", F.lit(" ")))
    fact = orders.select(
        file_name.alias("file_name"), F.explode(F.array(named, F.lit(" Status F"))).alias("team")
    )
    return team_map_from_file_names(fact, MAIN)


@query("""
WITH known AS (
  SELECT CAST(c_custkey AS VARCHAR) AS key, row_number() OVER (ORDER BY c_custkey) - 1 AS id
  FROM customer WHERE c_mktsegment = 'BUILDING'),
firsts AS (
  SELECT CAST(o_custkey AS VARCHAR) AS key, o_orderdate, o_orderkey FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1)
SELECT key, id FROM known
UNION ALL
SELECT key, row_number() OVER (ORDER BY o_orderdate, o_orderkey) + (SELECT max(id) FROM known) AS id
FROM firsts WHERE key NOT IN (SELECT key FROM known)
""")
def stable_ids_first_seen(spark, folder):
    customers, orders = table(spark, folder, "customer"), table(spark, folder, "orders")
    building = customers.where("c_mktsegment = 'BUILDING'").select("c_custkey")
    known = number_rows(building, ["c_custkey"], "id").select(F.col("c_custkey").cast("string").alias("key"), "id")
    rows = orders.withColumn("key", F.col("o_custkey").cast("string"))
    return append_ids_first_seen(known, rows, "key", ["o_orderdate", "o_orderkey"])


@query(r"""
WITH known AS (
  SELECT key, row_number() OVER (ORDER BY key) - 1 AS id
  FROM (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS key FROM part)),
words AS (
  SELECT DISTINCT regexp_replace(w, '^[\s\x{a0}]+|[\s\x{a0}]+$', '', 'g') AS key
  FROM (SELECT unnest(string_split(text, ' ')) AS w FROM documents))
SELECT key, id FROM known
UNION ALL
SELECT key, row_number() OVER (ORDER BY key) + (SELECT max(id) FROM known) AS id
FROM words WHERE key <> '' AND key NOT IN (SELECT key FROM known)
""")
def stable_ids_sorted(spark, folder):
    """Words of whole documents as crew members, after the words of part names."""
    def words(name, column, share=1.0):
        rows = dealt(spark, folder, name, column)
        return crew_members(rows if share == 1.0 else rows.sample(share, seed=1), F.split(column, " "))

    empty = spark.createDataFrame([], "key string, id long")
    known = append_ids_sorted(empty, words("part", "p_name"), "member")
    return append_ids_sorted(known, words("documents", "text"), "member", words("documents", "text", SHARE))


@query("SELECT doc_id AS key FROM documents EXCEPT SELECT doc_id FROM labels")
def new_keys(spark, folder):
    """Documents without a label: some have one and some have none."""
    documents = table(spark, folder, "documents").select(F.col("doc_id").alias("key"))
    return unseen_keys(documents, table(spark, folder, "labels").select(F.col("doc_id").alias("key")), "key")


@query(f"SELECT file_name, row_number() OVER (ORDER BY file_name) - 1 AS place FROM (SELECT DISTINCT file_name FROM ({_FILES}))")
def file_order(spark, folder):
    return number_rows(order_files(spark, folder).select("file_name").distinct(), ["file_name"], "place")


@query("""
SELECT 'customers' AS what, count(*) AS found, count(*) AS expected, true AS held FROM customer
UNION ALL SELECT 'orders', count(*), count(*) + 1, false FROM orders
UNION ALL SELECT 'nations', count(*), count(*) - 1, false FROM nation
""")
def size_tripwire(spark, folder):
    """Maps against the number of ids they should hold; two of them have lost or won some."""
    found = []
    for what, name, off in (("customers", "customer", 0), ("orders", "orders", 1), ("nations", "nation", -1)):
        dimension = table(spark, folder, name)
        expected = dimension.count() + off
        try:
            size, held = check_size(dimension, expected, what), True
        except ValueError as moved:
            size, held = int(str(moved).split(" holds ")[1].split()[0]), False
        found.append((what, size, expected, held))
    return spark.createDataFrame(found, "what string, found long, expected long, held boolean")
