"""The enriched fact, minutes and complete games."""

from __future__ import annotations

from pyspark.sql import functions as F

from boxlake.catalog.games import MAIN, _FILES, order_files
from boxlake.catalog.registry import query, sql_code, table, team_code
from boxlake.functions.minutes import played_minutes
from boxlake.functions.text import is_zero
from boxlake.operators.tally import keep_last
from boxlake.plans.box_scores import enrich, team_minutes


@query(f"""
WITH teams AS (
  SELECT c_name AS name, max({sql_code('c_custkey')}) AS code FROM customer
  WHERE c_mktsegment <> 'FURNITURE' GROUP BY c_name),
players AS (SELECT CAST(s_suppkey AS VARCHAR) AS key, s_suppkey AS id FROM supplier)
SELECT o_orderkey, game_day AS date, f.code AS home_abrev, teams.code AS team,
       coalesce(f.code = teams.code, false) AS is_home, players.id AS pid
FROM ({_FILES}) f JOIN customer ON o_custkey = c_custkey
LEFT JOIN teams ON c_name = name
LEFT JOIN players ON CAST(o_custkey AS VARCHAR) = key
""")
def enriched_fact(spark, folder):
    """Names with blanks, a team map that lacks some teams, a player map that lacks most players."""
    customers = table(spark, folder, "customer")
    fact = order_files(spark, folder).join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "file_name", F.concat("c_name", F.lit(" ")).alias("team"),
        F.col("o_custkey").cast("string").alias("player_id"),
    )
    teams = customers.where("c_mktsegment <> 'FURNITURE'").select(
        team_code(F.col("c_custkey")).alias("code"), F.concat(F.lit(" "), "c_name").alias("name")
    )
    players = table(spark, folder, "supplier").select(
        F.col("s_suppkey").cast("string").alias("key"), F.col("s_suppkey").alias("id")
    )
    return enrich(fact, teams, players, MAIN).select("o_orderkey", "date", "home_abrev", "team", "is_home", "pid")


def _clock():
    quantity = F.col("l_quantity").cast("int").cast("string")
    seconds = F.lpad((F.col("l_linenumber") * 7).cast("string"), 2, "0")
    return (
        F.when(F.col("l_returnflag") == "R", "DNP").when(F.col("l_linestatus") == "O", F.concat(quantity, F.lit(":"), seconds))
        .otherwise(F.concat(quantity, F.lit(":"), seconds, F.lit(".5")))
    )


@query("""
SELECT l_orderkey, l_partkey, l_linenumber, l_quantity,
       round(CASE WHEN l_returnflag = 'R' THEN 0.0::DOUBLE
             ELSE (CAST(l_quantity AS INTEGER) * 60 + l_linenumber * 7) / 60.0::DOUBLE END, 6) AS minutes,
       abs(l_tax) < 0.0001 AS untaxed
FROM lineitem
""")
def minutes_parse(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", played_minutes(_clock()).alias("minutes"),
        is_zero(F.col("l_tax")).alias("untaxed"),
    )


@query("""
SELECT l_orderkey, round(sum(CAST(l_quantity AS INTEGER) * 60) / 60.0::DOUBLE, 6) AS minutes,
       sum(CAST(l_quantity AS INTEGER)) IN (240, 265, 290, 315, 340) AS complete
FROM lineitem GROUP BY l_orderkey
""")
def complete_games(spark, folder):
    clock = F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(":00"))
    fact = table(spark, folder, "lineitem").select("l_orderkey", clock.alias("mp"))
    return team_minutes(fact, MAIN, by=("l_orderkey",))


@query("""
SELECT * FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1
""")
def last_turns(spark, folder):
    return keep_last(table(spark, folder, "conversations"), ["conv_id"], [F.col("turn")])
