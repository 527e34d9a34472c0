"""Sources and sinks: tables written to the shared folder in each format and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from boxlake.catalog import ids  # noqa: F401  its SQL is used again here
from boxlake.catalog.absences import archive
from boxlake.catalog.games import MAIN, OTHER, _FILES, order_files
from boxlake.catalog.pages import _BROKEN, box_score_pages
from boxlake.catalog.registry import ORACLES, day, query, sql_code, sql_day, table, team_code
from boxlake.catalog.trees import _RECORDS, summaries
from boxlake.fixed_values import ABSENCE_COLUMNS, AVAILABILITY_COLUMNS
from boxlake.functions.links import BOX_SCORE, PLAY_BY_PLAY
from boxlake.operators.json_tree import availability_records
from boxlake.plans.absences import absence_table
from boxlake.plans.artifacts import build_artifacts
from boxlake.plans.box_scores import game_rows
from boxlake.plans.dimensions import team_map_from_file_names
from boxlake.session import shared_dir
from boxlake.sources.dimensions import export_json_map, read_json_map, read_version, write_version
from boxlake.sources.facts import (
    export_absences_csv,
    export_availability_csv,
    export_box_scores_csv,
    export_csv,
    read_box_scores_csv,
    read_csv_texts,
    read_schedule_csv,
)
from boxlake.sources.json_docs import parse_docs
from boxlake.sources.raw_pages import compact_raw_pages


def _new_folder(spark, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query(f"""
SELECT {sql_code('o_custkey')} AS team, CAST(year(o_orderdate) AS INTEGER) AS season, {sql_day('o_orderdate')} AS yyyymmdd,
       'Club, "' || o_orderpriority || '"' AS opp_name, CASE o_orderstatus WHEN 'F' THEN '@' END AS game_location,
       CASE o_orderstatus WHEN 'O' THEN 'W' WHEN 'F' THEN 'L' END AS game_result,
       CASE WHEN o_orderstatus <> 'P' THEN CAST(floor(o_totalprice / 1000) AS INTEGER) END AS pts,
       CAST(o_orderkey % 150 AS INTEGER) AS opp_pts
FROM orders
""")
def schedule_csv_games(spark, folder):
    """A schedule file whose columns stand in another order, among columns it need not have."""
    orders, path = table(spark, folder, "orders"), _new_folder(spark, "schedule")
    status = F.col("o_orderstatus")
    export_csv(orders.select(
        (F.col("o_orderkey") % 150).alias("opp_pts"), F.lit("x").alias("note"),
        F.concat(F.lit('Club, "'), "o_orderpriority", F.lit('"')).alias("opp_name"), day("o_orderdate").alias("yyyymmdd"),
        F.when(status != "P", F.floor(F.col("o_totalprice") / 1000)).alias("pts"), F.lit(1).alias("losses"),
        F.when(status == "F", "@").alias("game_location"), team_code(F.col("o_custkey")).alias("team"),
        F.when(status == "O", "W").when(status == "F", "L").alias("game_result"), F.lit(2).alias("wins"),
        F.year("o_orderdate").alias("season"),
    ), path)
    return read_schedule_csv(spark, path, MAIN).drop("league", "wins", "losses", "file_pos")


@query(f"""
SELECT 'Player "' || o_custkey || '"' AS player, CASE WHEN o_orderstatus <> 'P' THEN 'c' || o_custkey END AS player_id,
       o_orderkey % 48 || ':07' AS mp, CASE o_orderstatus WHEN 'F' THEN 'DNP' ELSE '12' END AS pts, 'NA' AS team,
       code AS team_code, 'FG' AS period, 'Ann|' || o_orderpriority AS officials, file_name
FROM ({_FILES})
""")
def fact_csv_round_trip(spark, folder):
    status = F.col("o_orderstatus")
    fact = order_files(spark, folder).select(
        "file_name", F.lit(0).alias("table_pos"), F.lit(0).alias("row_pos"),
        F.concat(F.lit('Player "'), F.col("o_custkey").cast("string"), F.lit('"')).alias("player"),
        F.when(status != "P", F.concat(F.lit("c"), F.col("o_custkey").cast("string"))).alias("player_id"),
        F.concat((F.col("o_orderkey") % 48).cast("string"), F.lit(":07")).alias("mp"),
        F.when(status == "F", "DNP").otherwise("12").alias("pts"), F.lit("NA").alias("team"),
        team_code(F.col("o_custkey")).alias("team_code"), F.lit("FG").alias("period"),
        F.array(F.lit("Ann"), "o_orderpriority").alias("officials"),
    )
    path = _new_folder(spark, "agg")
    export_box_scores_csv(fact, path)
    names = ["player", "player_id", "mp", "pts", "team", "team_code", "period", "officials", "file_name"]
    return read_box_scores_csv(spark, path).toDF(*names)


@query(ORACLES["team_codes_from_files"])
def legacy_fact_team_map(spark, folder):
    """The team map of a fact file from before there were team codes: its seven columns have no code and no player id."""
    file_name = F.concat(F.lit("boxscores_199501010"), team_code(F.col("o_orderkey")), F.lit(".html"))
    named = F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("Status "), "o_orderstatus"))
    path = _new_folder(spark, "legacy")
    export_csv(table(spark, folder, "orders").select(
        F.lit("A").alias("Player"), F.lit("1:00").alias("MP"), F.lit("2").alias("PTS"),
        F.explode(F.array(named, F.lit("Status F"))).alias("Team"), F.lit("FG").alias("Period"),
        F.lit("Ann|Zed").alias("Officials"), file_name.alias("filename"),
    ), path)
    fact = read_box_scores_csv(spark, path, ["Team", "filename"]).toDF("team", "file_name")
    return team_map_from_file_names(fact, MAIN)


@query("""
SELECT CASE o_orderstatus WHEN 'F' THEN 'wnba' ELSE 'nba' END AS league, kind, CAST(year(o_orderdate) AS INTEGER) AS year,
       count(*) AS pages, CAST(sum(length(o_orderpriority) + extra) AS BIGINT) AS bytes
FROM orders, (VALUES ('box_score', 0), ('play_by_play', 3)) AS k(kind, extra) GROUP BY ALL
""")
def compacted_pages(spark, folder):
    """Pages of two leagues and two kinds compacted one after the other into one table, those of one league twice."""
    path, orders = _new_folder(spark, "compacted"), table(spark, folder, "orders")
    for lg, prefix, mine in ((MAIN, "", "o_orderstatus <> 'F'"), (OTHER, "wnba_", "o_orderstatus = 'F'")):
        for kind, infix, extra in ((BOX_SCORE, "", ""), (PLAY_BY_PLAY, "pbp_", "pbp")):
            code, content = team_code(F.col("o_custkey")), F.concat("o_orderpriority", F.lit(extra))
            pages = orders.where(mine).select(
                F.lit(lg.key).alias("league"),
                F.concat(F.lit(f"{prefix}boxscores_{infix}"), day("o_orderdate"), F.lit("0"), code, F.lit(".html")).alias("file_name"),
                F.encode(content, "UTF-8").alias("content"), F.length(content).cast("long").alias("length"),
            )
            for _ in range(1 if lg is MAIN else 2):
                compact_raw_pages(pages, path, lg, kind)
    kept = spark.read.parquet(path)
    return kept.groupBy("league", "kind", F.col("year").cast("int").alias("year")).agg(
        F.count("*").alias("pages"), F.sum(F.octet_length("content")).cast("long").alias("bytes")
    )


@query("""
SELECT 'c"' || o_custkey || ', ' || o_orderkey AS key, o_orderkey AS id FROM orders
""")
def id_map_round_trip(spark, folder):
    """A map written as a version, exported as a JSON object and read again."""
    key = F.concat(F.lit('c"'), F.col("o_custkey").cast("string"), F.lit(", "), F.col("o_orderkey").cast("string"))
    root = _new_folder(spark, "map")
    write_version(table(spark, folder, "orders").select(key.alias("key"), F.col("o_orderkey").cast("long").alias("id")), root, 3)
    export_json_map(read_version(spark, root, 3), f"{root}/json")
    return read_json_map(spark, f"{root}/json").select("key", "id")


@query(f"""
WITH good AS (SELECT * FROM ({_FILES}) WHERE NOT {_BROKEN}),
counts AS (
  SELECT 'agg' AS artifact, 2 * count(*) + count(*) FILTER (o_orderstatus = 'P') AS rows_out FROM good
  UNION ALL SELECT 'team_map', count(DISTINCT code) FROM good
  UNION ALL SELECT 'official_map', count(DISTINCT name) FROM (SELECT unnest([o_orderpriority, o_orderstatus]) AS name FROM good)
  UNION ALL SELECT 'player_map', count(DISTINCT o_custkey) + count(DISTINCT o_orderkey)
                                 + CAST(bool_or(o_orderstatus = 'P') AS INTEGER) FROM good)
SELECT artifact, CAST(rows_out AS BIGINT) AS rows_out, (SELECT count(*) FROM orders) AS source_files FROM counts
""")
def built_artifacts(spark, folder):
    """A full build over pages of which some cannot be read."""
    pages = box_score_pages(spark, folder, broken=True)
    return build_artifacts(spark, pages, _new_folder(spark, "build"), MAIN, mode="quarantine").drop("duration_s")


@query(f"""
SELECT o_orderkey, code AS team, game_day AS date, o_custkey FROM ({_FILES})
WHERE (code, game_day) = (SELECT (code, game_day) FROM ({_FILES}) ORDER BY o_orderkey LIMIT 1)
""")
def one_game_rows(spark, folder):
    """The rows of the game of the first order."""
    fact = table(spark, folder, "orders").select(
        "o_orderkey", team_code(F.col("o_custkey")).alias("team"), day("o_orderdate").alias("date"), "o_custkey"
    )
    game = fact.agg(F.min_by(F.struct("team", "date"), "o_orderkey").alias("game")).first().game
    return game_rows(fact, game.team, game.date)


@query(ORACLES["absence_report"].replace("game_date AS date", "CAST(game_date AS VARCHAR) AS date"))
def absence_csv_round_trip(spark, folder):
    """The exchange file of absences, its columns read back by name."""
    path = _new_folder(spark, "absences")
    export_absences_csv(absence_table(archive(spark, folder)), path)
    return read_csv_texts(spark, path, ABSENCE_COLUMNS)


@query(_RECORDS)
def availability_csv_round_trip(spark, folder):
    path = _new_folder(spark, "availability")
    export_availability_csv(availability_records(parse_docs(summaries(spark, folder))), path)
    return read_csv_texts(spark, path, AVAILABILITY_COLUMNS)
