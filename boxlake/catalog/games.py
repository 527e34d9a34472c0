"""Schedules, seasons, links and coverage, on orders taken as games."""

from __future__ import annotations

from pyspark.sql import functions as F

from boxlake.catalog.registry import day, query, sql_code, sql_day, sql_file, table, team_code
from boxlake.functions.links import (
    PLAY_BY_PLAY,
    box_score_link,
    decode_file_name,
    file_name_of,
    is_box_score_link,
    is_valid_date,
    play_by_play_link,
    play_by_play_of,
)
from boxlake.functions.seasons import in_season, season_label, season_list
from boxlake.functions.text import extract
from boxlake.leagues import league
from boxlake.operators.game_chain import link_games, neighbours_on
from boxlake.operators.reconcile import game_summary, gap_rows, gap_summary
from boxlake.operators.tally import union_all
from boxlake.plans.coverage import coverage, play_by_play_gaps
from boxlake.plans.schedule import away_teams, games_by_home, prepare, records, resolve_home, scores
from boxlake.plans.status import schedule_targets

MAIN = league("nba")
OTHER = league("wnba")


def order_games(spark, folder):
    return table(spark, folder, "orders").select(
        F.col("o_custkey").alias("team"), F.year("o_orderdate").alias("season"),
        day("o_orderdate").alias("yyyymmdd"), F.col("o_orderkey").alias("file_pos"),
    )


_CHAIN = f"""
SELECT o_custkey AS team, CAST(year(o_orderdate) AS INTEGER) AS season, {sql_day('o_orderdate')} AS yyyymmdd,
       o_orderkey AS file_pos,
       lag({sql_day('o_orderdate')}) OVER w AS prev_game_dt,
       lead({sql_day('o_orderdate')}) OVER w AS next_game_dt
FROM orders
WINDOW w AS (PARTITION BY o_custkey, year(o_orderdate) ORDER BY {sql_day('o_orderdate')}, o_orderkey)
"""


@query(_CHAIN)
def prev_next_chain(spark, folder):
    return link_games(order_games(spark, folder))


@query(f"""
WITH chain AS ({_CHAIN}),
     last_row AS (
       SELECT team, yyyymmdd, prev_game_dt, next_game_dt FROM chain
       QUALIFY row_number() OVER (PARTITION BY team, yyyymmdd ORDER BY season DESC, file_pos DESC) = 1),
     wanted AS (
       SELECT DISTINCT o_custkey AS team, {sql_day('l_shipdate')} AS yyyymmdd
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT team, yyyymmdd, prev_game_dt, next_game_dt FROM wanted LEFT JOIN last_row USING (team, yyyymmdd)
""")
def game_neighbours(spark, folder):
    orders, lines = table(spark, folder, "orders"), table(spark, folder, "lineitem")
    wanted = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("team"), day("l_shipdate").alias("yyyymmdd")
    ).distinct()
    return neighbours_on(link_games(order_games(spark, folder)), wanted, strict=False)


@query("""
SELECT o_orderkey,
       CAST(CASE WHEN month(o_orderdate) >= 10 THEN year(o_orderdate) + 1 ELSE year(o_orderdate) END AS INTEGER) AS spanning,
       CAST(year(o_orderdate) AS INTEGER) AS single
FROM orders
""")
def season_labels(spark, folder):
    date = F.col("o_orderdate")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        season_label(date, MAIN.spans_years).alias("spanning"),
        season_label(date, OTHER.spans_years).alias("single"),
    )


@query("""
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS season FROM orders WHERE year(o_orderdate) IN (1995, 1996, 1997, 1999)
""")
def season_spec(spark, folder):
    wanted = season_list(spark, "1995-1997, 1999,", OTHER, "2026-10-20")
    games = table(spark, folder, "orders").select("o_orderkey", F.year("o_orderdate").alias("season"))
    return games.join(F.broadcast(wanted), "season", "left_semi").select("o_orderkey", "season")


def with_file_name(orders):
    code = team_code(F.col("o_custkey"))
    return orders.select(
        "*", F.concat(F.lit("boxscores_"), day("o_orderdate"), F.lit("0"), code, F.lit(".html")).alias("file_name")
    )


def order_files(spark, folder):
    return with_file_name(table(spark, folder, "orders"))


_FILES = f"""
SELECT *, {sql_day('o_orderdate')} AS game_day, {sql_code('o_custkey')} AS code,
       {sql_file(sql_day('o_orderdate'), sql_code('o_custkey'))} AS file_name
FROM orders
"""


@query(f"""
WITH files AS (SELECT DISTINCT file_name, game_day FROM ({_FILES}))
SELECT 'calendar' AS year_filter, count(*) AS games, min(game_day) AS first_game, max(game_day) AS last_game,
       count(DISTINCT game_day) AS distinct_game_dates
FROM files WHERE substr(game_day, 1, 4) IN ('1997', '1998')
UNION ALL
SELECT 'season', count(*), min(game_day), max(game_day), count(DISTINCT game_day)
FROM files WHERE game_day BETWEEN '19971001' AND '19980930'
""")
def season_year_filters(spark, folder):
    names = order_files(spark, folder)
    date = decode_file_name(MAIN, F.col("file_name"), strict=True)["date"]
    reports = [
        game_summary(names.where(in_season(MAIN, date, 1998, kind)), "file_name", date)
        .withColumn("year_filter", F.lit(kind))
        for kind in ("calendar", "season")
    ]
    return reports[0].unionByName(reports[1])


@query(f"""
SELECT o_orderkey, '/boxscores/' || game_day || '0' || code || '.html' AS link, file_name,
       game_day AS date, '0' AS game_no, code AS team, true AS is_link, false AS is_other_link, true AS date_ok,
       '/boxscores/pbp/' || game_day || '0' || code || '.html' AS pbp_link,
       'boxscores_pbp_' || game_day || '0' || code || '.html' AS pbp_file, code AS pbp_team,
       'wnba_boxscores_' || game_day || '0' || code || '.html' AS other_file
FROM ({_FILES})
""")
def link_round_trip(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey", day("o_orderdate").alias("d"), team_code(F.col("o_custkey")).alias("c")
    )
    links = orders.select(
        "o_orderkey", "d", box_score_link(MAIN, F.col("d"), F.col("c")).alias("link"),
        play_by_play_link(MAIN, F.col("d"), F.col("c")).alias("built_pbp"),
        file_name_of(box_score_link(OTHER, F.col("d"), F.col("c"))).alias("other_file"),
    ).withColumn("file_name", file_name_of(F.col("link")))
    decoded = links.withColumns({
        "g": decode_file_name(MAIN, F.col("file_name"), strict=True),
        "pbp_file": play_by_play_of(MAIN, F.col("file_name"), strict=True),
    })
    return decoded.select(
        "o_orderkey", "link", "file_name", "g.date", "g.game_no", "g.team",
        is_box_score_link(MAIN, F.col("link")).alias("is_link"),
        is_box_score_link(OTHER, F.col("link")).alias("is_other_link"),
        is_valid_date(F.col("d")).alias("date_ok"),
        F.when(play_by_play_of(MAIN, F.col("link")) == F.col("built_pbp"), F.col("built_pbp")).alias("pbp_link"),
        "pbp_file",
        decode_file_name(MAIN, F.col("pbp_file"), PLAY_BY_PLAY)["team"].alias("pbp_team"),
        "other_file",
    )


@query(r"""
SELECT page_id, nullif(regexp_extract(url, '^https?://[^/]+/([a-z]{2})/([0-9]+)', 1), '') AS lang,
       CAST(nullif(regexp_extract(url, '^https?://[^/]+/([a-z]{2})/([0-9]+)', 2), '') AS BIGINT) AS number
FROM pages
""")
def url_decode(spark, folder):
    pattern = r"^https?://[^/]+/([a-z]{2})/([0-9]+)"
    return table(spark, folder, "pages").select(
        "page_id", extract("url", pattern, 1).alias("lang"), extract("url", pattern, 2).cast("long").alias("number")
    )


@query(f"""
SELECT count(DISTINCT file_name) AS games, min(game_day) AS first_game, max(game_day) AS last_game,
       count(DISTINCT game_day) AS distinct_game_dates
FROM ({_FILES})
""")
def coverage_summary(spark, folder):
    date = decode_file_name(MAIN, F.col("file_name"), strict=True)["date"]
    return game_summary(order_files(spark, folder), "file_name", date)


def _documents_and_labels(spark, folder):
    expected = table(spark, folder, "documents").select("doc_id")
    cached = table(spark, folder, "labels").select("doc_id", (F.col("quality") == 1).alias("valid"))
    return expected, cached


@query("""
SELECT (SELECT count(DISTINCT doc_id) FROM documents) AS expected_games, count(*) AS cached_files,
       count(*) FILTER (quality = 1) AS valid_files, count(*) FILTER (quality <> 1) AS invalid_files,
       (SELECT count(*) FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels)) AS missing_files
FROM labels
""")
def coverage_gap(spark, folder):
    return gap_summary(*_documents_and_labels(spark, folder), name="doc_id")


@query("""
SELECT doc_id, 'missing' AS problem FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels)
UNION ALL SELECT doc_id, 'invalid' FROM labels WHERE quality <> 1
""")
def coverage_gap_rows(spark, folder):
    return gap_rows(*_documents_and_labels(spark, folder), name="doc_id")


def pbp_pages(spark, folder):
    """A play-by-play page per game with a finished or open order; only finished ones have the table."""
    games = order_files(spark, folder).where("o_orderstatus <> 'P'").groupBy("file_name").agg(
        F.max(F.col("o_orderstatus") == "F").alias("finished"), F.max("o_orderpriority").alias("note")
    )
    full = F.concat(F.lit('<table class="x" id="pbp"><tr><td>'), "note", F.lit("</td></tr></table>"))
    bare = F.concat(F.lit('<h2>Play-By-Play</h2><!-- <table id="pbp"> --><table id="other">'), "note")
    page = F.concat(F.lit("<html><body>"), F.when(F.col("finished"), full).otherwise(bare), F.lit("</body></html>"))
    return games.select(
        play_by_play_of(MAIN, F.col("file_name")).alias("file_name"), page.cast("binary").alias("content")
    )


_PBP = f"""
files AS ({_FILES}),
pbp AS (
  SELECT replace(file_name, 'boxscores_', 'boxscores_pbp_') AS file_name,
         max(CASE o_orderstatus WHEN 'F' THEN 1 ELSE 0 END) AS has_f
  FROM files WHERE o_orderstatus <> 'P' GROUP BY 1),
held AS (SELECT file_name, has_f = 1 AS valid FROM pbp),
wanted AS (SELECT DISTINCT replace(file_name, 'boxscores_', 'boxscores_pbp_') AS file_name FROM files)
"""


@query(f"""
WITH {_PBP}
SELECT 'nba' AS league, NULL::INTEGER AS season,
       (SELECT count(DISTINCT file_name) FROM files) AS games,
       (SELECT min(game_day) FROM files) AS first_game, (SELECT max(game_day) FROM files) AS last_game,
       (SELECT count(DISTINCT game_day) FROM files) AS distinct_game_dates,
       (SELECT count(DISTINCT file_name) FROM files) AS cached_box_scores,
       (SELECT count(*) FROM wanted) AS expected_games,
       count(*) AS cached_files, count(*) FILTER (valid) AS valid_files,
       count(*) FILTER (NOT valid) AS invalid_files,
       (SELECT count(*) FROM wanted WHERE file_name NOT IN (SELECT file_name FROM held)) AS missing_files
FROM held
""")
def league_coverage(spark, folder):
    files = order_files(spark, folder).select("file_name")
    return coverage(files, files.distinct(), pbp_pages(spark, folder), MAIN)


def _sql_season(day: str) -> str:
    return f"CAST(substr({day}, 1, 4) AS INTEGER) + CASE WHEN substr({day}, 5, 2) >= '10' THEN 1 ELSE 0 END"


@query(f"""
WITH {_PBP},
mine AS (SELECT * FROM files WHERE {_sql_season('game_day')} = 1995),
mine_wanted AS (SELECT * FROM wanted WHERE {_sql_season('substr(file_name, 15, 8)')} = 1995),
mine_held AS (SELECT * FROM held WHERE {_sql_season('substr(file_name, 15, 8)')} = 1995),
pages AS (
  SELECT (SELECT count(*) FROM mine_wanted) AS expected_games, count(*) AS cached_files, count(*) FILTER (valid) AS valid_files,
         count(*) FILTER (NOT valid) AS invalid_files,
         (SELECT count(*) FROM mine_wanted WHERE file_name NOT IN (SELECT file_name FROM mine_held)) AS missing_files FROM mine_held)
SELECT 'nba' AS league, 1995 AS season, (SELECT count(DISTINCT file_name) FROM mine) AS games, (SELECT min(game_day) FROM mine) AS first_game,
       (SELECT max(game_day) FROM mine) AS last_game, (SELECT count(DISTINCT game_day) FROM mine) AS distinct_game_dates,
       (SELECT count(DISTINCT file_name) FROM files) AS cached_box_scores, * FROM pages
UNION ALL
SELECT 'nba', 1995, NULL, NULL, NULL, NULL, (SELECT count(DISTINCT file_name) FROM files), * FROM pages
""")
def season_coverage(spark, folder):
    """One season of a league, with a fact and before there is one."""
    files = order_files(spark, folder).select("file_name")
    with_fact, without = (
        coverage(fact, files.distinct(), pbp_pages(spark, folder), MAIN, season=1995, year_filter="season") for fact in (files, None)
    )
    return union_all(with_fact, without)


@query("""
WITH last AS (SELECT max(o_orderdate) AS day FROM orders),
running AS (SELECT year(day) + CASE WHEN month(day) >= 10 THEN 1 ELSE 0 END AS spanning, year(day) AS single FROM last)
SELECT 'nba' AS league, o_orderkey FROM orders, running WHERE year(o_orderdate) + CASE WHEN month(o_orderdate) >= 10 THEN 1 ELSE 0 END = spanning
UNION ALL SELECT 'wnba', o_orderkey FROM orders, running WHERE year(o_orderdate) = single
""")
def season_in_progress(spark, folder):
    """Orders of the season that runs on the day of the last order, as no season is asked for."""
    orders = table(spark, folder, "orders")
    today, games = str(orders.agg(F.max(F.to_date("o_orderdate"))).first()[0]), []
    for lg in (MAIN, OTHER):
        dated = orders.select("o_orderkey", season_label(F.col("o_orderdate"), lg.spans_years).alias("season"))
        games.append(dated.join(F.broadcast(season_list(spark, None, lg, today)), "season", "left_semi").select(F.lit(lg.key).alias("league"), "o_orderkey"))
    return games[0].union(games[1])


@query(f"""
WITH {_PBP}
SELECT file_name, 'missing' AS problem FROM wanted WHERE file_name NOT IN (SELECT file_name FROM held)
UNION ALL SELECT file_name, 'invalid' FROM held WHERE NOT valid
""")
def play_by_play_gap_rows(spark, folder):
    return play_by_play_gaps(order_files(spark, folder), pbp_pages(spark, folder), MAIN)


# --- Two schedule rows per order: a customer at home, a nation away -----------------------

def order_schedule(spark, folder):
    """Both sides of every order as schedule rows. Names carry blanks, as they do on pages."""
    orders, customers, nations = (table(spark, folder, n) for n in ("orders", "customer", "nation"))
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )
    price = F.floor("o_totalprice").cast("int")
    home = F.struct(
        F.concat(F.lit("C"), "c_custkey").alias("team"), F.concat("n_name", F.lit("  ")).alias("opp_name"),
        F.lit(None).cast("string").alias("game_location"), price.alias("pts"), F.col("c_nationkey").alias("opp_pts"),
        (F.col("o_orderkey") * 2).alias("file_pos"),
    )
    away = F.struct(
        F.concat(F.lit("N"), "n_nationkey").alias("team"), F.concat(F.lit(" "), "c_name").alias("opp_name"),
        F.lit("@").alias("game_location"), F.col("c_nationkey").alias("pts"), price.alias("opp_pts"),
        (F.col("o_orderkey") * 2 + 1).alias("file_pos"),
    )
    return joined.select(
        F.year("o_orderdate").alias("season"), day("o_orderdate").alias("yyyymmdd"),
        F.col("o_orderstatus").alias("game_result"), F.col("c_custkey").cast("int").alias("wins"),
        F.col("n_regionkey").alias("losses"), F.inline(F.array(home, away)),
    )


def schedule_teams(spark, folder):
    customers, nations = table(spark, folder, "customer"), table(spark, folder, "nation")
    return customers.select(F.concat(F.lit("C"), "c_custkey").alias("code"), F.col("c_name").alias("name")).unionByName(
        nations.select(F.concat(F.lit("N"), "n_nationkey").alias("code"), F.col("n_name").alias("name"))
    )


_SIDES = f"""
pairs AS (
  SELECT 'C' || c_custkey AS home, 'N' || n_nationkey AS away, {sql_day('o_orderdate')} AS yyyymmdd,
         CAST(floor(o_totalprice) AS INTEGER) AS price, c_nationkey AS nation, o_orderkey,
         o_orderstatus AS game_result, CAST(c_custkey AS INTEGER) AS wins, n_regionkey AS losses,
         CAST(year(o_orderdate) AS INTEGER) AS season
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
sched AS (
  SELECT home AS team, away AS opp, home AS home_team, yyyymmdd, season, NULL AS game_location, price AS pts,
         nation AS opp_pts, o_orderkey * 2 AS file_pos, game_result, wins, losses FROM pairs
  UNION ALL
  SELECT away, home, home, yyyymmdd, season, '@', nation, price, o_orderkey * 2 + 1, game_result, wins, losses
  FROM pairs)
"""


@query(f"WITH {_SIDES} SELECT file_pos, team, opp, home_team, game_location FROM sched")
def home_side(spark, folder):
    resolved = resolve_home(order_schedule(spark, folder), schedule_teams(spark, folder))
    return resolved.select("file_pos", "team", "opp", "home_team", "game_location")


@query(f"""
WITH {_SIDES}
SELECT yyyymmdd AS date, home, away, game_result FROM pairs
""")
def games_by_date(spark, folder):
    return games_by_home(resolve_home(order_schedule(spark, folder), schedule_teams(spark, folder)))


@query(f"""
WITH {_SIDES}
SELECT team, season, yyyymmdd, file_pos, opp, home_team,
       lag(yyyymmdd) OVER w AS prev_game_dt, lead(yyyymmdd) OVER w AS next_game_dt
FROM sched WINDOW w AS (PARTITION BY team, season ORDER BY yyyymmdd, file_pos)
""")
def prepared_schedule(spark, folder):
    return prepare(order_schedule(spark, folder), schedule_teams(spark, folder)).select(
        "team", "season", "yyyymmdd", "file_pos", "opp", "home_team", "prev_game_dt", "next_game_dt"
    )


@query(f"""
WITH {_SIDES}, wanted AS (SELECT DISTINCT home_team, yyyymmdd FROM sched)
SELECT home_team, yyyymmdd, arg_min(opp, file_pos) AS away_team
FROM wanted JOIN sched USING (home_team, yyyymmdd) WHERE game_location IS NULL GROUP BY ALL
""")
def away_lookup(spark, folder):
    resolved = resolve_home(order_schedule(spark, folder), schedule_teams(spark, folder))
    return away_teams(resolved, resolved.select("home_team", "yyyymmdd"))


@query(f"""
WITH {_SIDES}
SELECT team, yyyymmdd, max(pts) AS pts, max(opp_pts) AS opp_pts FROM sched GROUP BY ALL HAVING count(*) = 1
""")
def game_scores(spark, folder):
    """Scores of all keys with exactly one game, which is what the lookup demands."""
    resolved = resolve_home(order_schedule(spark, folder), schedule_teams(spark, folder))
    single = resolved.groupBy("team", "yyyymmdd").agg(F.count("*").alias("n")).where("n = 1")
    return scores(resolved, single.select("team", "yyyymmdd"))


@query(f"""
WITH {_SIDES}
SELECT team, yyyymmdd, arg_min(wins, file_pos) AS wins, arg_min(losses, file_pos) AS losses FROM sched GROUP BY ALL
""")
def team_records(spark, folder):
    resolved = resolve_home(order_schedule(spark, folder), schedule_teams(spark, folder))
    return records(resolved, resolved.select("team", "yyyymmdd"))


@query("""
SELECT n_name AS team, season, '/wnba/teams/' || n_name || '/' || season || '_games.html' AS link
FROM nation, (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS season FROM orders)
""")
def season_targets(spark, folder):
    seasons = table(spark, folder, "orders").select(F.year("o_orderdate").alias("season")).distinct()
    teams = table(spark, folder, "nation").select(F.col("n_name").alias("code"))
    return schedule_targets(teams, seasons, OTHER)
