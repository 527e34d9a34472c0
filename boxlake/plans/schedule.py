"""Questions about the schedule, asked for whole tables of (team, date) keys at once.

Every game has two schedule rows, one per team; ``game_location`` is null at home and "@" away.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxlake.functions.text import require
from boxlake.operators.game_chain import link_games
from boxlake.operators.tally import keep_last
from boxlake.plans.box_scores import attach_team


def resolve_home(games: DataFrame, teams: DataFrame) -> DataFrame:
    """Add ``opp``, the opponent's code, and ``home_team``."""
    coded = attach_team(games, teams, "opp_name", "opp")
    return coded.withColumn(
        "home_team", F.when(F.col("game_location") == "@", F.col("opp")).otherwise(F.col("team"))
    )


def prepare(games: DataFrame, teams: DataFrame) -> DataFrame:
    return resolve_home(link_games(games), teams)


def games_by_home(resolved: DataFrame) -> DataFrame:
    """Each game once, from its home row: (date, home, away, game_result)."""
    return resolved.where("game_location IS NULL").select(
        F.col("yyyymmdd").alias("date"), F.col("home_team").alias("home"), F.col("opp").alias("away"), "game_result"
    )


def games_on(resolved: DataFrame, date: str) -> DataFrame:
    return games_by_home(resolved.where(F.col("yyyymmdd") == date))


def scores(resolved: DataFrame, wanted: DataFrame) -> DataFrame:
    """Points of (team, yyyymmdd) keys. A key with no game or several fails the job; a game not played yet has none."""
    games = resolved.groupBy("team", "yyyymmdd").agg(
        F.count("*").alias("_games"), F.max("pts").alias("pts"), F.max("opp_pts").alias("opp_pts")
    )
    picked = wanted.distinct().join(games, ["team", "yyyymmdd"], "left")
    message = F.concat(F.lit("not exactly one game for "), F.col("team"), F.lit(" on "), F.col("yyyymmdd"))
    return picked.where(require(F.coalesce(F.col("_games") == 1, F.lit(False)), message)).select(
        "team", "yyyymmdd", "pts", "opp_pts"
    )


def away_teams(resolved: DataFrame, wanted: DataFrame) -> DataFrame:
    """Opponent of (home_team, yyyymmdd) keys. Only home rows count, whichever code sorts first."""
    home_rows = resolved.where("game_location IS NULL").select("home_team", "yyyymmdd", "file_pos", "opp")
    first = home_rows.groupBy("home_team", "yyyymmdd").agg(F.min_by("opp", "file_pos").alias("away_team"))
    return wanted.distinct().join(first, ["home_team", "yyyymmdd"], "left")


def records(resolved: DataFrame, wanted: DataFrame) -> DataFrame:
    """Wins and losses of (team, yyyymmdd) keys, from the first row of the day."""
    first = keep_last(
        resolved.select("team", "yyyymmdd", "file_pos", "wins", "losses"), ["team", "yyyymmdd"], [-F.col("file_pos")]
    )
    return wanted.distinct().join(first.drop("file_pos"), ["team", "yyyymmdd"], "left")
