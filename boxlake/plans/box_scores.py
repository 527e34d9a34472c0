"""The box-score fact as a model reads it: team codes, dates, home flags and dense player ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxlake.fixed_values import EXPECTED_PLAYERS
from boxlake.functions.links import decode_file_name
from boxlake.functions.minutes import is_complete_game, played_seconds
from boxlake.functions.text import strip
from boxlake.leagues import League
from boxlake.operators.identity import check_size
from boxlake.plans.dimensions import reverse_team_map


def attach_team(rows: DataFrame, teams: DataFrame, name: str, code: str = "team") -> DataFrame:
    """Add the team code of a name column. Both sides are trimmed; an unknown name gives null.

    The optimizer broadcasts the map if it is small when it runs, and else joins by shuffle with
    skewed keys split.
    """
    names = reverse_team_map(teams).withColumnRenamed("team", code)
    return rows.withColumn("team_name", strip(name)).join(names, "team_name", "left").drop("team_name")


def attach_player(rows: DataFrame, players: DataFrame, player: str = "player_id") -> DataFrame:
    """Add the dense ``pid`` of a player; null for players the map lacks."""
    return rows.join(players.select(F.col("key").alias(player), F.col("id").alias("pid")), player, "left")


def check_players(players: DataFrame, league: League) -> int:
    """Fail if the player map of a league with a pinned size has changed: trained models index by it."""
    expected = EXPECTED_PLAYERS.get(league.key)
    return players.count() if expected is None else check_size(players, expected, f"{league.key} player map")


def enrich(fact: DataFrame, teams: DataFrame, players: DataFrame, league: League) -> DataFrame:
    """Add team, date, home_abrev, is_home and pid; the page's own team name becomes team_ln."""
    named = fact.withColumnRenamed("team", "team_ln")
    game = decode_file_name(league, F.col("file_name"), strict=True)
    placed = attach_team(named, teams, "team_ln").withColumn("_game", game).select(
        "*", F.col("_game.date").alias("date"), F.col("_game.team").alias("home_abrev")
    ).drop("_game")
    home = F.coalesce(F.col("home_abrev") == F.col("team"), F.lit(False))
    return attach_player(placed.withColumn("is_home", home), players)


def game_rows(enriched: DataFrame, team: str, date: str) -> DataFrame:
    """Player rows of one team on one date. Unknown team, empty date and no such game are told apart."""
    if not (len(date) == 8 and date.isdigit()):
        raise ValueError(f"not a YYYYMMDD date: {date}")
    of_team, on_date = F.col("team") == team, F.col("date") == date
    seen = enriched.where(of_team | on_date).agg(
        F.max(of_team).alias("team"), F.max(on_date).alias("date"), F.max(of_team & on_date).alias("game")
    ).first()
    if not seen.team:
        raise LookupError(f"unknown team {team}")
    if not seen.date:
        raise LookupError(f"no game on {date}")
    if not seen.game:
        raise LookupError(f"no game for {team} on {date}")
    return enriched.where(of_team & on_date)


def team_minutes(fact: DataFrame, league: League, by: tuple[str, ...] = ("file_name", "team_code")) -> DataFrame:
    """Player-minutes per team and game, with the complete-game flag. Whole seconds are summed, so the
    total does not depend on the order of rows."""
    totals = F.array(*[F.lit(n) for n in league.full_game_totals])
    summed = fact.groupBy(*by).agg(F.sum(played_seconds(F.col("mp"))).alias("_seconds"))
    minutes = summed.withColumn("minutes", F.round(F.col("_seconds") / 60.0, 6))
    return minutes.withColumn("complete", is_complete_game(F.col("minutes"), totals)).drop("_seconds")
