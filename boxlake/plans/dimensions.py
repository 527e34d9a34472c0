"""Team, player and official maps derived from the box-score fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxlake.functions.links import decode_file_name
from boxlake.functions.text import strip
from boxlake.leagues import League
from boxlake.operators.identity import SHARE, append_ids_first_seen, append_ids_sorted, crew_members
from boxlake.operators.tally import modal_value

PAGE_ORDER = ["file_name", "table_pos", "row_pos"]


def team_map(fact: DataFrame) -> DataFrame:
    """(code, name): the spelling used most often for each team code."""
    pairs = fact.where("team_code IS NOT NULL AND team IS NOT NULL").select(
        strip("team_code").alias("code"), strip("team").alias("name")
    )
    return modal_value(pairs, "code", "name").orderBy("code")


def team_map_from_file_names(fact: DataFrame, league: League) -> DataFrame:
    """The same for facts without team codes: rows of both sides count under the home code, and the
    home team wins because it recurs. A home code with no name at all fails the job."""
    home = decode_file_name(league, F.col("file_name"), strict=True)["team"]
    counts = fact.select(home.alias("code"), strip("team").alias("name")).groupBy("code", "name").agg(
        F.count("*").alias("_n")
    )
    best = F.min(F.when(F.col("name").isNotNull(), F.struct((-F.col("_n")).alias("rank"), "name")))
    nameless = F.raise_error(F.concat(F.lit("no team name for "), F.col("code"))).cast("string")
    return (
        counts.groupBy("code").agg(best.alias("_best"))
        .select("code", F.when(F.col("_best").isNull(), nameless).otherwise(F.col("_best.name")).alias("name"))
        .orderBy("code")
    )


def player_map(fact: DataFrame, known: DataFrame) -> DataFrame:
    """(key, id): known players keep their ids, new ones follow in order of first appearance."""
    return append_ids_first_seen(known, fact, "player_id", PAGE_ORDER)


def official_map(fact: DataFrame, known: DataFrame) -> DataFrame:
    """(key, id): known officials keep their ids, new ones follow in name order."""
    some = fact.sample(SHARE, seed=1)
    return append_ids_sorted(known, crew_members(fact, F.col("officials")), "member", crew_members(some, F.col("officials")))


def reverse_team_map(teams: DataFrame, position: Column | None = None) -> DataFrame:
    """(team_name, team): code by trimmed name; the last code wins where names repeat."""
    position = F.col("code") if position is None else position
    return teams.groupBy(strip("name").alias("team_name")).agg(F.max_by("code", position).alias("team"))
