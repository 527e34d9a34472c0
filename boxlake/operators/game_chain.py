"""Previous and next game of a team within a season."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boxlake.functions.text import require
from boxlake.operators.tally import keep_last


def link_games(
    games: DataFrame,
    keys: tuple[str, ...] = ("team", "season"),
    date: str = "yyyymmdd",
    position: str = "file_pos",
) -> DataFrame:
    """Add ``prev_game_dt`` and ``next_game_dt``; games of one day follow each other by ``position``.

    The window runs over distinct game days, of which a season has at most 366, and not over rows:
    a team that holds a third of all rows is reduced before the shuffle. A row then takes the
    neighbouring day if it is the first (last) of its own day, else its own day again.
    Rows without a team or season are never linked.
    """
    keyed = games.where(" AND ".join(f"{k} IS NOT NULL" for k in keys))
    in_order = Window.partitionBy(*keys).orderBy(date)
    days = (
        keyed.groupBy(*keys, date)
        .agg(F.min(position).alias("_first"), F.max(position).alias("_last"))
        .withColumn("_before", F.lag(date).over(in_order))
        .withColumn("_after", F.lead(date).over(in_order))
    )
    linked = games.join(days, [*keys, date], "left")
    known = F.col("_first").isNotNull()
    previous = F.when(F.col(position) == F.col("_first"), F.col("_before")).otherwise(F.col(date))
    following = F.when(F.col(position) == F.col("_last"), F.col("_after")).otherwise(F.col(date))
    return linked.select(
        *games.columns,
        F.when(known, previous).alias("prev_game_dt"),
        F.when(known, following).alias("next_game_dt"),
    )


def neighbours_on(
    linked: DataFrame, wanted: DataFrame, season: str = "season", position: str = "file_pos", strict: bool = True
) -> DataFrame:
    """Look up (team, yyyymmdd) pairs. Of several games on a day the last row answers."""
    index = keep_last(
        linked.select("team", "yyyymmdd", season, position, "prev_game_dt", "next_game_dt"),
        ["team", "yyyymmdd"],
        [F.col(season), F.col(position)],
    ).select("team", "yyyymmdd", "prev_game_dt", "next_game_dt", F.lit(True).alias("_found"))
    answers = wanted.join(index, ["team", "yyyymmdd"], "left")
    if strict:
        missing = F.concat(F.lit("no game for "), F.col("team"), F.lit(" on "), F.col("yyyymmdd"))
        answers = answers.where(require(F.col("_found").isNotNull(), missing))
    return answers.drop("_found")
