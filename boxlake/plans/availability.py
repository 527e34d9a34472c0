"""Availability from game-summary JSON."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxlake.operators.json_tree import availability_records, first_records, path_census


class Availability(NamedTuple):
    records: DataFrame
    paths: DataFrame
    diagnostics: DataFrame


def season_availability(games: DataFrame, docs: DataFrame) -> Availability:
    """Records, path census and counts over the summaries of a season's scheduled games.

    ``games`` has (game_id, game_date, ...), ``docs`` (doc_id, doc) with doc_id = game_id.
    """
    scheduled = docs.withColumnRenamed("doc_id", "game_id").join(games.select("game_id", "game_date"), "game_id")
    records = availability_records(scheduled)
    return Availability(records, path_census(scheduled), diagnostics(games, records))


def diagnostics(games: DataFrame, records: DataFrame) -> DataFrame:
    """Scheduled games, games with at least one record, and records."""
    per_game = records.groupBy("game_id").agg(F.count("*").alias("n"))
    return per_game.agg(
        F.count("*").alias("games_with_records"), F.coalesce(F.sum("n"), F.lit(0)).alias("records")
    ).withColumn("scheduled_games", games.select(F.count("*")).scalar())


def example_records(docs: DataFrame, k: int = 5) -> DataFrame:
    """The first records by game and place in the document; ``docs`` has (game_id, game_date, doc, text)."""
    return first_records(docs, k)
