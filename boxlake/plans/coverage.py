"""What is held for a league: games, play-by-play pages and the gaps between them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxlake.functions.links import PLAY_BY_PLAY, decode_file_name, play_by_play_of
from boxlake.functions.seasons import in_season
from boxlake.leagues import League
from boxlake.operators.pages import mark_play_by_play
from boxlake.operators.reconcile import game_summary, gap_rows, gap_summary
from boxlake.operators.tally import union_all


def _of_season(names: DataFrame, league: League, season: int | None, kind: str, year_filter: str) -> DataFrame:
    """Filter on the date in the file name, before any page content is read."""
    if season is None:
        return names
    date = decode_file_name(league, F.col("file_name"), kind)["date"]
    return names.where(in_season(league, date, season, year_filter))


def _sides(
    box_scores: DataFrame, pbp_pages: DataFrame, league: League, season: int | None, year_filter: str
) -> tuple[DataFrame, DataFrame]:
    games = _of_season(box_scores.select("file_name"), league, season, "box_score", year_filter)
    expected = games.select(play_by_play_of(league, F.col("file_name"), strict=True).alias("file_name"))
    held = _of_season(pbp_pages, league, season, PLAY_BY_PLAY, year_filter)
    return expected, mark_play_by_play(held).select("file_name", "valid")


def play_by_play_summary(
    box_scores: DataFrame, pbp_pages: DataFrame, league: League, season: int | None = None,
    year_filter: str = "calendar",
) -> DataFrame:
    return gap_summary(*_sides(box_scores, pbp_pages, league, season, year_filter))


def play_by_play_gaps(
    box_scores: DataFrame, pbp_pages: DataFrame, league: League, season: int | None = None,
    year_filter: str = "calendar",
) -> DataFrame:
    return gap_rows(*_sides(box_scores, pbp_pages, league, season, year_filter))


def coverage(
    fact: DataFrame | None, box_scores: DataFrame, pbp_pages: DataFrame, league: League,
    season: int | None = None, year_filter: str = "calendar",
) -> DataFrame:
    """One row: games in the fact with first, last and distinct dates, cached files, play-by-play counts.

    Without a fact only the cached-file and play-by-play counts are there.
    """
    reports = [
        box_scores.agg(F.count("*").alias("cached_box_scores")),
        play_by_play_summary(box_scores, pbp_pages, league, season, year_filter),
    ]
    if fact is not None:
        date = decode_file_name(league, F.col("file_name"), strict=True)["date"]
        names = _of_season(fact.select("file_name"), league, season, "box_score", year_filter)
        reports.insert(0, game_summary(names, "file_name", date))
    # one row each, folded into one without a join
    rows = union_all(*reports)
    return rows.agg(*[F.max(c).alias(c) for c in rows.columns]).select(
        F.lit(league.key).alias("league"), F.lit(season).cast("int").alias("season"), "*"
    )
