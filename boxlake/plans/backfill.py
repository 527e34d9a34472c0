"""What still has to be fetched: target pages against the files already held."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxlake.fixed_values import SCHEDULE_MAX_AGE_SECONDS
from boxlake.functions.links import decode_file_name, file_name_of, play_by_play_of
from boxlake.functions.seasons import season_label
from boxlake.leagues import League
from boxlake.operators.reconcile import refresh_list


def expected_pages(targets: DataFrame, box_links: DataFrame, league: League) -> DataFrame:
    """(link, file_name, kind, season) of the schedule pages in ``targets`` (link, season), of the
    box scores in ``box_links`` (link), and of their play-by-play pages."""
    schedules = targets.select("link", file_name_of(F.col("link")).alias("file_name"), F.lit("schedule").alias("kind"), "season")
    games = box_links.select("link").distinct().withColumn("box", file_name_of(F.col("link")))
    played = F.to_date(decode_file_name(league, F.col("box"), strict=True)["date"], "yyyyMMdd")
    pairs = F.array(
        F.struct("link", F.col("box").alias("file_name"), F.lit("box_score").alias("kind")),
        F.struct(
            play_by_play_of(league, F.col("link")).alias("link"),
            play_by_play_of(league, F.col("box")).alias("file_name"), F.lit("play_by_play").alias("kind"),
        ),
    )
    pages = games.select(F.inline(pairs), season_label(played, league.spans_years).alias("season"))
    return schedules.unionByName(pages)


def pages_to_fetch(
    expected: DataFrame, inventory: DataFrame, now: Column, current_season: Column,
    max_age_seconds: int = SCHEDULE_MAX_AGE_SECONDS,
) -> DataFrame:
    """Expected pages that are missing, or are schedule pages of the running season grown too old."""
    return refresh_list(expected, inventory, now, current_season, max_age_seconds)


def pull_counts(expected: DataFrame, due: DataFrame) -> DataFrame:
    """Per kind: pages expected, pages to fetch, pages already held."""
    wanted = expected.groupBy("kind").agg(F.count("*").alias("expected"))
    missing = due.groupBy("kind").agg(F.count("*").alias("due"))
    due_count = F.coalesce("due", F.lit(0))
    return wanted.join(missing, "kind", "left").select(
        "kind", "expected", due_count.alias("due"), (F.col("expected") - due_count).alias("held")
    )
