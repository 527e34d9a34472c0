"""Expected against cached: missing, invalid, stale and due-for-refresh files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxlake.fixed_values import SCHEDULE_MAX_AGE_SECONDS


def missing_names(expected: DataFrame, cached: DataFrame, name: str = "file_name") -> DataFrame:
    return expected.select(name).distinct().join(cached.select(name), name, "left_anti")


def gap_rows(expected: DataFrame, cached: DataFrame, name: str = "file_name") -> DataFrame:
    """(name, problem): one row per missing expected file and per invalid cached file, sorted.

    The lists stay rows, so they may be of any length. ``cached`` carries a ``valid`` flag.
    """
    missing = missing_names(expected, cached, name).withColumn("problem", F.lit("missing"))
    invalid = cached.where("NOT valid").select(name, F.lit("invalid").alias("problem"))
    return missing.unionByName(invalid).orderBy("problem", name)


def gap_summary(expected: DataFrame, cached: DataFrame, name: str = "file_name") -> DataFrame:
    """One row of counts. Validity counts every cached file, expected or not."""
    wanted = expected.select(name).distinct()
    missing = missing_names(expected, cached, name)
    held = cached.agg(
        F.count("*").alias("cached_files"),
        F.count_if("valid").alias("valid_files"),
        F.count_if(~F.col("valid")).alias("invalid_files"),
    )
    return held.select(
        wanted.agg(F.count("*")).scalar().alias("expected_games"),
        "cached_files",
        "valid_files",
        "invalid_files",
        missing.agg(F.count("*")).scalar().alias("missing_files"),
    )


def game_summary(names: DataFrame, name: str, date: Column) -> DataFrame:
    """games, first_game, last_game, distinct_game_dates over distinct file names.

    Counted in steps - names, then days - so that no distinct set is built in one task.
    """
    games = names.select(name).distinct()
    days = games.groupBy(date.alias("_day")).agg(F.count("*").alias("_games"))
    return days.agg(
        F.coalesce(F.sum("_games"), F.lit(0)).alias("games"),
        F.min("_day").alias("first_game"),
        F.max("_day").alias("last_game"),
        F.count("_day").alias("distinct_game_dates"),
    )


def refresh_list(
    expected: DataFrame,
    inventory: DataFrame,
    now: Column,
    current_season: Column,
    max_age_seconds: int = SCHEDULE_MAX_AGE_SECONDS,
    name: str = "file_name",
) -> DataFrame:
    """Expected files that must be fetched: not held, or a schedule page of the running season too old.

    ``expected`` has (name, kind, season), ``inventory`` (name, modification_time). Finished seasons
    and game pages never expire.
    """
    newest = inventory.groupBy(name).agg(F.max("modification_time").alias("_mtime"))
    age = F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("_mtime").cast("timestamp"))
    mutable = (F.col("kind") == "schedule") & (F.col("season") == current_season)
    joined = expected.join(newest, name, "left")
    return joined.select(
        *expected.columns,
        F.when(F.col("_mtime").isNull(), "missing")
        .when(mutable & (age > F.lit(max_age_seconds).cast("long") * 1_000_000), "expired")
        .alias("cause"),
    ).where("cause IS NOT NULL")


def is_stale(newest: Column, last_run: Column) -> Column:
    """Whether something was cached after the last run; false if either is unknown."""
    return F.coalesce(newest > last_run, F.lit(False))
