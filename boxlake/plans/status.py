"""State of pulls and artifacts, folded from append-only logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxlake.functions.links import schedule_link
from boxlake.leagues import League, league_frame
from boxlake.operators.reconcile import is_stale
from boxlake.operators.tally import keep_last, latest_fields

PULL_FIELDS = ["last_started", "last_finished", "last_error", "files_new", "files_cached"]


def fold_pulls(log: DataFrame, by: tuple[str, ...] = ("league", "dataset")) -> DataFrame:
    """Current state per league and dataset. Each field keeps its own newest value: a start clears
    the error, and a failure does not erase the counts of the last good pull."""
    event, stamp = F.col("event"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    fields = log.select(
        *by, "ts", "seq",
        F.when(event == "started", stamp).alias("last_started"),
        F.when(event == "finished", stamp).alias("last_finished"),
        F.when(event == "started", "").when(event == "failed", F.concat(stamp, F.lit(" "), "error"))
        .alias("last_error"),
        F.when(event == "finished", F.col("files_new")).alias("files_new"),
        F.when(event == "finished", F.col("files_cached")).alias("files_cached"),
    )
    return latest_fields(fields, list(by), ["ts", "seq"], PULL_FIELDS)


def fold_artifacts(log: DataFrame) -> DataFrame:
    """Last run of every artifact."""
    last = keep_last(log, ["league", "artifact"], [F.col("ts"), F.col("seq")])
    return last.withColumnRenamed("ts", "last_run").drop("seq")


def freshness(newest: DataFrame, runs: DataFrame) -> DataFrame:
    """Per league: newest raw file, last run, and whether the fact lags behind the files."""
    return newest.join(runs, "league", "full_outer").select(
        "league", "newest_raw_file", "last_run",
        is_stale(F.col("newest_raw_file"), F.col("last_run")).alias("stale"),
    )


def status(spark: SparkSession, pulls: DataFrame, artifacts: DataFrame, newest: DataFrame) -> DataFrame:
    """One row per league and pulled dataset or artifact, with the league's settings and freshness."""
    states = fold_pulls(pulls).select(
        "league", F.lit("pull").alias("section"), F.col("dataset").alias("name"), *PULL_FIELDS
    ).unionByName(
        fold_artifacts(artifacts).select("league", F.lit("artifact").alias("section"), F.col("artifact").alias("name"),
                                         "last_run", "duration_s", "rows_out", "source_files"),
        allowMissingColumns=True,
    )
    runs = fold_artifacts(artifacts).where("artifact = 'agg'").select("league", "last_run")
    fresh = freshness(newest, runs).select("league", "newest_raw_file", "stale")
    settings = league_frame(spark).select("league", "display_name", "prefix", "regulation_minutes", "spans_years")
    return (
        settings.join(states, "league", "left").join(fresh, "league", "left")
        .orderBy("league", "section", "name")
    )


def pull_totals(log: DataFrame, by: tuple[str, ...] = ("league", "season")) -> DataFrame:
    """New, cached and failed files summed over the pulls of a pass."""
    return log.groupBy(*by).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("new", "cached", "failed")]
    )


def schedule_targets(teams: DataFrame, seasons: DataFrame, league: League) -> DataFrame:
    """Schedule pages to hold: every team code for every season.

    Seasons are a short list of years; they travel to the teams as one array, not as a join.
    """
    years = seasons.agg(F.sort_array(F.collect_set("season"))).scalar()
    pages = teams.select("code").distinct().select("code", F.explode(years).alias("season"))
    return pages.select(
        F.col("code").alias("team"), "season", schedule_link(league, F.col("code"), F.col("season")).alias("link")
    )


def target_teams(spark: SparkSession, league: League, team_map: DataFrame) -> DataFrame:
    """Configured team codes, or those of the team map where none are configured."""
    if league.teams:
        return spark.createDataFrame([(t,) for t in league.teams], "code string")
    return team_map.select("code").distinct().orderBy("code")
