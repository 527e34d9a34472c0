"""Full build: pages to fact, fact to the three maps."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxlake.leagues import League
from boxlake.operators.pages import extract_box_scores
from boxlake.plans.dimensions import official_map, player_map, team_map
from boxlake.sources.dimensions import read_version, write_version
from boxlake.sources.facts import read_box_scores, write_box_scores

SUMMARY = "artifact string, rows_out long, source_files long, duration_s double"


def build_artifacts(
    spark: SparkSession, pages: DataFrame, root: str, league: League,
    version: int = 0, known: int | None = None, mode: str = "strict", layout: str = "id",
) -> DataFrame:
    """Write ``root/fact`` and the team, official and player maps as ``version``; return row counts and seconds.

    Ids continue from the maps of version ``known``. Pages are parsed once, and the maps read the
    written fact, each only the columns it needs. Counts are taken from what was written. Nothing is
    written when there are no pages. In "quarantine" mode unreadable pages go to ``root/errors``.
    """
    started = time.monotonic()
    source_files = pages.select("file_name").count()
    if source_files == 0:
        return spark.createDataFrame([("agg", 0, 0, time.monotonic() - started)], SUMMARY)

    fact_path = f"{root}/fact"
    if mode == "quarantine":
        staged = f"{root}/staged"
        extract_box_scores(pages, layout, mode).write.mode("overwrite").parquet(staged)
        parsed = spark.read.parquet(staged)
        parsed.where("error IS NOT NULL").select("league", "file_name", "error").write.mode("overwrite").parquet(
            f"{root}/errors"
        )
        write_box_scores(parsed.where("error IS NULL").drop("error"), fact_path, league)
    else:
        write_box_scores(extract_box_scores(pages, layout, mode), fact_path, league)

    fact = read_box_scores(spark, fact_path)
    counts = [("agg", fact.count(), source_files, time.monotonic() - started)]
    if counts[0][1]:
        maps = {
            "team_map": team_map(fact),
            "official_map": official_map(fact, read_version(spark, f"{root}/official_map", known)),
            "player_map": player_map(fact, read_version(spark, f"{root}/player_map", known)),
        }
        for name, table in maps.items():
            started = time.monotonic()
            write_version(table, f"{root}/{name}", version)
            rows = spark.read.parquet(f"{root}/{name}/version={version}").count()
            counts.append((name, rows, source_files, time.monotonic() - started))
    return spark.createDataFrame(counts, SUMMARY)


def artifact_log(summary: DataFrame, league: League) -> DataFrame:
    """The counts and durations of a build as rows of the artifact log."""
    return summary.select(
        F.lit(league.key).alias("league"), "artifact", F.current_timestamp().alias("ts"),
        F.lit(0).cast("long").alias("seq"), "duration_s",
        "rows_out", "source_files",
    )
