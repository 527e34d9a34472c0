"""Why players did not play: from season files to classified absences and their reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from boxlake.fixed_values import ABSENCE_COLUMNS, UNKNOWN
from boxlake.functions.absence import classify
from boxlake.operators.tally import top_values
from boxlake.sources.season_archive import read_season_files, reindex


def normalize(frame: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The availability columns, with ``reason`` kept only where the player did not play."""
    return blank_reasons(reindex(frame, keep=keep))


def blank_reasons(frame: DataFrame, flag: str = "did_not_play", reason: str = "reason") -> DataFrame:
    missed = F.coalesce(F.col(flag), F.lit(False))
    return frame.withColumns({flag: missed, reason: F.when(missed, F.col(reason))})


def read_archive(spark: SparkSession, folder: str, start: int | None = None, end: int | None = None) -> DataFrame:
    return normalize(read_season_files(spark, folder, start, end), keep=("source_file",))


def with_classes(rows: DataFrame, text: str) -> DataFrame:
    """Add ``status`` and ``category`` of a text column; every row runs through the rules."""
    return _split_class(rows.withColumn("_class", classify(F.col(text))))


def _split_class(rows: DataFrame) -> DataFrame:
    return rows.select(
        "*", F.col("_class.status").alias("status"), F.col("_class.reason").alias("category")
    ).drop("_class")


def absence_table(archive: DataFrame) -> DataFrame:
    """Did-not-play rows in the exchange shape. The flag filter reaches the Parquet scan."""
    missed = archive.where("did_not_play").select(
        F.col("athlete_display_name").alias("player_name"), F.col("athlete_id").alias("player_id"),
        F.col("game_date").alias("date"), F.col("reason").alias("value"), "source_file",
    )
    classed = with_classes(missed, "value").withColumnRenamed("category", "reason")
    return classed.select(*ABSENCE_COLUMNS)


def sort_absences(absences: DataFrame) -> DataFrame:
    """By date and player, nulls last; the other columns settle ties."""
    return absences.orderBy(
        *[F.col(c).asc_nulls_last() for c in ("date", "player_name", "player_id", "value", "source_file")]
    )


def classed_texts(absences: DataFrame) -> DataFrame:
    """(value, n, status, reason): each text once, with its count. The rules run on the counted texts only."""
    counts = absences.groupBy("value").agg(F.count("*").alias("n"))
    return with_classes(counts, "value").withColumnRenamed("category", "reason")


def _class_shares(absences: DataFrame, name: str) -> DataFrame:
    counts = classed_texts(absences).groupBy(name).agg(F.sum("n").alias("count"))
    # a row per class, and the rules know a handful of classes
    total = F.sum("count").over(Window.partitionBy())
    return counts.withColumn("share", F.round(F.col("count") / total, 6)).orderBy(
        F.desc("count"), F.col(name).asc_nulls_last()
    )


def status_shares(absences: DataFrame) -> DataFrame:
    return _class_shares(absences, "status")


def reason_shares(absences: DataFrame) -> DataFrame:
    return _class_shares(absences, "reason")


def _unclassified(absences: DataFrame) -> DataFrame:
    return classed_texts(absences).where(F.col("status") == UNKNOWN)


def unclassified_vocabulary(absences: DataFrame) -> DataFrame:
    """Texts that no rule knows, with counts; a missing text is counted too."""
    return _unclassified(absences).select("value", F.col("n").alias("count")).orderBy(
        F.desc("count"), F.col("value").asc_nulls_last()
    )


def unclassified_summary(absences: DataFrame) -> DataFrame:
    return _unclassified(absences).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("unclassified_rows"), F.count("value").alias("distinct_values")
    )


def archive_profile(archive: DataFrame) -> DataFrame:
    """rows, games, did-not-play rows, their share, and those without a reason.

    Counted per game first, so distinct games need no set of all games in one task.
    """
    per_game = archive.groupBy("game_id").agg(
        F.count("*").alias("n"),
        F.count_if("did_not_play").alias("missed"),
        F.count_if(F.col("did_not_play") & F.col("reason").isNull()).alias("unexplained"),
    )
    return per_game.agg(
        F.sum("n").alias("player_games"),
        F.count("game_id").alias("games"),
        F.sum("missed").alias("dnp_rows"),
        F.round(F.sum("missed") / F.sum("n"), 6).alias("dnp_share"),
        F.sum("unexplained").alias("dnp_without_reason"),
    )


def absences_by_season(archive: DataFrame) -> DataFrame:
    return archive.where("did_not_play").groupBy("season").agg(F.count("*").alias("dnp_rows")).orderBy("season")


def common_reasons(archive: DataFrame, k: int = 10) -> DataFrame:
    return top_values(archive.where("did_not_play"), "reason", k)
