"""Box-score and schedule facts: Parquet tables, CSV exchange files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxlake.fixed_values import ABSENCE_COLUMNS, AVAILABILITY_COLUMNS, CSV_COLUMNS
from boxlake.functions.links import decode_file_name
from boxlake.functions.seasons import season_label
from boxlake.leagues import League, league, league_keys
from boxlake.schemas import BOX_SCORE, SCHEDULE, columns, struct

_CSV = {"header": True, "nullValue": "", "emptyValue": "", "escape": '"'}


def with_season(fact: DataFrame, league: League) -> DataFrame:
    date = F.to_date(decode_file_name(league, F.col("file_name"), strict=True)["date"], "yyyyMMdd")
    return fact.withColumn("season", season_label(date, league.spans_years))


def season_of_file(key: Column, file_name: Column) -> Column:
    """Season of a box-score file of the league ``key``; null if the name is not one of its names."""
    season = F.lit(None).cast("int")
    for mine in map(league, league_keys()):
        date = F.try_to_date(decode_file_name(mine, file_name)["date"], "yyyyMMdd")
        season = F.when(key == mine.key, season_label(date, mine.spans_years)).otherwise(season)
    return season


def write_box_scores(fact: DataFrame, path: str, league: League, mode: str = "overwrite") -> None:
    """Partitioned by league and season, so that a season's readers skip the rest. Seasons not in ``fact`` stay."""
    writer = with_season(fact, league).write.mode(mode).option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("league", "season").parquet(path)


def read_box_scores(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(struct(BOX_SCORE + ", season int")).parquet(path)


def box_score_csv_shape(fact: DataFrame) -> DataFrame:
    """The nine exchange columns; the crew becomes one "|"-joined text."""
    source = ["player", "player_id", "mp", "pts", "team", "team_code", "period", None, "file_name"]
    crew = F.concat_ws("|", "officials")
    return fact.select(
        *[(crew if old is None else F.col(old)).alias(new) for old, new in zip(source, CSV_COLUMNS)]
    )


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**_CSV).csv(path)


def export_box_scores_csv(fact: DataFrame, path: str) -> None:
    """Ordered as the pages are: file name, table, row."""
    export_csv(box_score_csv_shape(fact.orderBy("file_name", "table_pos", "row_pos")), path)


def export_absences_csv(absences: DataFrame, path: str) -> None:
    export_csv(absences.select(*ABSENCE_COLUMNS), path)


def export_availability_csv(records: DataFrame, path: str) -> None:
    export_csv(records.select(*AVAILABILITY_COLUMNS), path)


def _read_csv(spark: SparkSession, path: str, kinds: dict[str, str], optional: tuple[str, ...] = ()) -> DataFrame:
    """Columns of a CSV file by the names in its header, whatever their order. A missing optional column is null."""
    table = spark.read.options(**_CSV).csv(path)
    missing = [name for name in kinds if name not in table.columns and name not in optional]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    return table.select(*[
        (F.col(f"`{name}`") if name in table.columns else F.lit(None)).cast(kind).alias(name) for name, kind in kinds.items()
    ])


def read_csv_texts(spark: SparkSession, path: str, wanted: list[str]) -> DataFrame:
    """Columns of an exchange file by name, as texts."""
    return _read_csv(spark, path, dict.fromkeys(wanted, "string"))


def read_box_scores_csv(spark: SparkSession, path: str, wanted: list[str] | None = None) -> DataFrame:
    """Exchange file back as all-text columns; only ``wanted`` columns are parsed. Old files lack some columns."""
    old = ("Player ID", "Team Code", "Period", "Officials")
    return _read_csv(spark, path, dict.fromkeys(wanted or CSV_COLUMNS, "string"), old)


def read_schedule_csv(spark: SparkSession, path: str, league: League) -> DataFrame:
    """Schedule rows in file order; ``file_pos`` breaks ties between games of one day."""
    kinds = {f.name: "double" if f.name == "yyyymmdd" else f.dataType.simpleString() for f in struct(SCHEDULE)[1:-1]}
    table = _read_csv(spark, path, kinds)
    return (
        table.withColumn("league", F.lit(league.key))
        .withColumn("yyyymmdd", F.col("yyyymmdd").cast("long").cast("string"))
        .withColumn("file_pos", F.monotonically_increasing_id())
        .select(*columns(SCHEDULE))
    )
