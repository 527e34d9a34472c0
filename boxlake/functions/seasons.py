"""Season labels, season lists and the two year filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxlake.fixed_values import SEASON_FIRST_MONTH
from boxlake.leagues import League


def season_label(date: Column, spans_years: Column | bool) -> Column:
    """Label of the season a day falls in: the ending year where seasons span the new year."""
    spans = F.lit(spans_years) if isinstance(spans_years, bool) else spans_years
    year = F.year(date)
    return F.when(spans & (F.month(date) >= SEASON_FIRST_MONTH), year + 1).otherwise(year)


def in_season(league: League, yyyymmdd: Column, season: int, year_filter: str = "calendar") -> Column:
    """``calendar`` keeps every date in the calendar years the season touches, ``season`` only its own."""
    if year_filter == "calendar":
        return yyyymmdd.substr(1, 4).cast("int").isin(league.season_years(season))
    if year_filter == "season":
        return season_label(F.to_date(yyyymmdd, "yyyyMMdd"), league.spans_years) == season
    raise ValueError(f"year_filter must be 'calendar' or 'season', not {year_filter!r}")


def parse_season_spec(spec: Column) -> Column:
    """``"2015-2017,2025"`` -> sorted array of its years."""
    parts = F.filter(F.transform(F.split(spec, ","), F.trim), lambda part: part != "")

    def years(part: Column) -> Column:
        low = F.split(part, "-")[0].cast("int")
        high = F.element_at(F.split(part, "-"), -1).cast("int")
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    return F.array_sort(F.array_distinct(F.flatten(F.transform(parts, years))))


def season_list(spark: SparkSession, spec: str | None, league: League, run_date: str) -> DataFrame:
    """Target seasons: those the spec names, else the one in progress on ``run_date``."""
    if spec:
        years = parse_season_spec(F.lit(spec))
    else:
        years = F.array(season_label(F.to_date(F.lit(run_date)), league.spans_years))
    return spark.range(1).select(F.explode(years).alias("season"))
