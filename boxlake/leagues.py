"""League dimension: a handful of fixed rows, usable from Python and as a DataFrame."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from boxlake.fixed_values import LEAGUES, MAX_OVERTIMES


class League(NamedTuple):
    key: str
    display_name: str
    prefix: str
    regulation_minutes: int
    overtime_minutes: int
    periods: list[str]
    spans_years: bool
    teams: list[str]

    @property
    def full_game_totals(self) -> list[int]:
        """Player-minutes of a complete game, from no overtime to the longest one kept."""
        return [self.regulation_minutes + n * self.overtime_minutes for n in range(MAX_OVERTIMES + 1)]

    def season_years(self, season: int) -> list[int]:
        """Calendar years that a season label covers."""
        return [season - 1, season] if self.spans_years else [season]


_BY_KEY = {row[0]: League(*row) for row in LEAGUES}


def league(key: str) -> League:
    if key not in _BY_KEY:
        raise KeyError(f"unknown league {key!r}; known are {sorted(_BY_KEY)}")
    return _BY_KEY[key]


def league_keys() -> list[str]:
    return list(_BY_KEY)


def league_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [tuple(row) + (row.full_game_totals,) for row in _BY_KEY.values()],
        "league string, display_name string, prefix string, regulation_minutes int, overtime_minutes int, "
        "periods array<string>, spans_years boolean, teams array<string>, full_game_totals array<int>",
    )
