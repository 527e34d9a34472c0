"""Clock text and the complete-game rule."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from boxlake.fixed_values import GAME_MINUTES_TOLERANCE

_CLOCK = r"^([0-9]{1,3}):([0-9]{2})"


def played_seconds(clock: Column) -> Column:
    """Whole seconds of a ``MM:SS`` text; 0 for null, DNP or any other text. Exact to sum."""
    minutes = F.regexp_extract(clock, _CLOCK, 1).try_cast("long")
    seconds = F.regexp_extract(clock, _CLOCK, 2).try_cast("long")
    return F.when(clock.rlike(_CLOCK), minutes * 60 + seconds).otherwise(F.lit(0).cast("long"))


def played_minutes(clock: Column) -> Column:
    return F.round(played_seconds(clock) / F.lit(60.0), 6)


def is_complete_game(total_minutes: Column, full_game_totals: Column) -> Column:
    return F.exists(full_game_totals, lambda full: F.abs(total_minutes - full) <= GAME_MINUTES_TOLERANCE)
