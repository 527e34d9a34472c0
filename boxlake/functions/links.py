"""The link and file-name convention of game pages, as expressions over whole columns.

A link such as ``/<prefix>/boxscores/<date><n><TEAM>.html`` is cached under its own path with
``/`` replaced by ``_``; a play-by-play page has one more path element, ``pbp``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from boxlake.functions.text import extract, require
from boxlake.leagues import League

BOX_SCORE = "box_score"
PLAY_BY_PLAY = "play_by_play"
SCHEDULE = "schedule"
_EIGHT_DIGITS = r"^[0-9]{8}$"
_GAME = r"([0-9]{8})([0-9])([A-Z]{3})\.html$"


def _root(league: League) -> str:
    return f"/{league.prefix}" if league.prefix else ""


def link_pattern(league: League) -> str:
    return f"^{_root(league)}/boxscores/{_GAME}"


def file_pattern(league: League, kind: str = BOX_SCORE) -> str:
    prefix = f"{league.prefix}_" if league.prefix else ""
    if kind == SCHEDULE:
        return rf"^{prefix}teams_[A-Z]{{3}}_[0-9]{{4}}_games\.html$"
    return f"^{prefix}boxscores_{'pbp_' if kind == PLAY_BY_PLAY else ''}{_GAME}"


def file_glob(league: League, kind: str = BOX_SCORE, years: list[int] | None = None) -> str:
    """A coarse glob for the reader's file listing; ``file_pattern`` still decides."""
    prefix = f"{league.prefix}_" if league.prefix else ""
    start = f"{{{','.join(map(str, years))}}}" if years else "[0-9]"
    return f"{prefix}boxscores_{'pbp_' if kind == PLAY_BY_PLAY else ''}{start}*.html"


def is_valid_date(date: Column) -> Column:
    """Eight digits, no more is asked of a date key."""
    return date.rlike(_EIGHT_DIGITS)


def game_date(date: Column) -> Column:
    return F.try_to_date(date, "yyyyMMdd") if hasattr(F, "try_to_date") else F.to_date(date, "yyyyMMdd")


def box_score_link(league: League, date: Column, home: Column) -> Column:
    return F.concat(F.lit(f"{_root(league)}/boxscores/"), date, F.lit("0"), home, F.lit(".html"))


def play_by_play_link(league: League, date: Column, home: Column) -> Column:
    return F.concat(F.lit(f"{_root(league)}/boxscores/pbp/"), date, F.lit("0"), home, F.lit(".html"))


def schedule_link(league: League, team: Column, season: Column) -> Column:
    return F.concat(
        F.lit(f"{_root(league)}/teams/"), team, F.lit("/"), season.cast("string"), F.lit("_games.html")
    )


def is_box_score_link(league: League, link: Column) -> Column:
    return link.rlike(link_pattern(league))


def file_name_of(link: Column) -> Column:
    """Cache file name of a link; null unless the link ends in .html."""
    return F.when(link.endswith(".html"), F.translate(F.regexp_replace(link, "^/", ""), "/", "_"))


def decode_file_name(league: League, name: Column, kind: str = BOX_SCORE, strict: bool = False) -> Column:
    """File name -> struct(date, game_no, team); null, or a failed job when strict, if it is not ours."""
    pattern = file_pattern(league, kind)
    matched = name.rlike(pattern)
    if strict:
        matched = require(matched, F.concat(F.lit(f"not a {league.key} {kind} file name: "), name))
    return F.when(
        matched,
        F.struct(
            F.regexp_extract(name, pattern, 1).alias("date"),
            F.regexp_extract(name, pattern, 2).alias("game_no"),
            F.regexp_extract(name, pattern, 3).alias("team"),
        ),
    )


def play_by_play_of(league: League, box_score: Column, strict: bool = False) -> Column:
    """Play-by-play link (or file name) of a box-score link (or file name), game number kept."""
    by_link, by_name = is_box_score_link(league, box_score), box_score.rlike(file_pattern(league))
    mapped = (
        F.when(by_link, F.regexp_replace(box_score, r"/boxscores/", "/boxscores/pbp/"))
        .when(by_name, F.regexp_replace(box_score, r"boxscores_", "boxscores_pbp_"))
    )
    if strict:
        bad = F.concat(F.lit(f"not a {league.key} box score: "), box_score)
        mapped = F.when(require(by_link | by_name, bad), mapped)
    return mapped


def file_year(league: League, name: Column, kind: str = BOX_SCORE) -> Column:
    return extract(name, file_pattern(league, kind), 1).substr(1, 4).cast("int")
