"""From raw pages to box-score rows, links and validity flags."""

from __future__ import annotations

import gc

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from boxlake.fixed_values import (
    DNP,
    FULL_GAME_CAPTION,
    OFFICIALS_LABEL,
    PERIOD_CAPTION_PATTERN,
    PLAY_BY_PLAY_TABLE_ID,
    STATS_TABLE_CLASS,
    TABLE_ID_PATTERN,
)
from boxlake.functions.links import is_box_score_link
from boxlake.functions.markup import has_element, hrefs, page_text
from boxlake.functions.text import extract, strip
from boxlake.leagues import League
from boxlake.operators import page_parser
from boxlake.operators.page_parser import PAGE, read_page
from boxlake.schemas import BOX_SCORE, columns, struct


# The parser travels with the job, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(page_parser)

_PLAYER_ROW = (
    "struct<table_pos: int, row_pos: int, player: string, player_id: string, mp: string, pts: string, "
    "team: string, team_code: string, period: string>"
)


def parse_pages(pages: DataFrame, keep: list[str], content: str = "content", parts: list[str] | None = None) -> DataFrame:
    """Add a ``page`` column, whole or with some of its ``parts``. Pages are independent: one pass, no shuffle, small Arrow batches."""
    given = pages.select(*keep, content)
    page = T.StructType([field for field in struct(PAGE) if parts is None or field.name in parts])
    schema = T.StructType([given.schema[c] for c in keep] + [T.StructField("page", page)])
    page_type = to_arrow_schema(schema).field("page").type

    def read(batches):
        for batch in batches:
            gc.disable()  # records have no cycles: looking for some in a batch of them only takes time
            try:
                found = pa.array([read_page(text.as_py()) for text in batch.column(content)], type=page_type)
            finally:
                gc.enable()
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [found], [*keep, "page"])

    return given.mapInArrow(read, schema)


def team_name(caption: Column) -> Column:
    """Caption without its closing word "Table" and the win-loss record before it."""
    text = F.regexp_replace(F.coalesce(caption, F.lit("")), r"(?U)\s*Table\s*$", "")
    return strip(F.regexp_replace(text, r"(?U)\s*\([0-9]+-[0-9]+\)\s*$", ""))


def officials_crew(line: Column) -> Column:
    """Names after the label of an officials line; empty where a page has none."""
    names = F.split(F.regexp_replace(F.coalesce(line, F.lit("")), f"^{OFFICIALS_LABEL}", ""), ",")
    return F.filter(F.transform(names, strip), lambda name: name != "")


def _by_id(table: Column) -> tuple[Column, Column, Column]:
    """(team name, team code, period) from the table id."""
    part = extract(table["table_id"], TABLE_ID_PATTERN, 2)
    return (
        team_name(table["caption"]),
        F.upper(extract(table["table_id"], TABLE_ID_PATTERN, 1)),
        F.when(part == "game", "FG").otherwise(F.upper(part)),
    )


def _by_caption(table: Column) -> tuple[Column, Column, Column]:
    """The same from the caption wording of older pages, which carry no team code."""
    caption = F.replace(F.coalesce(table["caption"], F.lit("")), F.lit("Table"), F.lit(""))
    full = caption.contains(FULL_GAME_CAPTION)
    return (
        F.when(full, F.replace(caption, F.lit(f" {FULL_GAME_CAPTION}"), F.lit("")))
        .otherwise(extract(caption, PERIOD_CAPTION_PATTERN, 1)),
        F.lit(None).cast("string"),
        F.when(full, "FG").otherwise(extract(caption, PERIOD_CAPTION_PATTERN, 2)),
    )


def _labels(table: Column, layout: str) -> tuple[Column, Column, Column]:
    return (_by_id if layout == "id" else _by_caption)(table)


def _stats_table(table: Column, position: Column, layout: str) -> Column:
    team, code, period = _labels(table, layout)
    rows = table["rows"]
    heads = F.get(rows, F.lit(1))["heads"]
    players = F.transform(
        F.slice(rows, F.lit(3), F.size(rows)), lambda row, at: F.struct(at.alias("row_pos"), row.alias("row"))
    )
    return F.struct(
        position.alias("table_pos"), team.alias("team"), code.alias("team_code"), period.alias("period"),
        F.slice(heads, F.lit(2), F.size(heads)).alias("columns"),
        F.filter(players, lambda p: (F.size(p["row"]["cells"]) > 0) & p["row"]["has_link"]).alias("players"),
        F.exists(players, lambda p: (F.size(p["row"]["cells"]) > 0) & ~p["row"]["has_head"]).alias("headless"),
    )


def _table_fault(table: Column) -> Column:
    """Why a full-game table cannot be read; null if it can."""
    widest = F.array_max(F.transform(table["players"], lambda p: F.size(p["row"]["cells"])))
    return (
        F.when(table["columns"].isNull(), "table has no header row")
        .when(table["headless"], "row has no head cell")
        .when(widest != F.size(table["columns"]), "row width differs from header")
        .when(~F.array_contains(table["columns"], "MP") | ~F.array_contains(table["columns"], "PTS"),
              "table lacks MP or PTS")
        .when(F.exists(table["players"], lambda p: p["row"]["link_target"].isNull()), "player link has no target")
    )


def _cell(player: Column, columns: Column, name: str) -> Column:
    """Text under a header. A row that starts with DNP is DNP throughout; a short row ends in nulls."""
    cells = player["row"]["cells"]
    value = F.get(cells, (F.array_position(columns, name) - 1).cast("int"))
    return F.when(cells[0] == DNP, F.lit(DNP)).otherwise(value)


def _player_rows(table: Column) -> Column:
    return F.transform(
        table["players"],
        lambda p: F.struct(
            table["table_pos"].alias("table_pos"), p["row_pos"].alias("row_pos"),
            p["row"]["link_text"].alias("player"), player_id(p["row"]["link_target"]).alias("player_id"),
            _cell(p, table["columns"], "MP").alias("mp"), _cell(p, table["columns"], "PTS").alias("pts"),
            table["team"].alias("team"), table["team_code"].alias("team_code"), table["period"].alias("period"),
        ),
    )


def extract_box_scores(pages: DataFrame, layout: str = "id", mode: str = "strict") -> DataFrame:
    """Player rows of the full-game tables of ``pages`` (league, file_name, content).

    ``layout`` is "id" for tables named by their id, "caption" for older pages. In "strict" mode one
    unreadable page fails the job. In "quarantine" mode there is an extra ``error`` column, and such
    a page gives a single row that carries only its name and the error. One parse serves both.
    """
    if mode not in ("strict", "quarantine"):
        raise ValueError(f"mode must be 'strict' or 'quarantine', not {mode!r}")
    parsed = parse_pages(pages, ["league", "file_name"], parts=["tables", "officials"])
    stats = F.filter("page.tables", lambda t: F.array_contains(t["classes"], STATS_TABLE_CLASS))
    placed = F.transform(stats, lambda t, at: F.struct(t.alias("table"), at.alias("position")))
    # tables of other periods go before their rows are looked at
    full_game = F.filter(placed, lambda p: F.coalesce(_labels(p["table"], layout)[2] == "FG", F.lit(False)))
    tables = parsed.select(
        "league", "file_name", officials_crew(F.col("page.officials")).alias("officials"),
        F.transform(full_game, lambda p: _stats_table(p["table"], p["position"], layout)).alias("tables"),
    )
    faults = F.filter(F.transform("tables", _table_fault), lambda fault: fault.isNotNull())
    checked = tables.withColumn(
        "error",
        F.when(F.size("tables") == 0, "no full-game tables found").otherwise(F.get(faults, F.lit(0))),
    )
    error, kind = F.col("error"), f"array<{_PLAYER_ROW}>"
    rows = F.flatten(F.transform("tables", _player_rows)).cast(kind)
    if mode == "strict":
        message = F.concat(error, F.lit(" in "), F.col("file_name"))
        rows = F.when(error.isNull(), rows).otherwise(F.raise_error(message).cast(kind))
    else:
        rows = F.when(error.isNull(), rows).otherwise(F.array(F.lit(None).cast(_PLAYER_ROW)))
    flat = checked.select("league", "file_name", "officials", "error", F.explode(rows).alias("r")).select(
        "league", "file_name", "officials", "error", "r.*"
    )
    return flat.select(*columns(BOX_SCORE), *(["error"] if mode == "quarantine" else []))


def player_id(target: Column) -> Column:
    """Last path element of a player link up to its first dot."""
    return F.split(F.element_at(F.split(target, "/"), -1), r"\.")[0]


def headline_teams(pages: DataFrame) -> DataFrame:
    """Team names of older pages, taken from their second-level headings."""
    parsed = parse_pages(pages, ["league", "file_name"], parts=["headings"])
    named = F.filter("page.headings", lambda h: h.contains(FULL_GAME_CAPTION))
    return parsed.select("league", "file_name", F.posexplode(named).alias("position", "heading")).select(
        "league", "file_name", "position",
        F.replace("heading", F.lit(FULL_GAME_CAPTION), F.lit("")).alias("team"),
    )


def page_links(pages: DataFrame, text: Column) -> DataFrame:
    """Every link of every page with its place on the page."""
    return pages.select("*", F.posexplode(hrefs(text)).alias("link_pos", "link"))


def discover_links(pages: DataFrame, text: Column, wanted) -> DataFrame:
    """Distinct links that ``wanted(link)`` keeps, over all pages, sorted."""
    links = pages.select(F.explode(hrefs(text)).alias("link"))
    return links.where(wanted(F.col("link"))).distinct().orderBy("link")


def discover_box_scores(schedule_pages: DataFrame, league: League) -> DataFrame:
    return discover_links(
        schedule_pages, page_text(F.col("content")), lambda link: is_box_score_link(league, link)
    )


def mark_play_by_play(pages: DataFrame, text: Column | None = None) -> DataFrame:
    """Add ``valid``: whether a play-by-play page has its event table."""
    text = page_text(F.col("content")) if text is None else text
    return pages.withColumn("valid", has_element(text, "table", "id", PLAY_BY_PLAY_TABLE_ID))
