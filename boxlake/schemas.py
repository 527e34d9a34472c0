"""Table schemas as DDL text. Raw pages, facts, dimensions and logs all have one fixed shape."""

from pyspark.sql import types as T

from boxlake.fixed_values import ARCHIVE_COLUMNS

FILE = "path string, modificationTime timestamp, length long, content binary"
RAW_PAGE = "league string, file_name string, modification_time timestamp, length long, content binary"

# file_name, table_pos and row_pos carry the order in which rows appear on the pages.
BOX_SCORE = (
    "league string, file_name string, table_pos int, row_pos int, player string, player_id string, "
    "mp string, pts string, team string, team_code string, period string, officials array<string>"
)

SCHEDULE = (
    "league string, team string, season int, yyyymmdd string, opp_name string, game_location string, "
    "game_result string, pts int, opp_pts int, wins int, losses int, file_pos long"
)

TEAM_MAP = "code string, name string"
ID_MAP = "key string, id long"

PLAYER_AVAILABILITY = ", ".join(f"{name} {kind}" for name, kind in ARCHIVE_COLUMNS)

PULL_LOG = (
    "league string, dataset string, ts timestamp, seq long, event string, "
    "files_new long, files_cached long, error string"
)
ARTIFACT_LOG = (
    "league string, artifact string, ts timestamp, seq long, duration_s double, rows_out long, source_files long"
)


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def columns(ddl: str) -> list[str]:
    return struct(ddl).names
