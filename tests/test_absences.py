from datetime import date

import pytest
from pyspark.sql import functions as F

import boxlake.plans.absences as absences
from boxlake.sources.facts import export_absences_csv
from boxlake.fixed_values import SEASON_FILE_PREFIX
from boxlake.sources.season_archive import read_season_files, season_list, write_archive

COLUMNS = (
    "game_id string, season int, season_type int, game_date string, athlete_id string, athlete_display_name string, "
    "team_id string, team_abbreviation string, opponent_team_abbreviation string, home_away string, starter boolean, "
    "minutes double, active boolean, ejected boolean, did_not_play boolean, reason string, extra int"
)


def player_game(game, season, name, missed, reason, day="05-16"):
    return (game, season, 2, f"{season}-{day}", "7", name, "1", "ATL", "WAS", "home", False, None, True, False, missed, reason, 1)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    raw = tmp_path_factory.mktemp("raw")
    staging = tmp_path_factory.mktemp("staging")
    late = [
        player_game("a", 2024, "Zoe", True, "LEFT ANKLE"), player_game("a", 2024, "Amy", True, "COACH'S DECISION"),
        player_game("a", 2024, "Bea", False, "COACH'S DECISION"), player_game("b", 2024, "Cat", None, "COACH'S DECISION"),
        player_game("b", 2024, None, True, "COACH'S DECISION"), player_game("b", 2024, "Dot", True, None),
        player_game("b", 2024, "Eve", True, "NEW PHRASE", "05-01"),
    ]
    frames = {
        2024: spark.createDataFrame(late, COLUMNS),
        2003: spark.createDataFrame([player_game("z", 2003, "Old", None, None)], COLUMNS).drop(
            "did_not_play", "reason", "active", "ejected", "extra"
        ),
        2010: spark.createDataFrame([player_game("y", 2010, "Mid", True, "REST")], COLUMNS),
    }
    for season, table in frames.items():
        table.coalesce(1).write.parquet(f"{staging}/{season}")
        part = next((staging / str(season)).glob("part-*.parquet"))
        (raw / f"player_box_{season}.parquet").write_bytes(part.read_bytes())
    (raw / "other.parquet").write_bytes(b"not read")
    return str(raw)


def test_seasons_come_from_file_names(spark, folder):
    assert [r.season for r in season_list(spark, folder).collect()] == [2003, 2010, 2024]
    assert {r.season for r in read_season_files(spark, folder, 2004, 2010).select("season").collect()} == {2010}
    with pytest.raises(FileNotFoundError, match=r"\[2030, None\]"):
        read_season_files(spark, folder, 2030)


def test_all_seasons_take_one_shape(spark, folder):
    archive = absences.read_archive(spark, folder)
    assert archive.columns == COLUMNS.replace(" string", "").replace(" int", "").replace(" boolean", "").replace(
        " double", "").split(", ")[:-1] + ["source_file"]
    old = archive.where("season = 2003").first()
    assert (old.did_not_play, old.reason, old.active, old.source_file) == (False, None, None, "player_box_2003.parquet")
    kept = {r.athlete_display_name: r.reason for r in archive.where("season = 2024").collect()}
    assert kept["Bea"] is None and kept["Cat"] is None and kept["Amy"] == "COACH'S DECISION"
    assert archive.first().game_date.year in (2003, 2010, 2024)


def test_absence_table(spark, folder):
    table = absences.sort_absences(absences.absence_table(absences.read_archive(spark, folder)))
    rows = table.collect()
    assert table.columns == ["player_name", "player_id", "date", "status", "reason", "value", "source_file"]
    assert [(r.player_name, r.status, r.reason) for r in rows] == [
        ("Mid", "unavailable", "rest"), ("Eve", "unknown", "unknown"), ("Amy", "not_chosen", "coach_decision"),
        ("Dot", "unknown", "unknown"), ("Zoe", "unavailable", "injury"), (None, "not_chosen", "coach_decision"),
    ]
    assert rows[0].date == date(2010, 5, 16) and rows[2].value == "COACH'S DECISION"


def test_reports(spark, folder):
    archive = absences.read_archive(spark, folder)
    table = absences.absence_table(archive)
    assert [tuple(r) for r in absences.status_shares(table).collect()] == [
        ("not_chosen", 2, 0.333333), ("unavailable", 2, 0.333333), ("unknown", 2, 0.333333)
    ]
    assert {(r.reason, r["count"]) for r in absences.reason_shares(table).collect()} == {
        ("coach_decision", 2), ("unknown", 2), ("rest", 1), ("injury", 1)
    }
    assert [tuple(r) for r in absences.unclassified_vocabulary(table).collect()] == [("NEW PHRASE", 1), (None, 1)]
    assert tuple(absences.unclassified_summary(table).first()) == (2, 1)
    assert absences.archive_profile(archive).first().asDict() == {
        "player_games": 9, "games": 4, "dnp_rows": 6, "dnp_share": 0.666667, "dnp_without_reason": 1
    }
    assert [tuple(r) for r in absences.absences_by_season(archive).collect()] == [(2010, 1), (2024, 5)]
    assert tuple(absences.common_reasons(archive, 1).first()) == ("COACH'S DECISION", 2)


def test_flag_filter_reaches_the_scan(spark, folder, tmp_path):
    write_archive(absences.read_archive(spark, folder), str(tmp_path / "archive"))
    stored = spark.read.parquet(str(tmp_path / "archive"))
    plan = absences.absence_table(stored)._jdf.queryExecution().toString()
    assert "EqualTo(did_not_play,true)" in plan and "minutes" not in plan.split("ReadSchema:")[-1].split("\n")[0]


def test_csv_export(spark, folder, tmp_path):
    export_absences_csv(absences.absence_table(absences.read_archive(spark, folder)), str(tmp_path / "csv"))
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert back.count() == 6 and back.columns[:3] == ["player_name", "player_id", "date"]
    assert back.where(F.col("value").isNull()).count() == 1


def test_types_that_drift_between_seasons(spark, tmp_path):
    shapes = {2020: "game_id long, athlete_id int, note int", 2021: "game_id string, athlete_id string, note string"}
    for season, shape in shapes.items():
        rows = spark.createDataFrame([(7, 1, 2) if season == 2020 else ("x7", "1", "n")], shape)
        rows.toPandas().to_parquet(tmp_path / f"{SEASON_FILE_PREFIX}{season}.parquet")
    found = read_season_files(spark, str(tmp_path)).select("game_id", "athlete_id", "note").collect()
    assert sorted(tuple(r) for r in found) == [("7", "1", "2"), ("x7", "1", "n")]
