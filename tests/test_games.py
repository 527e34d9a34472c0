import random

import pytest
from pyspark.sql import functions as F

from boxlake.functions.links import decode_file_name
from boxlake.leagues import league
from boxlake.operators.game_chain import link_games, neighbours_on
from boxlake.operators.reconcile import game_summary, gap_rows, gap_summary, refresh_list
from boxlake.plans.backfill import expected_pages, pages_to_fetch, pull_counts
from boxlake.plans.box_scores import enrich, game_rows, team_minutes
from boxlake.plans.coverage import coverage, play_by_play_gaps, play_by_play_summary
from boxlake.plans.schedule import away_teams, games_on, prepare, records, resolve_home, scores
from boxlake.plans.status import schedule_targets, target_teams

NBA, WNBA = league("nba"), league("wnba")
GAMES = "team string, season int, yyyymmdd string, file_pos long"


def brute_force_chain(rows):
    ordered = sorted((r for r in rows if r[0] is not None and r[1] is not None), key=lambda r: (r[0], r[1], r[2], r[3]))
    links = {r[3]: (None, None) for r in rows}
    for one, two in zip(ordered, ordered[1:]):
        if one[:2] == two[:2]:
            links[one[3]] = (links[one[3]][0], two[2])
            links[two[3]] = (one[2], links[two[3]][1])
    return links


def test_chain_breaks_at_team_and_season(frame):
    rows = [
        ("ATL", 2024, "20241001", 1), ("ATL", 2025, "20250501", 2), ("ATL", 2025, "20250503", 3),
        ("ATL", 2025, "20250503", 4), ("ATL", 2025, "20250507", 5), ("NYL", 2025, "20250502", 6),
        (None, 2025, "20250501", 7), (None, 2025, "20250502", 8), ("ATL", None, "20250504", 9),
    ]
    linked = {r.file_pos: (r.prev_game_dt, r.next_game_dt) for r in link_games(frame(rows, GAMES)).collect()}
    assert linked == brute_force_chain(rows)
    assert linked[3] == ("20250501", "20250503") and linked[4] == ("20250503", "20250507")


def test_chain_with_one_team_holding_most_rows(frame):
    draw = random.Random(7)
    rows = [
        (draw.choice(["HOT"] * 3 + ["A", "B", None]), draw.choice([2024, 2025]), f"2025{draw.randint(1, 9):02}{draw.randint(1, 28):02}", i)
        for i in range(3000)
    ]
    linked = {r.file_pos: (r.prev_game_dt, r.next_game_dt) for r in link_games(frame(rows, GAMES)).collect()}
    assert linked == brute_force_chain(rows)
    # the next game of the previous game is a game of the same day
    assert all(linked[p][0] <= day for _, _, day, p in rows if linked[p][0])


def test_lookup_takes_the_last_game_of_a_day(frame):
    linked = link_games(frame([("A", 2025, "20250501", 1), ("A", 2025, "20250501", 2), ("A", 2025, "20250502", 3)], GAMES))
    wanted = frame([("A", "20250501")], "team string, yyyymmdd string")
    assert [(r.prev_game_dt, r.next_game_dt) for r in neighbours_on(linked, wanted).collect()] == [("20250501", "20250502")]
    unknown = frame([("A", "20250509")], "team string, yyyymmdd string")
    with pytest.raises(Exception, match="no game for A on 20250509"):
        neighbours_on(linked, unknown).collect()
    assert neighbours_on(linked, unknown, strict=False).first().next_game_dt is None


SCHEDULE = (
    "team string, season int, yyyymmdd string, opp_name string, game_location string, game_result string, "
    "pts int, opp_pts int, wins int, losses int, file_pos long"
)


@pytest.fixture
def schedule(frame):
    rows = [
        ("ATL", 2025, "20250501", "Zeta Zebras ", None, "W", 90, 80, 1, 0, 1),
        ("ZZZ", 2025, "20250501", "Atlanta", "@", "L", 80, 90, 0, 1, 2),
        ("ZZZ", 2025, "20250503", " Atlanta ", None, "W", 70, 60, 1, 1, 3),
        ("ATL", 2025, "20250503", "Zeta Zebras", "@", "L", 60, 70, 1, 1, 4),
        ("ATL", 2025, "20250505", "Nobody", "N", "W", 1, 0, 2, 1, 5),
    ]
    teams = frame([("ATL", "Atlanta "), ("ZZZ", "Zeta Zebras"), ("AAA", "Zeta Zebras")], "code string, name string")
    return prepare(frame(rows, SCHEDULE), teams)


def test_home_side_and_games_of_a_day(schedule):
    sides = {r.file_pos: (r.opp, r.home_team) for r in schedule.collect()}
    # of two codes with one name the last counts; an odd location makes each side its own home
    assert sides == {1: ("ZZZ", "ATL"), 2: ("ATL", "ATL"), 3: ("ATL", "ZZZ"), 4: ("ZZZ", "ZZZ"), 5: (None, "ATL")}
    assert [tuple(r) for r in games_on(schedule, "20250503").collect()] == [("20250503", "ZZZ", "ATL", "W")]
    assert games_on(schedule, "20250505").count() == 0


def test_away_team_whichever_code_sorts_first(schedule, frame):
    wanted = frame([("ATL", "20250501"), ("ZZZ", "20250503"), ("ATL", "20250509")], "home_team string, yyyymmdd string")
    assert {(r.home_team, r.away_team) for r in away_teams(schedule, wanted).collect()} == {
        ("ATL", "ZZZ"), ("ZZZ", "ATL"), ("ATL", None)
    }


def test_scores_and_records(schedule, frame):
    wanted = frame([("ATL", "20250501"), ("ZZZ", "20250501")], "team string, yyyymmdd string")
    assert {(r.team, r.pts, r.opp_pts) for r in scores(schedule, wanted).collect()} == {("ATL", 90, 80), ("ZZZ", 80, 90)}
    assert {(r.team, r.wins, r.losses) for r in records(schedule, wanted).collect()} == {("ATL", 1, 0), ("ZZZ", 0, 1)}
    for rows in (schedule, schedule.unionAll(schedule)):
        key = ("ATL", "20250502") if rows is schedule else ("ATL", "20250501")
        with pytest.raises(Exception, match="not exactly one game"):
            scores(rows, frame([key], "team string, yyyymmdd string")).collect()


def test_enriched_fact_and_game_rows(frame):
    fact = frame(
        [
            ("wnba_boxscores_202505160WAS.html", "Atlanta Dream ", "a", "40:00"),
            ("wnba_boxscores_202505160WAS.html", "Washington", "b", "DNP"),
            ("wnba_boxscores_202505170ATL.html", "Elsewhere", "c", "1:30"),
            ("wnba_boxscores_202505170ATL.html", "Atlanta Dream", None, "1:30"),
        ],
        "file_name string, team string, player_id string, mp string",
    )
    teams = frame([("ATL", " Atlanta Dream"), ("WAS", "Washington")], "code string, name string")
    players = frame([("a", 0), ("b", 1)], "key string, id long")
    enriched = enrich(fact, teams, players, WNBA)
    assert sorted((r.team or "", r.date, r.home_abrev, r.is_home, r.pid) for r in enriched.collect()) == [
        ("", "20250517", "ATL", False, None), ("ATL", "20250516", "WAS", False, 0), ("ATL", "20250517", "ATL", True, None),
        ("WAS", "20250516", "WAS", True, 1),
    ]
    assert game_rows(enriched, "ATL", "20250516").count() == 1
    for team, date, error in [
        ("XXX", "20250516", "unknown team"), ("ATL", "20250601", "no game on"), ("WAS", "20250517", "no game for WAS")
    ]:
        with pytest.raises(LookupError, match=error):
            game_rows(enriched, team, date)
    with pytest.raises(ValueError):
        game_rows(enriched, "ATL", "2025-5-1")
    with pytest.raises(Exception, match="not a nba"):
        enrich(fact, teams, players, NBA).collect()


def test_team_minutes(frame):
    fact = frame([("f", "ATL", m) for m in ["40:00"] * 4 + ["39:58", "DNP"]] + [("f", "WAS", "190:00")], "file_name string, team_code string, mp string")
    assert {(r.team_code, r.minutes, r.complete) for r in team_minutes(fact, WNBA).collect()} == {
        ("ATL", 199.966667, True), ("WAS", 190.0, False)
    }


BOX = [("wnba_boxscores_202606220ATL.html",), ("wnba_boxscores_202606240GSV.html",)]
PBP = [
    ("wnba_boxscores_pbp_202606220ATL.html", b"<table id='pbp'></table>"),
    ("wnba_boxscores_pbp_202606250ATL.html", b"<h2>Play-By-Play</h2>"),
]


def test_play_by_play_coverage(frame):
    box, pbp = frame(BOX + BOX[:1], "file_name string"), frame(PBP, "file_name string, content binary")
    assert play_by_play_summary(box, pbp, WNBA).first().asDict() == {
        "expected_games": 2, "cached_files": 2, "valid_files": 1, "invalid_files": 1, "missing_files": 1
    }
    assert [tuple(r) for r in play_by_play_gaps(box, pbp, WNBA).collect()] == [
        ("wnba_boxscores_pbp_202606250ATL.html", "invalid"), ("wnba_boxscores_pbp_202606240GSV.html", "missing")
    ]


def test_coverage_of_one_season(frame):
    box = frame(BOX + [("wnba_boxscores_202506220ATL.html",)], "file_name string")
    pbp = frame(PBP + [("wnba_boxscores_pbp_202506220ATL.html", b"<table id=pbp>")], "file_name string, content binary")
    row = coverage(box, box, pbp, WNBA, 2025).first()
    assert (row.games, row.first_game, row.last_game, row.cached_box_scores) == (1, "20250622", "20250622", 3)
    assert (row.expected_games, row.valid_files, row.missing_files, row.season) == (1, 1, 0, 2025)
    empty = coverage(box, box, pbp, WNBA, 1999).first()
    assert (empty.games, empty.first_game, empty.distinct_game_dates, empty.cached_files) == (0, None, 0, 0)
    assert "games" not in coverage(None, box, pbp, WNBA).columns


def test_counts_add_up(frame):
    expected = frame([(i,) for i in range(0, 90)], "k int")
    cached = frame([(i, i % 3 == 0) for i in range(30, 120)], "k int, valid boolean")
    row = gap_summary(expected, cached, "k").first()
    assert row.valid_files + row.invalid_files == row.cached_files == 90 and row.missing_files == 30
    assert gap_rows(expected, cached, "k").count() == row.missing_files + row.invalid_files


def test_game_summary_counts_files_once(frame):
    names = frame([("boxscores_202105160TOR.html",)] * 3 + [("boxscores_202105161TOR.html",)], "file_name string")
    date = decode_file_name(NBA, F.col("file_name"))["date"]
    assert tuple(game_summary(names, "file_name", date).first()) == (2, "20210516", "20210516", 1)


def test_refresh_list(frame):
    expected = frame(
        [("fresh", "schedule", 2026), ("old", "schedule", 2026), ("old_season", "schedule", 2025), ("box", "box_score", 2026),
         ("new", "box_score", 2026)], "file_name string, kind string, season int",
    )
    held = frame(
        [("fresh", "2026-06-01 11:30:00"), ("fresh", "2020-01-01 00:00:00"), ("old", "2026-06-01 10:00:00"),
         ("old_season", "2020-01-01 00:00:00"), ("box", "2020-01-01 00:00:00"), ("other", "2020-01-01 00:00:00")],
        "file_name string, t string",
    ).withColumn("modification_time", F.col("t").cast("timestamp"))
    due = refresh_list(expected, held, F.lit("2026-06-01 12:00:00"), F.lit(2026), max_age_seconds=3600)
    assert {(r.file_name, r.cause) for r in due.collect()} == {("old", "expired"), ("new", "missing")}


def test_schedule_targets(spark, frame):
    teams = target_teams(spark, WNBA, frame([("X", "y")], "code string, name string"))
    seasons = frame([(2025,), (2026,), (2025,)], "season int")
    links = [r.link for r in schedule_targets(teams, seasons, WNBA).collect()]
    assert len(links) == len(set(links)) == 26 and "/wnba/teams/ATL/2025_games.html" in links
    mapped = target_teams(spark, NBA, frame([("TOR", "a"), ("BOS", "b")], "code string, name string"))
    assert [r.code for r in mapped.collect()] == ["BOS", "TOR"]


def test_backlog_of_pages(frame):
    targets = frame([("/wnba/teams/ATL/2026_games.html", 2026), ("/wnba/teams/ATL/2025_games.html", 2025)], "link string, season int")
    links = frame([("/wnba/boxscores/202605170ATL.html",)] * 2, "link string")
    expected = expected_pages(targets, links, WNBA)
    assert {(r.file_name, r.kind, r.season) for r in expected.collect()} == {
        ("wnba_teams_ATL_2026_games.html", "schedule", 2026), ("wnba_teams_ATL_2025_games.html", "schedule", 2025),
        ("wnba_boxscores_202605170ATL.html", "box_score", 2026), ("wnba_boxscores_pbp_202605170ATL.html", "play_by_play", 2026),
    }
    held = frame(
        [("wnba_teams_ATL_2026_games.html", "2026-05-18 00:00:00"), ("wnba_boxscores_202605170ATL.html", "2026-05-18 00:00:00")],
        "file_name string, t string",
    ).withColumn("modification_time", F.col("t").cast("timestamp"))
    due = pages_to_fetch(expected, held, F.lit("2026-05-18 07:00:00"), F.lit(2026))
    assert {(r.link, r.cause) for r in due.collect()} == {
        ("/wnba/teams/ATL/2026_games.html", "expired"), ("/wnba/teams/ATL/2025_games.html", "missing"),
        ("/wnba/boxscores/pbp/202605170ATL.html", "missing"),
    }
    assert {tuple(r) for r in pull_counts(expected, due).collect()} == {
        ("schedule", 2, 2, 0), ("box_score", 1, 0, 1), ("play_by_play", 1, 1, 0)
    }


def test_resolve_home_keeps_unknown_opponents(frame):
    rows = frame([("A", 2025, "20250101", "Nobody", "@", "W", 1, 2, 0, 0, 1)], SCHEDULE)
    row = resolve_home(rows, frame([("B", "Bees")], "code string, name string")).first()
    assert (row.opp, row.home_team) == (None, None)
