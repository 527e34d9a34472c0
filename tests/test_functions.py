import subprocess
import sys
from datetime import date

import pytest
from pyspark.sql import functions as F

from boxlake.functions import links
from boxlake.functions.absence import classify
from boxlake.functions.markup import has_element, hrefs
from boxlake.functions.minutes import is_complete_game, played_minutes, played_seconds
from boxlake.functions.seasons import in_season, parse_season_spec, season_label, season_list
from boxlake.functions.text import is_zero, strip
from boxlake.leagues import league, league_frame, league_keys

NBA, WNBA = league("nba"), league("wnba")

GAMES = [
    (NBA, "20210516", "TOR", "/boxscores/202105160TOR.html", "boxscores_202105160TOR.html"),
    (WNBA, "20260517", "ATL", "/wnba/boxscores/202605170ATL.html", "wnba_boxscores_202605170ATL.html"),
]


@pytest.mark.parametrize("lg, date, team, link, name", GAMES)
def test_links_and_file_names_round_trip(values, lg, date, team, link, name):
    assert values(links.box_score_link(lg, F.lit(date), F.col("x")), [team]) == [link]
    assert values(links.file_name_of(F.col("x")), [link, "no-page", "a/b.html"]) == [name, None, "a_b.html"]
    game = values(links.decode_file_name(lg, F.col("x")), [name])[0]
    assert (game.date, game.team, game.game_no) == (date, team, "0")
    pbp = link.replace("/boxscores/", "/boxscores/pbp/")
    assert values(links.play_by_play_of(lg, F.col("x")), [link, name]) == [pbp, pbp.lstrip("/").replace("/", "_")]
    assert values(links.play_by_play_link(lg, F.lit(date), F.col("x")), [team]) == [pbp]


def test_leagues_and_page_kinds_reject_each_other(values):
    names = [g[4] for g in GAMES] + ["boxscores_pbp_202105160TOR.html", "xboxscores_202105160TOR.html", "boxscores_1.html"]
    assert values(links.decode_file_name(NBA, F.col("x")).isNotNull(), names) == [True, False, False, False, False]
    assert values(links.decode_file_name(WNBA, F.col("x")).isNotNull(), names) == [False, True, False, False, False]
    assert values(links.decode_file_name(NBA, F.col("x"), links.PLAY_BY_PLAY).isNotNull(), names) == [False, False, True, False, False]
    hrefs_ = [g[3] for g in GAMES] + ["https://x.org/boxscores/202105160TOR.html", "/boxscores/pbp/202105160TOR.html"]
    assert values(links.is_box_score_link(NBA, F.col("x")), hrefs_) == [True, False, False, False]


def test_game_number_survives_and_strict_decoding_fails(values):
    assert values(links.play_by_play_of(NBA, F.col("x")), ["boxscores_202105161TOR.html"]) == ["boxscores_pbp_202105161TOR.html"]
    assert values(links.schedule_link(WNBA, F.col("x"), F.lit(2025)), ["ATL"]) == ["/wnba/teams/ATL/2025_games.html"]
    for expression in (links.decode_file_name(NBA, F.col("x"), strict=True), links.play_by_play_of(NBA, F.col("x"), strict=True)):
        with pytest.raises(Exception, match="not a nba"):
            values(expression, ["wnba_boxscores_202605170ATL.html"])


def test_dates_are_checked_for_digits_only(values):
    assert values(links.is_valid_date(F.col("x")), ["20260101", "2026010", "202601011", "2026-1-1", "20259999"]) == [
        True, False, False, False, True
    ]
    assert values(links.game_date(F.col("x")), ["20260101", "20259999"]) == [date(2026, 1, 1), None]


def test_season_labels(values):
    day = F.to_date(F.col("x"))
    assert values(season_label(day, NBA.spans_years), ["2026-10-20", "2026-09-30"]) == [2027, 2026]
    assert values(season_label(day, WNBA.spans_years), ["2026-10-20"]) == [2026]


@pytest.mark.parametrize(
    "spec, years",
    [
        ("2015-2017,2025", [2015, 2016, 2017, 2025]), ("2025", [2025]), (" 2025 , 2024-2025,", [2024, 2025]),
        ("2020-2019", []),
    ],
)
def test_season_spec(values, spec, years):
    assert values(parse_season_spec(F.col("x")), [spec]) == [years]


def test_season_list_defaults_to_the_running_season(spark):
    assert [r.season for r in season_list(spark, None, NBA, "2026-10-20").collect()] == [2027]
    assert sorted(r.season for r in season_list(spark, "2015-2016", NBA, "2026-10-20").collect()) == [2015, 2016]


def test_calendar_filter_takes_two_half_seasons_too_many(values):
    days = ["20180301", "20181101", "20190301", "20191101"]
    assert values(in_season(NBA, F.col("x"), 2019), days) == [True] * 4
    assert values(in_season(NBA, F.col("x"), 2019, "season"), days) == [False, True, True, False]
    assert values(in_season(WNBA, F.col("x"), 2019), days) == [False, False, True, True]


def test_minutes(values):
    clocks = ["34:30", "5:00", "100:59", "1234:56", "DNP", "Did Not Play", "", None, "12:34.5", "x12:34"]
    assert values(played_minutes(F.col("x")), clocks) == [34.5, 5.0, 100.983333, 0, 0, 0, 0, 0, 12.566667, 0]
    assert values(played_seconds(F.col("x")), ["34:30", None]) == [2070, 0]


@pytest.mark.parametrize("lg, good, bad", [(NBA, [240, 265, 290, 315, 340], [250, 200]), (WNBA, [200, 225, 250], [240])])
def test_complete_games(values, lg, good, bad):
    full = F.array(*[F.lit(n) for n in lg.full_game_totals])
    assert values(is_complete_game(F.col("x"), full), [float(n) for n in good], "double") == [True] * len(good)
    assert values(is_complete_game(F.col("x"), full), [float(n) for n in bad], "double") == [False] * len(bad)
    assert values(is_complete_game(F.col("x"), full), [good[0] + 0.05, good[0] + 0.2], "double") == [True, False]


def test_zero_is_strictly_within_tolerance(values):
    assert values(is_zero(F.col("x")), [0.0, 9e-5, -9e-5, 1e-4], "double") == [True, True, True, False]


def test_strip_covers_no_break_spaces(values):
    assert values(strip("x"), ["\xa0 a b\t\n", " x\x1f", None, "  "]) == ["a b", "x", None, ""]


@pytest.mark.parametrize(
    "text, status, reason",
    [
        ("benched by coach's decision tonight", "not_chosen", "coach_decision"),
        ("A team decision, they say", "not_chosen", "coach_decision"),
        ("coachs decision after the suspended game", "not_chosen", "coach_decision"),
        ("two games, suspended", "unavailable", "suspension"),
        ("Ineligible until Friday", "unavailable", "suspension"),
        ("traded to another club; knee is fine", "unavailable", "not_with_team"),
        ("overseas commitments", "unavailable", "not_with_team"),
        ("family matters", "unavailable", "personal"),
        ("on maternity leave", "unavailable", "personal"),
        ("scheduled rest day", "unavailable", "rest"),
        ("general fatigue", "unavailable", "rest"),
        ("an injury report came late", "unavailable", "injury"),
        ("feeling ill", "unavailable", "illness"),
        ("the flu, again", "unavailable", "illness"),
        ("torn meniscus", "unavailable", "injury"),
        ("tight hip", "unavailable", "injury"),
        ("inactive list", "unavailable", "undisclosed"),
        ("arrested development", "unknown", "unknown"),
        ("chill in the air", "unknown", "unknown"),
        ("championship leave", "unknown", "unknown"),
        ("fluent in French", "unknown", "unknown"),
        ("ärest", "unknown", "unknown"),
        ("no words for it", "unknown", "unknown"),
        (None, "unknown", "unknown"),
    ],
)
def test_classification(values, text, status, reason):
    assert values(classify(F.col("x")), [text, "pad"])[0] == (status, reason)


def test_league_table(spark):
    rows = {r.league: r for r in league_frame(spark).collect()}
    assert list(rows) == league_keys()
    assert rows["wnba"].full_game_totals == [200, 225, 250, 275, 300] and len(rows["wnba"].teams) == 13
    assert league("nba").season_years(2019) == [2018, 2019] and league("wnba").season_years(2019) == [2019]
    with pytest.raises(KeyError, match="unknown league"):
        league("none")


def test_element_test_sees_tags_only(values):
    pages = [
        '<table id="pbp"><tr></tr></table>',
        '<h2>Play-By-Play</h2><table id="other">',
        '<!-- <table id="pbp"> -->',
        "<script>var x = '<table id=\"pbp\">';</script>",
        "<TABLE class='a > b' ID = 'pbp' >",
        "<table data-id=pbp class=x>",
        "<table id=pbp>",
        '<table id="pbp2">',
        '<table title=" id=pbp ">',
        '<tablet id="pbp">',
    ]
    assert values(has_element(F.col("x"), "table", "id", "pbp"), pages) == [
        True, False, False, False, True, False, True, False, False, False
    ]


def test_links_on_a_page(values):
    page = """<a href="/1.html">a</a><!-- <a href="/no.html"> --><A class=x HREF='/2.html'>b</a>
    <a name="n">c</a><abbr href="/no">d</abbr><a data-href="/no" href=/3.html>e</a><a href="/q?a=1&amp;b=2">f</a>"""
    assert values(hrefs(F.col("x")), [page, "none"]) == [["/1.html", "/2.html", "/3.html", "/q?a=1&b=2"], []]


def test_import_does_no_work():
    code = "import boxlake.catalog, __spark_entry__; from pyspark.sql import SparkSession; assert SparkSession.getActiveSession() is None"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=__file__.rsplit("/tests/", 1)[0])
