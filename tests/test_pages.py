import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from boxlake.leagues import league
from boxlake.operators import page_parser
from boxlake.operators.page_parser import _Page, read_page
from boxlake.operators.pages import (
    discover_box_scores,
    extract_box_scores,
    headline_teams,
    mark_play_by_play,
    officials_crew,
    team_name,
)

WNBA = league("wnba")
HEAD = "<tr><th></th><th colspan=3>Basic</th></tr><tr><th>Starters</th><th>MP</th><th>FG</th><th>PTS</th></tr>"


def player(who, *cells, colspan=""):
    return f'<tr><th><a href="/players/g/{who}.html">{who.title()}</a></th>' + "".join(
        f"<td{colspan}>{c}</td>" for c in cells
    ) + "</tr>"


def box(code, *rows, period="game", name="Atlanta Dream", record="(0-1)"):
    return (
        f'<table class="sortable stats_table" id="box-{code}-{period}-basic"><caption>{name} {record} Table</caption>'
        f"<thead>{HEAD}</thead><tbody>{''.join(rows)}</tbody></table>"
    )


CREW = "<div><strong>Officials:\xa0</strong><a href='/r/a.html'>Ref A</a>, Ref B, Ref C, </div>"


@pytest.fixture
def extract(frame):
    def run(*pages, **options):
        rows = [("wnba", f"p{i}.html", page.encode()) for i, page in enumerate(pages)]
        found = extract_box_scores(frame(rows, "league string, file_name string, content binary"), **options)
        return sorted(found.collect(), key=lambda r: (r.file_name, r.table_pos or 0, r.row_pos or 0))

    return run


def test_one_row_per_player_of_the_full_game(extract):
    page = "<html>" + CREW + box(
        "ATL", player("a01w", "30:15", "4", "12"), HEAD, player("b02w", "9:45", "1", "2"),
        "<tr><th>Team Totals</th><td>200</td><td>5</td><td>14</td></tr>",
    ) + box("ATL", player("a01w", "10:00", "1", "3"), period="q1") + box(
        "was", player("c03w", "40:00", "3", "9"), name="Washington Mystics"
    ) + '<table class="stats_table" id="ATL-advanced"><tr><th>x</th></tr></table><table id="box-XXX-game-basic"></table>'
    rows = extract(page)
    assert [(r.player, r.player_id, r.mp, r.pts, r.team, r.team_code, r.period) for r in rows] == [
        ("A01W", "a01w", "30:15", "12", "Atlanta Dream", "ATL", "FG"),
        ("B02W", "b02w", "9:45", "2", "Atlanta Dream", "ATL", "FG"),
        ("C03W", "c03w", "40:00", "9", "Washington Mystics", "WAS", "FG"),
    ]
    assert {tuple(r.officials) for r in rows} == {("Ref A", "Ref B", "Ref C")}
    assert [r.table_pos for r in rows] == [0, 0, 2]


def test_absent_players(extract):
    rows = extract(box(
        "ATL", player("a", "30:15", "4", "12"), player("b", "Did Not Play", colspan=" colspan=3"), player("c", "DNP", "", "")
    ))
    assert [(r.mp, r.pts) for r in rows] == [("30:15", "12"), ("Did Not Play", None), ("DNP", "DNP")]


def test_no_officials_is_an_empty_crew(extract):
    assert extract(box("ATL", player("a", "1:00", "0", "0")))[0].officials == []


@pytest.mark.parametrize(
    "page, error",
    [
        ("<html><body>no tables</body></html>", "no full-game tables"),
        (box("ATL", player("a", "1:00", "0", "0"), period="h1"), "no full-game tables"),
        (box("ATL", player("a", "Did Not Play")), "row width"),
        (box("ATL", player("a", "1:00", "0", "0", "9")), "row width"),
        ('<table class="stats_table" id="box-ATL-game-basic"><tr></tr></table>', "no header row"),
        (box("ATL", player("a", "1:00", "0", "0")).replace("PTS", "POINTS"), "lacks MP or PTS"),
        (box("ATL", "<tr><th><a>X</a></th><td>1:00</td><td>0</td><td>0</td></tr>"), "no target"),
    ],
)
def test_unreadable_pages_fail_or_are_set_aside(extract, page, error):
    good = box("ATL", player("a", "1:00", "0", "0"))
    with pytest.raises(Exception, match=error):
        extract(good, page)
    rows = extract(good, page, mode="quarantine")
    assert [r.error for r in rows if r.error is None] == [None]
    assert [(r.file_name, r.player) for r in rows if r.error and error in r.error] == [("p1.html", None)]


def test_table_without_players_gives_no_rows(extract):
    assert extract(box("ATL")) == []


def test_older_layout_reads_captions(extract, frame):
    page = (
        "<h2>Toronto Raptors Basic and Advanced Stats</h2>"
        f'<table class="stats_table"><caption>Toronto Raptors Basic and Advanced Stats Table</caption>{HEAD}{player("a", "1:00", "0", "7")}</table>'
        f'<table class="stats_table"><caption>Toronto Raptors (Q1) Table</caption>{HEAD}{player("a", "1:00", "0", "7")}</table>'
    )
    rows = extract(page, layout="caption")
    assert [(r.team, r.team_code, r.period, r.pts) for r in rows] == [("Toronto Raptors ", None, "FG", "7")]
    pages = frame([("nba", "f", page.encode())], "league string, file_name string, content binary")
    assert [r.team for r in headline_teams(pages).collect()] == ["Toronto Raptors "]


def test_captions_and_crews(values):
    captions = ["Atlanta Dream (0-1) Table", "Atlanta Dream", " X  (10-12)  Table ", None, "Table"]
    assert values(team_name(F.col("x")), captions) == ["Atlanta Dream", "Atlanta Dream", "X", "", ""]
    assert values(officials_crew(F.col("x")), ["Officials: A , B,, C", "Officials:", None]) == [["A", "B", "C"], [], []]


def test_schedule_links_are_own_distinct_and_sorted(frame):
    pages = [
        ("<a href='/wnba/boxscores/202505170NYL.html'>x</a><a href='/wnba/players/a.html'>p</a>",),
        ("<a href='/wnba/boxscores/202505160WAS.html'>x</a><a href='/boxscores/202505160TOR.html'>o</a>",),
        ("<a href='/wnba/boxscores/202505170NYL.html'>x</a>",),
    ]
    found = discover_box_scores(frame([(p.encode(),) for (p,) in pages], "content binary"), WNBA)
    assert [r.link for r in found.collect()] == ["/wnba/boxscores/202505160WAS.html", "/wnba/boxscores/202505170NYL.html"]


def test_play_by_play_validity(frame):
    pages = [('<table id="pbp">',), ('<h2>Play-By-Play</h2><table id="other">',)]
    marked = mark_play_by_play(frame([(p.encode(),) for (p,) in pages], "content binary"))
    assert sorted(r.valid for r in marked.collect()) == [False, True]


class _Plain(HTMLParser):
    """The standard parser, as a check on tags, links and table text."""

    def __init__(self):
        super().__init__()
        self.links, self.tables = [], 0

    def handle_starttag(self, tag, attrs):
        if tag == "a" and dict(attrs).get("href") is not None:
            self.links.append(dict(attrs)["href"])
        self.tables += tag == "table"


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01"])
def test_reader_agrees_with_the_standard_parser(spark, folder):
    pages = [r.html for r in spark.read.parquet(f"{folder}/pages.parquet").select("html").collect()]
    for page in pages:
        plain = _Plain()
        plain.feed(page)
        mine = read_page(page)
        assert (mine["links"], len(mine["tables"])) == (plain.links, plain.tables)


def test_reader_on_odd_markup():
    page = read_page(
        "<table id=t><caption>A &amp; B<br/>C</caption><tr><th>h</th><td title='a > b'>1 &lt; 2</td><td>un<b>closed</td></tr>"
        "<!-- <tr><td>no</td></tr> --><script>'<tr><td>no</td></tr>'</script></table></p><a HREF=x>y"
    )
    assert page["tables"] == [{
        "table_id": "t", "classes": [], "caption": "A & BC",
        "rows": [{
            "has_link": False, "link_text": None, "link_target": None, "has_head": True, "heads": ["h"],
            "cells": ["1 < 2", "unclosed"],
        }],
    }]
    assert page["links"] == ["x"] and read_page(b"\xff<h2>a</h2>")["headings"] == ["a"]


def test_tables_and_rows_that_end_out_of_order():
    """Cells belong to the innermost open row, whatever was closed with what; lookups do not walk the open elements."""
    page = _Page()
    assert set(page.within) == {"table", "tr", "th"} and page.inside("tr") is None
    read = read_page("<table id=a><tr><th>x<table id=b><tr><td>1</tr><tr><td>2</table><td>3</th></table><td>4")
    assert [(t["table_id"], [(r["heads"], r["cells"]) for r in t["rows"]]) for t in read["tables"]] == [
        ("a", [(["x123"], ["3"])]), ("b", [([], ["1"]), ([], ["2"])])]


def test_bare_rows_are_one_token_and_read_as_tag_by_tag():
    """A player's row is cut out whole; however tags are put together, the records are those of single tags."""
    row = player("a01w", *map(str, range(20)))
    assert len(page_parser._TOKENS.split(row * 3)) == 1 + 3 * 8
    read = lambda parts: {k: v for k, v in vars(page_parser._read(parts)).items() if k in ("tables", "links", "headings", "officials")}
    atoms = [
        "<table>", "<table class='a b' id=\"x&amp;y\">", "</table>", "<tr>", "<tr x=1>", "</tr>", "<tr/>", "<td>", "</td>", "<td/>", "<td a='>'>", "<TD>",
        "<th>", "</th>", "<a href=x>", "<a href='y&lt;'>", "<a>", "</a>", "<a/>", "<caption>", "</caption>", "<h2>", "</h2>", "<div>", "</div>", "<br>",
        "</br>", "<strong>Officials:&nbsp;</strong>", "<script>", "</script>", "<style a='", "</style >", "<!--", "-->", '"', "'", " ", "t", "&amp;", ">", "<",
        "<td>1</td>", "<td>&gt;</td><td></td>", "<th>h</th>", "<tr><td>2</td></tr>", "<tr><th><a href='p'>P&amp;</a></th><td>3</td></tr>", player("q", "1"),
    ]
    chance = random.Random(4)
    for _ in range(5000):
        text = "".join(chance.choices(atoms, k=chance.choice([3, 8, 20])))
        assert read(page_parser._TOKENS.split(text)) == read(page_parser._one_by_one(text)), text
    odd = "<div><script\"a \"b><td>1</td></script><td>2</td><h2>h</h2>"
    assert page_parser._read(page_parser._TOKENS.split(odd)) is None and read_page(odd)["headings"] == ["h"]
