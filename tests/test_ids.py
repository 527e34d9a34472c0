import random

import pytest
from pyspark.sql import functions as F

from boxlake.leagues import league
from boxlake.operators.identity import append_ids_first_seen, append_ids_sorted, check_size, crew_members, unseen_keys
from boxlake.operators import numbering
from boxlake.operators.numbering import block_of, key_bounds, number_rows
from boxlake.operators.tally import keep_last, modal_value, top_values, union_all, value_counts, value_shares
from boxlake.plans.box_scores import check_players
from boxlake.plans.dimensions import official_map, player_map, reverse_team_map, team_map, team_map_from_file_names

FACT = "file_name string, table_pos int, row_pos int, player_id string"


def as_dict(ids):
    return {r.key: r.id for r in ids.collect()}


@pytest.mark.parametrize("blocks, tree", [(1, 256), (2, 0), (3, 256), (8, 0), (30, 0), (30, 256), (101, 0)])
def test_numbers_follow_the_order_without_gaps(spark, frame, monkeypatch, blocks, tree):
    monkeypatch.setattr(numbering, "_TREE", tree)
    words = [*random.Random(3).sample([f"w{i:05}" for i in range(20000)], 3000), None, ""]
    rows = frame([(w, i % 7) for i, w in enumerate(words)], "w string, i int").repartition(16)
    spark.conf.set("spark.sql.shuffle.partitions", str(blocks))
    try:
        by_word = {r.w: r.n for r in number_rows(rows, ["w"], "n").collect()}
        by_two = {(r.i, r.w): r.n for r in number_rows(rows, ["i", "w"], "n").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    order = sorted(words, key=lambda w: (w is not None, w or ""))
    assert by_word == {w: n for n, w in enumerate(order)}
    assert by_two == {k: n for n, k in enumerate(sorted(((i % 7, w) for i, w in enumerate(words)), key=lambda k: (k[0], k[1] is not None, k[1] or "")))}


def test_blocks_are_about_equal_and_follow_from_the_keys(spark, frame):
    rows = frame([(f"{i * i:09}",) for i in range(4000)], "w string")
    bounds = key_bounds(rows, ["w"], 8)
    assert bounds == key_bounds(rows.repartition(5), ["w"], 8) and len(bounds) == 7
    sizes = [r["count"] for r in rows.groupBy(block_of(rows, ["w"], bounds).alias("b")).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 4000 / 8


def test_planning_takes_only_a_sample(spark, frame):
    rows, context = frame([(i,) for i in range(500)], "i long"), spark.sparkContext
    context.setJobGroup("numbering", "planning")
    numbered = number_rows(rows, ["i"], "n")
    jobs = len(context.statusTracker().getJobIdsForGroup("numbering"))
    context.setJobGroup("others", "")
    assert jobs <= 2 and numbered.where("i <> n").count() == 0
    assert "Checkpoint" not in numbered._jdf.queryExecution().toString()


def test_numbering_nothing(frame):
    assert number_rows(frame([], "w string"), ["w"], "n").collect() == []


def test_player_ids_never_move(frame):
    known = frame([("player-b", 0), ("retired-player", 1)], "key string, id long")
    fact = frame(
        [("f1", 0, 0, "player-a"), ("f1", 0, 1, "player-b"), ("f0", 1, 0, "player-c"), ("f2", 0, 0, "player-a"), ("f0", 0, 0, None)],
        FACT,
    )
    ids = player_map(fact, known)
    assert as_dict(ids) == {"player-b": 0, "retired-player": 1, "player-c": 2, "player-a": 3}
    assert as_dict(player_map(fact, ids)) == as_dict(ids)


def test_first_ids_start_at_zero(frame):
    empty = frame([], "key string, id long")
    rows = frame([(c, i) for i, c in enumerate("cabca")], "k string, pos int")
    assert as_dict(append_ids_first_seen(empty, rows, "k", ["pos"])) == {"c": 0, "a": 1, "b": 2}
    assert as_dict(append_ids_sorted(empty, rows, "k")) == {"a": 0, "b": 1, "c": 2}


def test_official_ids_are_sorted_and_appended(frame):
    fact = frame([(["Ref B", " Ref A "],), (["Ref C", "", " "],), (None,), ([],)], "officials array<string>")
    assert as_dict(official_map(fact, frame([], "key string, id long"))) == {"Ref A": 0, "Ref B": 1, "Ref C": 2}
    assert as_dict(official_map(fact, frame([("Ref B", 7)], "key string, id long"))) == {"Ref B": 7, "Ref A": 8, "Ref C": 9}
    assert crew_members(fact, F.col("officials")).count() == 3


def test_ids_when_one_key_holds_most_rows(frame):
    draw = random.Random(5)
    rows = [("hot" if draw.random() < 0.6 else f"k{draw.randint(0, 400)}", i) for i in range(4000)]
    order = {}
    for key, _ in rows:
        order.setdefault(key, len(order))
    empty = frame([], "key string, id long")
    assert as_dict(append_ids_first_seen(empty, frame(rows, "k string, pos int").repartition(8), "k", ["pos"])) == order


def test_new_keys(frame):
    keys, known = frame([("a",), ("b",), ("b",), (None,)], "k string"), frame([("a",)], "k string")
    assert [r.k for r in unseen_keys(keys, known, "k").collect()] == ["b"]


def test_dimension_size_is_guarded(frame):
    table = frame([("a", 0)], "key string, id long")
    assert check_size(table, 1, "player map") == 1
    with pytest.raises(ValueError, match="player map holds 1 rows, expected 2"):
        check_size(table, 2, "player map")
    assert check_players(table, league("wnba")) == 1
    with pytest.raises(ValueError, match="nba player map holds 1 rows, expected 1442"):
        check_players(table, league("nba"))


def test_team_map_takes_the_commonest_spelling(frame):
    fact = frame(
        [("ATL", "Atlanta Dream"), ("ATL ", " Atlanta Dream "), ("ATL", "Dream"), ("NYL", "New York Liberty"), (None, "x"),
         ("SEA", None), ("TIE", "b"), ("TIE", "a")], "team_code string, team string",
    )
    assert [tuple(r) for r in team_map(fact).collect()] == [
        ("ATL", "Atlanta Dream"), ("NYL", "New York Liberty"), ("TIE", "a")
    ]


def test_team_map_from_home_codes(frame):
    rows = [
        ("boxscores_202105160BOS.html", "Boston Celtics"), ("boxscores_202105160BOS.html", "Toronto Raptors"),
        ("boxscores_202105180BOS.html", "Boston Celtics "), ("boxscores_202105180BOS.html", None),
    ]
    found = team_map_from_file_names(frame(rows, "file_name string, team string"), league("nba"))
    assert [tuple(r) for r in found.collect()] == [("BOS", "Boston Celtics")]
    nameless = frame([("boxscores_202105160BOS.html", None)], "file_name string, team string")
    with pytest.raises(Exception, match="no team name for BOS"):
        team_map_from_file_names(nameless, league("nba")).collect()


def test_last_code_wins_for_a_repeated_name(frame):
    teams = frame([("A", "Same "), ("B", " Same"), ("C", "Other")], "code string, name string")
    assert {(r.team_name, r.team) for r in reverse_team_map(teams).collect()} == {("Same", "B"), ("Other", "C")}


def test_counts_and_shares(frame):
    rows = frame([(v,) for v in ["a"] * 5 + ["b"] * 2 + ["c"] * 2 + [None]], "v string")
    assert [tuple(r) for r in value_shares(rows, "v").collect()] == [("a", 5, 0.5), ("b", 2, 0.2), ("c", 2, 0.2), (None, 1, 0.1)]
    assert [tuple(r) for r in value_counts(rows, "v").collect()][-1] == (None, 1)
    assert [tuple(r) for r in top_values(rows, "v", 2).collect()] == [("a", 5), ("b", 2)]
    pairs = frame([(1, "x"), (1, "y"), (1, "y"), (2, "q"), (2, "p")], "k int, v string")
    assert {tuple(r) for r in modal_value(pairs, "k", "v").collect()} == {(1, "y"), (2, "p")}


def test_keep_last_and_union(frame):
    rows = frame([(1, 1, "a"), (1, 3, None), (1, 2, "b"), (2, 0, "z")], "k int, t int, v string")
    assert {tuple(r) for r in keep_last(rows, ["k"], [F.col("t")]).collect()} == {(1, 3, None), (2, 0, "z")}
    both = union_all(rows, frame([(9, "extra")], "k int, w string"))
    assert both.columns == ["k", "t", "v", "w"] and both.count() == 5
