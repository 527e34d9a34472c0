import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from boxlake.operators.occupancy import equal_slices, window_occupancy
from boxlake.plans.status import fold_artifacts, fold_pulls, freshness, pull_totals, status
from boxlake.schemas import ARTIFACT_LOG, PULL_LOG
from boxlake.streaming.status import follow_pulls, pull_state

START = datetime(2026, 1, 1)


def at(seconds):
    return START + timedelta(seconds=seconds)


def audit(frame, log, **options):
    rows = window_occupancy(frame(log, "host string, ts timestamp"), **options).collect()
    origin = int((START - datetime(1970, 1, 1)).total_seconds()) * 1_000_000
    return {((r.host if "host" in r else None), (r.ts_us - origin) / 1e6): r for r in rows}


def test_a_request_one_window_old_has_expired(frame):
    seen = audit(frame, [("a", at(s)) for s in (0, 3, 6, 10, 13)], window_seconds=10, capacity=3, slices=4)
    assert [seen[None, s].in_window for s in (0, 3, 6, 10, 13)] == [1, 2, 3, 3, 3]
    assert [seen[None, s].gap_us for s in (0, 3, 6, 10, 13)] == [None, 3_000_000, 3_000_000, 4_000_000, 3_000_000]
    assert not any(r.over_capacity or r.too_close for r in seen.values())
    assert [seen[None, s].wait_full_us for s in (0, 6, 10)] == [0, 4_000_000, 3_000_000]
    assert [seen[None, s].wait_next_us for s in (0, 6)] == [3_000_000, 4_000_000]


def test_one_budget_for_all_hosts_unless_asked(frame):
    log = [("a", at(0)), ("b", at(1)), ("a", at(2))]
    shared = audit(frame, log, window_seconds=10, capacity=2)
    assert shared[None, 2].in_window == 3 and shared[None, 2].over_capacity and shared[None, 2].too_close
    own = audit(frame, log, by=("host",), window_seconds=10, capacity=2)
    assert own["a", 2].in_window == 2 and not own["a", 2].over_capacity


def test_requests_of_one_instant_count_together(frame):
    seen = audit(frame, [("a", at(0))] * 3 + [("a", at(5))], window_seconds=10, capacity=2)
    assert (seen[None, 0].requests, seen[None, 0].in_window, seen[None, 0].gap_us, seen[None, 0].too_close) == (3, 3, 0, True)


@pytest.mark.parametrize("slices", [1, 2, 30, None])
def test_against_brute_force_with_a_hot_host(frame, slices):
    draw = random.Random(11)
    log = [("hot" if draw.random() < 0.5 else draw.choice("xyz"), at(draw.randint(0, 4000) / 10)) for _ in range(1500)]
    seen = audit(frame, log, by=("host",), window_seconds=12, capacity=4, min_gap_seconds=2, slices=slices)
    assert sum(r.requests for r in seen.values()) == len(log)
    for (host, second), row in seen.items():
        now = round(second * 10)
        mine = [round((t - START).total_seconds() * 10) for h, t in log if h == host]
        inside = [t for t in mine if now - 120 < t <= now]
        before = [t for t in mine if t < now]
        assert row.in_window == len(inside)
        several = mine.count(now) > 1
        assert row.gap_us == (0 if several else (now - max(before)) * 100_000 if before else None)
        assert row.wait_full_us == ((min(inside) + 120 - now) * 100_000 if len(inside) >= 4 else 0)


def pull(league, dataset, seconds, event, new=None, cached=None, error=None):
    return (league, dataset, at(seconds), seconds, event, new, cached, error)


def test_pull_state_per_field(frame):
    log = frame(
        [
            pull("wnba", "pbp", 0, "started"), pull("wnba", "pbp", 1, "finished", 4, 0), pull("wnba", "pbp", 2, "failed", error="404"),
            pull("nba", "pbp", 3, "failed", error="x"), pull("nba", "pbp", 4, "started"), pull("nba", "schedules", 5, "failed", error="y"),
        ], PULL_LOG,
    )
    state = {(r.league, r.dataset): r for r in fold_pulls(log).collect()}
    failed = state["wnba", "pbp"]
    assert (failed.files_new, failed.files_cached, failed.last_error) == (4, 0, "2026-01-01T00:00:02.000000 404")
    assert state["nba", "pbp"].last_error == "" and state["nba", "pbp"].files_new is None
    assert state["nba", "schedules"].last_error.endswith(" y") and state["nba", "schedules"].last_started is None


def test_status_report(spark, frame):
    pulls = frame([pull("wnba", "pbp", 1, "finished", 4, 0)], PULL_LOG)
    runs = frame([("wnba", "agg", at(5), 0, 1.5, 10, 2), ("wnba", "agg", at(9), 1, 2.5, 20, 3)], ARTIFACT_LOG)
    newest = frame([("wnba", at(20)), ("nba", at(1))], "league string, newest_raw_file timestamp")
    rows = {(r.league, r.section): r for r in status(spark, pulls, runs, newest).collect()}
    assert set(rows) == {("wnba", "pull"), ("wnba", "artifact"), ("nba", None)}
    assert rows["wnba", "artifact"].rows_out == 20 and rows["wnba", "artifact"].stale
    assert rows["nba", None].stale is False and rows["wnba", "pull"].files_new == 4
    assert fold_artifacts(runs).first().duration_s == 2.5


def test_freshness_needs_both_times(frame):
    newest = frame([("a", at(2)), ("b", at(2)), ("c", at(2))], "league string, newest_raw_file timestamp")
    runs = frame([("a", at(1)), ("b", at(3)), ("d", at(1))], "league string, last_run timestamp")
    assert {r.league: r.stale for r in freshness(newest, runs).collect()} == {"a": True, "b": False, "c": False, "d": False}


def test_totals(frame):
    log = frame([("a", 2025, 1, 2, 0), ("a", 2025, 3, None, 1), ("a", 2026, 0, 0, 5)], "league string, season int, new long, cached long, failed long")
    assert {tuple(r) for r in pull_totals(log).collect()} == {("a", 2025, 4, 2, 1), ("a", 2026, 0, 0, 5)}
    assert pull_totals(log, ()).first().failed == 6


def test_a_rush_within_a_minute_is_spread_over_tasks(frame):
    """All but two of the distinct instants fall in one minute; each of eight tasks gets at most twice the mean."""
    draw = random.Random(4)
    times = [0, 10**12, *(draw.randrange(60_000_000) + 5 * 10**11 for _ in range(8000))]
    moves = frame([(t,) for t in times], "t long")
    sliced = moves.withColumn("slice", equal_slices(moves, 128))
    sizes = [r["count"] for r in sliced.groupBy("slice").count().collect()]
    assert len(sizes) > 120 and max(sizes) < 2 * len(times) / 128
    tasks = [r["count"] for r in sliced.repartition(8, "slice").groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert max(tasks) < 2 * len(times) / 8
    ends = [(r.low, r.high) for r in sliced.groupBy("slice").agg(F.min("t").alias("low"), F.max("t").alias("high")).orderBy("slice").collect()]
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:], strict=False))


@pytest.mark.parametrize("seed, files", [(1, 1), (2, 3), (3, 50)])
def test_a_running_state_equals_the_fold_for_any_order(spark, frame, tmp_path, seed, files):
    """Rows come early, late and twice, in batches of any size, over two runs; ties in time go by seq."""
    draw, rows = random.Random(seed), []
    for seq in range(200):
        event = draw.choice(["started", "finished", "failed"])
        new, cached = (draw.randrange(9), draw.randrange(9)) if event == "finished" else (None, None)
        rows.append((draw.choice(["nba", "wnba"]), draw.choice(["pbp", "schedules"]), at(draw.randrange(60)), seq, event, new, cached, f"e{seq}" if event == "failed" else None))
    want = sorted(map(tuple, fold_pulls(frame(rows, PULL_LOG)).collect()))
    arriving = rows + draw.sample(rows, 40)
    draw.shuffle(arriving)
    log, root = str(tmp_path / "log"), str(tmp_path / "out")
    assert pull_state(spark, root).collect() == []
    for part in (arriving[:70], arriving[70:]):
        frame(part, PULL_LOG).repartition(4).write.mode("append").parquet(log)
        follow_pulls(spark.readStream.schema(PULL_LOG).option("maxFilesPerTrigger", files).parquet(log), root)
    assert sorted(map(tuple, pull_state(spark, root).collect())) == want
