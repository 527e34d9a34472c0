"""Request, pull and artifact logs, on events."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from boxlake.catalog.games import MAIN, _FILES, order_files
from boxlake.catalog.registry import query, table
from boxlake.functions.seasons import season_label
from boxlake.operators.occupancy import window_occupancy
from boxlake.operators.reconcile import refresh_list
from boxlake.plans.backfill import expected_pages, pages_to_fetch, pull_counts
from boxlake.plans.status import fold_artifacts, fold_pulls, freshness, pull_totals, schedule_targets
from boxlake.session import shared_dir
from boxlake.streaming.status import follow_pulls, pull_state


def _window_sql(by: str, seconds: int, capacity: int, gap: int) -> str:
    part, cols, group = (f"PARTITION BY {by} ", f"{by}, ", f"{by}, ") if by else ("", "", "")
    width = seconds * 1_000_000
    return f"""
WITH hits AS (SELECT {cols}epoch_us(ts) AS ts_us, count(*) AS requests FROM events GROUP BY {group}epoch_us(ts)),
frames AS (
  SELECT *, sum(requests) OVER f AS in_window, min(ts_us) OVER f AS oldest, lag(ts_us) OVER o AS before
  FROM hits
  WINDOW f AS ({part}ORDER BY ts_us RANGE BETWEEN {width - 1} PRECEDING AND CURRENT ROW),
         o AS ({part}ORDER BY ts_us)),
state AS (
  SELECT *, CASE WHEN requests > 1 THEN 0 ELSE ts_us - before END AS gap_us,
         CASE WHEN in_window >= {capacity} THEN oldest + {width} - ts_us ELSE 0 END AS wait_full_us
  FROM frames)
SELECT {cols}ts_us, requests, CAST(in_window AS BIGINT) AS in_window, gap_us, wait_full_us,
       CASE WHEN in_window >= {capacity} THEN wait_full_us ELSE {gap * 1_000_000} END AS wait_next_us,
       in_window > {capacity} AS over_capacity, coalesce(gap_us < {gap * 1_000_000}, false) AS too_close
FROM state
"""


@query(_window_sql("user_id", 86_400, 3, 7_200))
def rate_window(spark, folder):
    """One budget per user: three requests a day, two hours apart."""
    return window_occupancy(
        table(spark, folder, "events"), by=("user_id",), window_seconds=86_400, capacity=3,
        min_gap_seconds=7_200,
    )


@query(_window_sql("", 1_800, 12, 60))
def rate_window_shared(spark, folder):
    """One budget for all requests."""
    return window_occupancy(
        table(spark, folder, "events"), window_seconds=1_800, capacity=12, min_gap_seconds=60
    )


_STAMP = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')"


def pull_log(spark, folder):
    kind = F.col("event_type")
    return table(spark, folder, "events").select(
        F.col("user_id").alias("league"), F.lit("boxscores").alias("dataset"), "ts", F.col("event_id").alias("seq"),
        F.when(kind == "click", "started").when(kind == "view", "finished").when(kind == "error", "failed").alias("event"),
        F.floor("value").alias("files_new"), F.floor(F.col("value") * 10).alias("files_cached"),
        F.col("props").alias("error"),
    )


_PULL_STATE = f"""
SELECT user_id AS league, 'boxscores' AS dataset,
       max({_STAMP}) FILTER (event_type = 'click') AS last_started,
       max({_STAMP}) FILTER (event_type = 'view') AS last_finished,
       arg_max(CASE event_type WHEN 'click' THEN '' ELSE {_STAMP} || ' ' || props END, event_id)
         FILTER (event_type IN ('click', 'error')) AS last_error,
       arg_max(CAST(floor(value) AS BIGINT), event_id) FILTER (event_type = 'view') AS files_new,
       arg_max(CAST(floor(value * 10) AS BIGINT), event_id) FILTER (event_type = 'view') AS files_cached
FROM events GROUP BY user_id
"""


@query(_PULL_STATE)
def status_fold(spark, folder):
    return fold_pulls(pull_log(spark, folder))


@query(_PULL_STATE)
def status_stream(spark, folder):
    """The same state from a stream whose files mix early and late rows, some rows twice; it is stopped and goes on."""
    log, root = pull_log(spark, folder), f"{shared_dir(spark)}/status-{uuid.uuid4().hex}"
    part = F.pmod(F.xxhash64("seq"), F.lit(6))
    for chosen in (part < 2, part >= 2, part == 3):
        log.where(chosen).repartition(4, "seq").write.mode("append").parquet(f"{root}/log")
        follow_pulls(spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/log"), f"{root}/out")
    return pull_state(spark, f"{root}/out")


@query("""
SELECT event_type AS league, user_id AS artifact, epoch_us(max(ts)) AS last_run_us, arg_max(value, event_id) AS duration_s
FROM events GROUP BY ALL
""")
def artifact_state(spark, folder):
    log = table(spark, folder, "events").select(
        F.col("event_type").alias("league"), F.col("user_id").alias("artifact"), "ts", F.col("event_id").alias("seq"),
        F.col("value").alias("duration_s"),
    )
    return fold_artifacts(log).select(
        "league", "artifact", F.unix_micros(F.col("last_run").cast("timestamp")).alias("last_run_us"), "duration_s"
    )


@query("""
SELECT event_type AS league, epoch_us(max(ts)) AS newest_us, epoch_us(max(ts) FILTER (value > 50)) AS run_us,
       coalesce(max(ts) > max(ts) FILTER (value > 50), false) AS stale
FROM events GROUP BY event_type
""")
def stale_flag(spark, folder):
    events = table(spark, folder, "events").withColumnRenamed("event_type", "league")
    newest = events.groupBy("league").agg(F.max("ts").alias("newest_raw_file"))
    runs = events.where("value > 50").groupBy("league").agg(F.max("ts").alias("last_run"))
    return freshness(newest, runs).select(
        "league", F.unix_micros(F.col("newest_raw_file").cast("timestamp")).alias("newest_us"),
        F.unix_micros(F.col("last_run").cast("timestamp")).alias("run_us"), "stale",
    )


@query("""
WITH inventory AS (SELECT user_id AS file_name, max(ts) AS mtime FROM events GROUP BY user_id)
SELECT c_custkey AS file_name, CASE c_mktsegment WHEN 'BUILDING' THEN 'box_score' ELSE 'schedule' END AS kind,
       c_nationkey AS season, CASE WHEN mtime IS NULL THEN 'missing' ELSE 'expired' END AS cause
FROM customer LEFT JOIN inventory ON c_custkey = file_name
WHERE mtime IS NULL OR (c_mktsegment <> 'BUILDING' AND c_nationkey = 3
                        AND mtime < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 21600 SECOND)
""")
def refresh_due(spark, folder):
    expected = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("file_name"),
        F.when(F.col("c_mktsegment") == "BUILDING", "box_score").otherwise("schedule").alias("kind"),
        F.col("c_nationkey").alias("season"),
    )
    inventory = table(spark, folder, "events").select(
        F.col("user_id").alias("file_name"), F.col("ts").alias("modification_time")
    )
    return refresh_list(expected, inventory, F.lit("2024-01-31 00:00:00"), F.lit(3))


@query(f"""
WITH games AS (SELECT DISTINCT replace(file_name, '.html', '') AS game, year(o_orderdate) AS y, month(o_orderdate) AS m FROM ({_FILES})),
held AS (SELECT DISTINCT replace(file_name, '.html', '') AS game FROM ({_FILES}) WHERE o_orderstatus = 'F'),
seasons AS (SELECT DISTINCT CASE WHEN m >= 10 THEN y + 1 ELSE y END AS season FROM games),
targets AS (SELECT n_name, season FROM nation, seasons)
SELECT 'schedule' AS kind, count(*) AS expected, count(*) FILTER (season = 1998) AS due, count(*) FILTER (season <> 1998) AS held FROM targets
UNION ALL
SELECT 'box_score', count(*), count(*) FILTER (held.game IS NULL), count(held.game) FROM games LEFT JOIN held USING (game)
UNION ALL
SELECT 'play_by_play', count(*), count(*), 0 FROM games
""")
def backlog(spark, folder):
    """Pages to fetch: all schedule pages are held, those of 1998 are too old; some box scores are held."""
    files = order_files(spark, folder)
    links = files.select(F.concat(F.lit("/boxscores/"), F.substring("file_name", 11, 100)).alias("link"), "o_orderdate")
    seasons = files.select(season_label(F.col("o_orderdate"), MAIN.spans_years).alias("season")).distinct()
    teams = table(spark, folder, "nation").select(F.col("n_name").alias("code"))
    expected = expected_pages(schedule_targets(teams, seasons, MAIN), links, MAIN)
    then = F.lit("1998-01-01 00:00:00").cast("timestamp").alias("modification_time")
    inventory = files.where("o_orderstatus = 'F'").select("file_name", then).unionByName(
        expected.where("kind = 'schedule'").select("file_name", then)
    )
    due = pages_to_fetch(expected, inventory, F.lit("1998-01-02 00:00:00"), F.lit(1998))
    return pull_counts(expected, due)


@query("""
SELECT o_orderpriority AS league, CAST(year(o_orderdate) AS INTEGER) AS season, count(*) FILTER (o_orderstatus = 'F') AS new,
       count(*) FILTER (o_orderstatus = 'O') AS cached, count(*) FILTER (o_orderstatus = 'P') AS failed
FROM orders GROUP BY ALL
""")
def sweep_totals(spark, folder):
    state = F.col("o_orderstatus")
    log = table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("league"), F.year("o_orderdate").alias("season"),
        *[(state == code).cast("long").alias(name) for code, name in (("F", "new"), ("O", "cached"), ("P", "failed"))],
    )
    return pull_totals(log)
