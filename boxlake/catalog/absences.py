"""Absence pipeline on orders taken as player-games, and the rules over whole documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from boxlake.catalog.registry import dealt, query, table
from boxlake.fixed_values import ABSENCE_RULES
from boxlake.operators.tally import top_values, union_all
from boxlake.plans.absences import (
    absence_table,
    absences_by_season,
    archive_profile,
    blank_reasons,
    common_reasons,
    normalize,
    reason_shares,
    sort_absences,
    status_shares,
    unclassified_summary,
    unclassified_vocabulary,
    with_classes,
)
from boxlake.sources.season_archive import reindex

_REASONS = """CASE o_orderpriority
  WHEN '1-URGENT' THEN 'Left ankle sprain ' || o_orderstatus WHEN '2-HIGH' THEN 'Coach''s decision'
  WHEN '3-MEDIUM' THEN 'Did not dress - illness' WHEN '4-NOT SPECIFIED' THEN NULL
  ELSE 'Something new ' || substr(CAST(o_custkey AS STRING), 1, 1) END"""

_ARCHIVE = f"""
SELECT CAST(o_orderkey AS STRING) AS game_id, CAST(year(o_orderdate) AS INTEGER) AS season,
       CAST(o_orderdate AS DATE) AS game_date, CAST(o_custkey AS STRING) AS athlete_id,
       'Player ' || CAST(o_custkey AS STRING) AS athlete_display_name,
       CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false ELSE o_totalprice > 400000 END AS flag,
       {_REASONS} AS text, 'player_box_' || CAST(year(o_orderdate) AS STRING) || '.parquet' AS source_file
FROM orders
"""


def _case(text: str, pick: int) -> str:
    """The rules as SQL for the oracle's regex engine, whose word boundaries are ASCII only."""
    def boundary(pattern: str) -> str:
        parts = []
        for word in pattern.split("|"):
            if word.startswith(r"\b"):
                word = r"(^|[^\p{L}\p{N}_])" + word[2:]
            if word.endswith(r"\b"):
                word = word[:-2] + r"($|[^\p{L}\p{N}_])"
            parts.append(word)
        return "|".join(parts).replace("'", "''")

    branches = "\n".join(
        f"WHEN regexp_matches(upper(coalesce({text}, '')), '{boundary(rule[2])}') THEN '{rule[pick]}'"
        for rule in ABSENCE_RULES
    )
    return f"CASE {branches} ELSE 'unknown' END"


_CLASSED = f"SELECT *, {_case('text', 0)} AS status, {_case('text', 1)} AS reason FROM ({_ARCHIVE}) WHERE flag"


def archive_rows(spark, folder):
    """Player-games; the flag is null where the early seasons had none."""
    orders = table(spark, folder, "orders")
    orders.createOrReplaceTempView("boxlake_orders")
    raw = spark.sql(_ARCHIVE.replace("FROM orders", "FROM boxlake_orders"))
    flag = F.when(F.col("flag"), True)
    return raw.withColumns({"did_not_play": flag, "reason": F.col("text")})


def archive(spark, folder):
    return normalize(archive_rows(spark, folder), keep=("source_file",))


@query(f"SELECT doc_id, {_case('text', 0)} AS status, {_case('text', 1)} AS category FROM documents")
def classify_first_match(spark, folder):
    return with_classes(dealt(spark, folder, "documents", "doc_id", "text"), "text").drop("text")


@query(f"""
SELECT athlete_display_name AS player_name, athlete_id AS player_id, game_date AS date, status, reason,
       text AS value, source_file FROM ({_CLASSED})
""")
def absence_report(spark, folder):
    return sort_absences(absence_table(archive(spark, folder)))


@query(f"""
SELECT athlete_display_name AS player_name, athlete_id AS player_id, game_date AS date, status, reason,
       text AS value, source_file FROM ({_CLASSED})
""")
def absence_report_by_row(spark, folder):
    return sort_absences(absence_table(archive(spark, folder)))


@query(f"""
SELECT status, count(*) AS count, round(count(*) / (SELECT count(*) FROM ({_CLASSED})), 6) AS share
FROM ({_CLASSED}) GROUP BY status
""")
def status_share(spark, folder):
    return status_shares(absence_table(archive(spark, folder)))


@query(f"""
SELECT reason, count(*) AS count, round(count(*) / (SELECT count(*) FROM ({_CLASSED})), 6) AS share
FROM ({_CLASSED}) GROUP BY reason
""")
def classification_share(spark, folder):
    return reason_shares(absence_table(archive(spark, folder)))


@query(f"SELECT text AS value, count(*) AS count FROM ({_CLASSED}) WHERE status = 'unknown' GROUP BY text")
def unclassified_vocab(spark, folder):
    return unclassified_vocabulary(absence_table(archive(spark, folder)))


@query(f"""
SELECT count(*) AS unclassified_rows, count(DISTINCT text) AS distinct_values
FROM ({_CLASSED}) WHERE status = 'unknown'
""")
def unclassified_counts(spark, folder):
    return unclassified_summary(absence_table(archive(spark, folder)))


@query(f"""
SELECT count(*) AS player_games, count(DISTINCT game_id) AS games, count(*) FILTER (flag) AS dnp_rows,
       round(count(*) FILTER (flag) / count(*), 6) AS dnp_share,
       count(*) FILTER (flag AND text IS NULL) AS dnp_without_reason
FROM ({_ARCHIVE})
""")
def season_archive_profile(spark, folder):
    return archive_profile(archive(spark, folder))


@query(f"SELECT season, count(*) AS dnp_rows FROM ({_ARCHIVE}) WHERE flag GROUP BY season")
def dnp_by_season(spark, folder):
    return absences_by_season(archive(spark, folder))


@query(f"""
SELECT text AS reason, count(*) AS count FROM ({_ARCHIVE}) WHERE flag AND text IS NOT NULL
GROUP BY text ORDER BY count(*) DESC, text LIMIT 10
""")
def frequent_reasons(spark, folder):
    return common_reasons(archive(spark, folder))


@query("""
SELECT p_name, count(*) AS count FROM part GROUP BY p_name ORDER BY count(*) DESC, p_name LIMIT 10
""")
def top_part_names(spark, folder):
    return top_values(table(spark, folder, "part"), "p_name", 10)


@query("""
SELECT event_id, user_id, event_type, CASE WHEN event_type IN ('click', 'view') THEN NULL ELSE props END AS props,
       CAST(NULL AS DOUBLE) AS score
FROM events
""")
def reindex_union(spark, folder):
    """Two shapes of one table, the earlier one without props, brought to a common shape."""
    wanted = [("event_id", "long"), ("user_id", "long"), ("event_type", "string"), ("props", "string"), ("score", "double")]
    events, early = table(spark, folder, "events"), F.col("event_type").isin("click", "view")
    return union_all(reindex(events.where(early).drop("props"), wanted), reindex(events.where(~early), wanted))


@query("""
SELECT event_id, coalesce(event_type = 'error', false) AS missed, CASE WHEN event_type = 'error' THEN props END AS note
FROM events
""")
def conditional_blank(spark, folder):
    missed = F.when(F.col("event_type") == "error", True).when(F.col("event_type") == "view", False)
    events = table(spark, folder, "events").select("event_id", missed.alias("missed"), F.col("props").alias("note"))
    return blank_reasons(events, "missed", "note")
