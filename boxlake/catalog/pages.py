"""Pages: links and tests over the given pages, and box scores over pages written from orders."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from boxlake.catalog.games import MAIN, _FILES, with_file_name
from boxlake.catalog.registry import dealt, query, table
from boxlake.functions.markup import has_element
from boxlake.operators.pages import discover_links, extract_box_scores, headline_teams, page_links, parse_pages
from boxlake.session import shared_dir
from boxlake.streaming.ingest import drain, ingested_errors, ingested_fact, latest_map


@query(r"""
SELECT DISTINCT link FROM (SELECT unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS link FROM pages)
WHERE regexp_matches(link, '^/[A-Z]')
""")
def link_discovery(spark, folder):
    pages = table(spark, folder, "pages")
    return discover_links(pages, F.col("html"), lambda link: link.rlike("^/[A-Z]"))


_ALL_LINKS = r"""
SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS link,
       CAST(generate_subscripts(regexp_extract_all(html, '<a href="([^"]*)"', 1), 1) - 1 AS INTEGER) AS link_pos
FROM pages
"""


@query(_ALL_LINKS)
def link_rows(spark, folder):
    return page_links(table(spark, folder, "pages"), F.col("html")).select("page_id", "link", "link_pos")


@query(_ALL_LINKS)
def html_rows(spark, folder):
    """The same rows from the page parser."""
    parsed = parse_pages(dealt(spark, folder, "pages", "page_id", "html"), ["page_id"], "html", ["links"])
    return parsed.select("page_id", F.posexplode("page.links").alias("link_pos", "link"))


@query("""SELECT page_id, regexp_matches(html, '<html lang="fr"') AS valid FROM pages""")
def page_validity(spark, folder):
    return table(spark, folder, "pages").select("page_id", has_element(F.col("html"), "html", "lang", "fr").alias("valid"))


# --- Box-score pages written from orders ---------------------------------------------------
# Each page has a full-game table with a player, a heading row, an absent player and, for pending
# orders, a DNP row; further a quarter and an advanced table, and a crew. Urgent open orders get
# a page without a full-game table.

def box_score_pages(spark, folder, orders=None, broken: bool = False):
    orders = with_file_name(dealt(spark, folder, "orders")) if orders is None else orders

    def cat(*parts):
        return F.concat(*[p if not isinstance(p, str) or p in orders.columns else F.lit(p) for p in parts])

    unreadable = (F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "1-URGENT") & F.lit(broken)
    code = F.substring("file_name", 20, 3)
    head = "<tr><th>Starters</th><th>MP</th><th>FG</th><th>PTS</th></tr>"
    clock = cat(F.floor(F.col("o_totalprice") / 10000).cast("string"), ":", F.date_format("o_orderdate", "MM"))
    html = cat(
        "<html><head><title>Box</title><script>var t='</table>';</script></head><body>",
        "<div><strong>Officials:&nbsp;</strong><a href='/referees/a.html'>Ref ", F.col("o_orderpriority"),
        "</a>, Ref ", F.col("o_orderstatus"), ", </div>",
        '<table class="sortable stats_table" id="box-', code, F.when(unreadable, "-h1-basic").otherwise("-game-basic"),
        '"><caption>Team &amp; ', code, " (10-2) Table</caption><thead><tr><th></th><th colspan=3>Basic</th></tr>",
        head, "</thead><tbody>",
        "<tr><th><a href='/players/c/c", F.col("o_custkey").cast("string"), ".html'>Player ",
        F.col("o_custkey").cast("string"), "</a></th><td>", clock, "</td><td>1</td><td>",
        F.floor(F.col("o_totalprice") / 1000).cast("string"), "</td></tr>", head,
        "<tr><th><a href='/players/o/o", F.col("o_orderkey").cast("string"), ".html'>Bench</a></th>",
        "<td colspan=3>Did Not Play</td></tr>",
        F.when(F.col("o_orderstatus") == "P",
               "<tr><th><a href='/players/p/p1.html'>Pending</a></th><td>DNP</td><td></td><td></td></tr>").otherwise(""),
        "</tbody><tfoot><tr><th>Team Totals</th><td>240</td><td>1</td><td>2</td></tr></tfoot></table>",
        '<!-- <table class="stats_table" id="box-AAA-game-basic"></table> -->',
        '<table class="stats_table" id="box-', code, '-q1-basic"><tr><th>Q</th></tr></table>',
        '<table class="stats_table" id="', code, '-advanced"><tr><th>A</th></tr></table></body></html>',
    )
    return orders.select(F.lit(MAIN.key).alias("league"), "file_name", F.encode(html, "UTF-8").alias("content"))


_BROKEN = "(o_orderstatus = 'O' AND o_orderpriority = '1-URGENT')"


def _rows_sql(where: str = "true", files: str = _FILES) -> str:
    common = "'Team & ' || code AS team, code AS team_code, 'FG' AS period, 'Ref ' || o_orderpriority || '|Ref ' || o_orderstatus AS crew"
    return f"""
SELECT file_name, 0 AS table_pos, 0 AS row_pos, 'Player ' || o_custkey AS player, 'c' || o_custkey AS player_id,
       CAST(floor(o_totalprice / 10000) AS BIGINT) || ':' || strftime(o_orderdate, '%m') AS mp,
       CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS VARCHAR) AS pts, {common}
FROM ({files}) WHERE {where}
UNION ALL
SELECT file_name, 0, 2, 'Bench', 'o' || o_orderkey, 'Did Not Play', NULL, {common} FROM ({files}) WHERE {where}
UNION ALL
SELECT file_name, 0, 3, 'Pending', 'p1', 'DNP', 'DNP', {common} FROM ({files}) WHERE o_orderstatus = 'P' AND {where}
"""


def _flat(fact):
    return fact.withColumn("crew", F.concat_ws("|", "officials")).drop("officials", "league")


@query(_rows_sql())
def box_score_rows(spark, folder):
    return _flat(extract_box_scores(box_score_pages(spark, folder)))


@query(f"""
SELECT file_name, 'no full-game tables found' AS error, count(*) AS pages FROM ({_FILES}) WHERE {_BROKEN} GROUP BY file_name
""")
def box_score_errors(spark, folder):
    rows = extract_box_scores(box_score_pages(spark, folder, broken=True), mode="quarantine")
    return rows.where("error IS NOT NULL").groupBy("file_name", "error").agg(F.count("*").alias("pages"))


def supplier_pages(spark, folder):
    """Pages in the older wording: captions and headings name the team, table ids say nothing."""
    suppliers = table(spark, folder, "supplier")
    name, key = F.col("s_name"), F.col("s_suppkey").cast("string")
    html = F.concat(
        F.lit("<h2>"), name, F.lit(" Basic and Advanced Stats</h2><h2>Other</h2>"),
        F.lit('<table class="stats_table"><caption>'), name, F.lit(" Basic and Advanced Stats Table</caption>"),
        F.lit("<tr><th>x</th></tr><tr><th>Rk</th><th>MP</th><th>PTS</th></tr><tr><th><a href='/players/s/s"), key,
        F.lit(".html'>S</a></th><td>12:34</td><td>"), key, F.lit("</td></tr></table>"),
        F.lit('<table class="stats_table"><caption>'), name, F.lit(" (Q1) Table</caption></table>"),
    )
    return suppliers.select(
        F.lit(MAIN.key).alias("league"), F.concat(F.lit("s"), key, F.lit(".html")).alias("file_name"),
        html.cast("binary").alias("content"),
    )


@query("""
SELECT 's' || s_suppkey || '.html' AS file_name, s_name || ' ' AS team, CAST(NULL AS VARCHAR) AS team_code,
       's' || s_suppkey AS player_id, '12:34' AS mp, CAST(s_suppkey AS VARCHAR) AS pts
FROM supplier
""")
def caption_layout_rows(spark, folder):
    rows = extract_box_scores(supplier_pages(spark, folder), layout="caption")
    return rows.select("file_name", "team", "team_code", "player_id", "mp", "pts")


@query("SELECT 's' || s_suppkey || '.html' AS file_name, 0 AS position, s_name || ' ' AS team FROM supplier")
def heading_teams(spark, folder):
    return headline_teams(supplier_pages(spark, folder)).drop("league")


def _ingest(spark, folder) -> str:
    """Stream the orders table as pages into a fresh folder of the cluster's shared one."""
    root = f"{shared_dir(spark)}/ingest-{uuid.uuid4().hex}"
    schema = table(spark, folder, "orders").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "orders.parquet").parquet(folder)
    pages = box_score_pages(spark, folder, with_file_name(stream), broken=True)
    # one file holds all orders, so its pages are dealt out before they are parsed
    drain(pages, root, partitions=int(spark.conf.get("spark.sql.shuffle.partitions")))
    return root


@query(_rows_sql(f"NOT {_BROKEN}"))
def incremental_rows(spark, folder):
    return _flat(ingested_fact(spark, _ingest(spark, folder)))


@query(f"""
SELECT file_name, 'no full-game tables found' AS error, count(*) AS pages FROM ({_FILES}) WHERE {_BROKEN} GROUP BY file_name
""")
def incremental_errors(spark, folder):
    errors = ingested_errors(spark, _ingest(spark, folder))
    return errors.groupBy("file_name", "error").agg(F.count("*").alias("pages"))


@query(f"""
WITH members AS (
  SELECT DISTINCT unnest(['Ref ' || o_orderpriority, 'Ref ' || o_orderstatus]) AS key FROM orders WHERE NOT {_BROKEN})
SELECT key, row_number() OVER (ORDER BY key) - 1 AS id FROM members
""")
def incremental_official_ids(spark, folder):
    return latest_map(spark, _ingest(spark, folder), "official_map")
