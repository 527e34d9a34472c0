"""Run every query beside its oracle SQL: python tests/check_oracle.py [folder] [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if hasattr(value, "isoformat") or not isinstance(value, (int, str)):
        return str(value)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, folder, name, function, sql):
    """(seconds, rows, message); an empty message means equal."""
    started = time.time()
    result = function(spark, folder)
    names, got = rows_of(result.columns, result.collect())
    seconds = time.time() - started
    if not sql:
        return seconds, sum(got.values()), "no oracle"
    import duckdb

    con = duckdb.connect()
    for table in TABLES.split():
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    answer = con.execute(sql)
    want_names, want = rows_of([d[0] for d in answer.description], answer.fetchall())
    if names != want_names:
        return seconds, sum(got.values()), f"columns {names} != {want_names}"
    extra, lacking = got - want, want - got
    message = ""
    if extra or lacking:
        message = (
            f"{sum(got.values())} rows, want {sum(want.values())}; extra {list(extra.items())[:2]}; "
            f"lacking {list(lacking.items())[:2]}"
        )
    return seconds, sum(got.values()), message


def main():
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from __spark_entry__ import oracle_sql, queries
    from boxlake.session import build_session

    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("OFF")
    wanted = sys.argv[2:] or list(queries())
    bad = 0
    for name in wanted:
        try:
            seconds, rows, message = compare(spark, folder, name, queries()[name], oracle_sql().get(name))
        except Exception as failure:
            seconds, rows, message = 0, 0, f"{type(failure).__name__}: {str(failure)[:600]}"
        bad += bool(message)
        print(f"{'ok  ' if not message else 'BAD '} {name:28} {rows:8} {seconds:6.2f}s {message}", flush=True)
    print(f"{len(wanted) - bad}/{len(wanted)} agree")


if __name__ == "__main__":
    main()
