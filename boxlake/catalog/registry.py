"""Where queries and their oracle SQL are kept, and the bits both sides share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its own name, with the SQL for the same result if there is one."""

    def add(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def dealt(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table, dealt out before work that is heavy per row. The driver's tables are single small files,
    which one task would read; tables of many files come in enough parts and need no such shuffle."""
    rows = table(spark, folder, name).select(*(columns or ["*"]))
    return rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))


def day(column: str) -> Column:
    return F.date_format(column, "yyyyMMdd")


def team_code(number: Column) -> Column:
    """A three-letter code made of a number's first digits."""
    return F.translate(F.lpad(number.cast("string"), 3, "0"), "0123456789", "ABCDEFGHIJ")


def sql_code(number: str) -> str:
    return f"translate(lpad(CAST({number} AS VARCHAR), 3, '0'), '0123456789', 'ABCDEFGHIJ')"


def sql_day(column: str) -> str:
    return f"strftime({column}, '%Y%m%d')"


def sql_file(date: str, code: str) -> str:
    return f"'boxscores_' || {date} || '0' || {code} || '.html'"
