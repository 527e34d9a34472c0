"""Counts, shares, most common values and last values.

Everything is counted per value first, so a hot key is combined map-side and no task ever holds
the rows of one key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def modal_value(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Most frequent ``value`` per ``key``; the smallest wins a tie."""
    counts = rows.groupBy(key, value).agg(F.count("*").alias("_n"))
    best = F.min(F.struct((-F.col("_n")).alias("rank"), F.col(value).alias("value")))
    return counts.groupBy(key).agg(best.alias("_best")).select(key, F.col("_best.value").alias(value))


def value_shares(rows: DataFrame, value: str, digits: int = 6) -> DataFrame:
    """(value, count, share), commonest first. The total is the sum of the per-value counts."""
    counts = rows.groupBy(value).agg(F.count("*").alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn("share", F.round(F.col("count") / total, digits)).orderBy(
        F.desc("count"), F.col(value).asc_nulls_last()
    )


def top_values(rows: DataFrame, value: str, k: int) -> DataFrame:
    """The ``k`` most frequent non-null values."""
    return (
        rows.where(F.col(value).isNotNull())
        .groupBy(value)
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), F.asc(value))
        .limit(k)
    )


def value_counts(rows: DataFrame, value: str) -> DataFrame:
    """Counts of every value, null included."""
    return (
        rows.groupBy(value)
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), F.col(value).asc_nulls_last())
    )


def keep_last(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One whole row per key, the last in ``order``: an aggregate, so hot keys combine map-side."""
    payload = [c for c in rows.columns if c not in keys]
    picked = rows.groupBy(*keys).agg(F.max_by(F.struct(*payload), F.struct(*order)).alias("_last"))
    return picked.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in payload]).select(*rows.columns)


def latest_fields(log: DataFrame, keys: list[str], order: list[str], fields: list[str]) -> DataFrame:
    """Newest non-null value of each field per key; fields age independently."""
    when = f"struct({', '.join(order)})"
    return log.groupBy(*keys).agg(
        *[F.expr(f"max_by({f}, {when}) FILTER (WHERE {f} IS NOT NULL)").alias(f) for f in fields]
    )


def union_all(*frames: DataFrame) -> DataFrame:
    """Union by column name; a column that one side lacks becomes null."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result
