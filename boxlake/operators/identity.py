"""Append-only dense ids: ids once given never change, new keys go to the end."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxlake.functions.text import strip
from boxlake.operators.numbering import number_rows


SHARE = 0.1  # of rows that bounds are sampled from


def append_ids(known: DataFrame, keys: DataFrame, order: list[str], like: DataFrame | None = None) -> DataFrame:
    """``known(key, id)`` plus every unseen row of ``keys(key, *order)``, numbered on in ``order``."""
    unseen = keys.join(known.select("key"), "key", "left_anti")
    next_id = F.coalesce(known.agg(F.max("id")).scalar(), F.lit(-1)) + 1
    added = number_rows(unseen, order, "_n", like)
    return known.select("key", "id").unionByName(
        added.select("key", (F.col("_n") + next_id).cast("long").alias("id"))
    )


def append_ids_first_seen(known: DataFrame, rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """New keys in order of first appearance, those that appear at one place by key. The minimum is combined before the shuffle."""
    def firsts(some: DataFrame) -> DataFrame:
        return (
            some.where(F.col(key).isNotNull())
            .groupBy(F.col(key).alias("key"))
            .agg(F.min(F.struct(*order)).alias("first"))
            .select("key", *[F.col(f"first.{c}").alias(f"_o{i}") for i, c in enumerate(order)])
        )

    return append_ids(known, firsts(rows), [*(f"_o{i}" for i in range(len(order))), "key"], firsts(rows.sample(SHARE, seed=1)))


def append_ids_sorted(known: DataFrame, names: DataFrame, name: str, like: DataFrame | None = None) -> DataFrame:
    """New names in code-point order. ``like`` holds names of a share of the sources, if that is cheaper to sample."""

    def keys(some: DataFrame) -> DataFrame:
        return some.select(F.col(name).alias("key")).where(F.col("key").isNotNull()).distinct()

    return append_ids(known, keys(names), ["key"], None if like is None else keys(like))


def crew_members(rows: DataFrame, crew: Column) -> DataFrame:
    """One row per distinct member of an array column of names; blanks dropped.

    Repeats go before the names are cleaned, so cleaning runs once per spelling.
    """
    return (
        rows.select(crew.alias("crew"))
        .select(F.explode("crew").alias("member"))
        .distinct()
        .select(strip("member").alias("member"))
        .where("member <> ''")
        .distinct()
    )


def unseen_keys(keys: DataFrame, known: DataFrame, on: str) -> DataFrame:
    """Keys that the known set lacks."""
    return keys.select(on).where(F.col(on).isNotNull()).distinct().join(known.select(on), on, "left_anti")


def check_size(dimension: DataFrame, expected: int, what: str) -> int:
    """Fail unless a dimension holds exactly the expected number of rows."""
    found = dimension.count()
    if found != expected:
        raise ValueError(f"{what} holds {found} rows, expected {expected}: ids may have moved")
    return found
