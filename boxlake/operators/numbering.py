"""Dense numbering in a total order, without sending all rows through one task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_DRAWN = 20  # sampled rows for each block
_TREE = 256  # bounds that are compared in a tree


def key_bounds(df: DataFrame, order: list[str], blocks: int) -> list[tuple]:
    """Key values that cut the rows of ``df`` into blocks of about equal size, from one sample of bounded size.

    The sample follows from the keys' hashes, so it is the same however the rows are laid out.
    """
    chance = df.select(*order).orderBy(F.xxhash64(*order), *order).limit(_DRAWN * blocks)
    drawn = [tuple(r) for r in chance.orderBy(*order).collect()]
    return list(dict.fromkeys(drawn[at * len(drawn) // blocks] for at in range(1, blocks))) if drawn else []


def block_of(df: DataFrame, order: list[str], bounds: list[tuple]) -> Column:
    """How many of the sorted bounds are not above a row's key, nulls first. Bounds are literals of the plan.

    Up to a few hundred make a tree of comparisons, which is compiled; more are arrays searched in two steps.
    """
    kinds = dict(df.select(*order).dtypes)
    if len(order) == 1 and kinds[order[0]] in ("int", "bigint") and len(bounds) <= _TREE:
        return F.expr(_numbers_tree(f"`{order[0]}`", [b[0] for b in bounds if b[0] is not None], 0))
    if len(order) == 1:
        bounds = [b for b in bounds if b[0] is not None]  # a null is below every key, as a bound and as a key
        key, fixed = F.col(order[0]), [F.lit(b[0]).cast(kinds[order[0]]) for b in bounds]
    else:
        key = F.struct(*order)
        fixed = [F.struct(*[F.lit(v).cast(kinds[c]).alias(c) for c, v in zip(order, bound, strict=True)]) for bound in bounds]
    if len(fixed) <= _TREE:
        return _tree(key, fixed, 0)
    width = math.isqrt(len(fixed) - 1) + 1
    groups = [fixed[at : at + width] for at in range(0, len(fixed), width)]
    nothing = F.slice(F.array(fixed[0]), 1, 0)
    passed = F.size(F.filter(F.array(*[g[-1] for g in groups if len(g) == width]), lambda bound: bound <= key))
    # a full group's own end is above the key if the group is searched
    inner = [F.array(*(g[:-1] if len(g) == width else g)) for g in groups]
    return F.coalesce(passed * width + F.size(F.filter(F.element_at(F.array(*inner, nothing), passed + 1), lambda bound: bound <= key)), F.lit(0))


def _tree(key: Column, fixed: list[Column], first: int) -> Column:
    if not fixed:
        return F.lit(first)
    middle = len(fixed) // 2
    above = _tree(key, fixed[middle + 1 :], first + middle + 1)
    return F.when(key >= fixed[middle], above).otherwise(_tree(key, fixed[:middle], first))


def _numbers_tree(key: str, fixed: list[int], first: int) -> str:
    """The same tree as one text, which is parsed at once."""
    if not fixed:
        return str(first)
    middle = len(fixed) // 2
    above = _numbers_tree(key, fixed[middle + 1 :], first + middle + 1)
    return f"CASE WHEN {key} >= CAST('{fixed[middle]}' AS BIGINT) THEN {above} ELSE {_numbers_tree(key, fixed[:middle], first)} END"


def number_rows(df: DataFrame, order: list[str], name: str, like: DataFrame | None = None) -> DataFrame:
    """Add ``name`` = 0, 1, 2, ... in ascending ``order``, which must be unique per row.

    Bounds from one sample, fixed in the plan, deal rows into blocks of consecutive keys. The place within a block is known
    locally, and the only thing brought together is one row count per block. Both follow from the bounds and the rows alone,
    so a task that is run again finds the same numbers, and nothing has to be written in between. Only the sample is
    taken at once, from rows ``like`` those of ``df`` if given: a share of its sources is cheaper than all of it, and
    decides nothing but how equal blocks are.
    """
    blocks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.withColumn("_block", block_of(df, order, key_bounds(df if like is None else like, order, blocks)))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_block").agg(F.count("*").alias("_size"))
        .select("_block", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    within = F.row_number().over(Window.partitionBy("_block").orderBy(*order))
    # offsets holds at most one row per shuffle partition
    return (
        placed.withColumn("_place", within).join(F.broadcast(offsets), "_block")
        .withColumn(name, F.col("_offset") + F.col("_place") - 1)
        .drop("_block", "_place", "_offset")
    )
