"""Audit of a request log against a sliding-window budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxlake.fixed_values import MAX_REQUESTS, MIN_GAP_SECONDS, WINDOW_SECONDS
from boxlake.operators.numbering import block_of

_EACH, _MOST = 16, 2_000  # slices for each shuffle partition, so that each gets about as many rows, and slices in all
_ACCURACY = 20_000  # of the quantiles: cuts are off by a 20,000th of all moves at most


def _chain_slices(slices: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """What the slices before and after a slice say: the sum carried, the last hit, the next expiry.

    A budget has a row for each slice at most, and there are a few slices for each task.
    """
    chain = Window.partitionBy(*by).orderBy("slice")
    past = chain.rowsBetween(Window.unboundedPreceding, -1)
    future = Window.partitionBy(*by).orderBy(F.desc("slice")).rowsBetween(Window.unboundedPreceding, -1)
    return slices.select(
        *by, "slice",
        F.coalesce(F.sum("net").over(past), F.lit(0)).alias("carried"),
        F.max("last_hit").over(past).alias("carried_hit"),
        F.min("first_expiry").over(future).alias("coming_expiry"),
    )


def equal_slices(moves: DataFrame, slices: int) -> Column:
    """The slice of a move's ``t``: cuts at quantiles of all moves, so slices hold about as many each, however short the
    time in which they fall. Slices rise with time, and moves of one instant share one."""
    cuts = moves.agg(F.percentile_approx("t", [k / slices for k in range(1, slices)], _ACCURACY)).first()[0] if slices > 1 else None
    return block_of(moves, ["t"], [(cut,) for cut in sorted(set(cuts or []))]).alias("slice")


def window_occupancy(
    log: DataFrame,
    ts: str = "ts",
    by: tuple[str, ...] = (),
    window_seconds: float = WINDOW_SECONDS,
    capacity: int = MAX_REQUESTS,
    min_gap_seconds: float = MIN_GAP_SECONDS,
    slices: int | None = None,
) -> DataFrame:
    """One row per instant at which requests were made, with the budget's state just after them.

    The window is half open, ``(t - window, t]``: a request exactly one window old has expired.
    Without ``by`` all requests draw on one budget.

    Requests are counted per instant first. Each instant then adds its requests at ``t`` and takes
    them off at ``t + window``, so occupancy is a running sum. That sum is kept within time slices
    of about equal depth, several for each task, and only slice totals are chained, so neither a hot
    host, the single shared budget nor a rush within a minute has to pass through one task.
    """
    window, gap = (int(s * 1_000_000) for s in (window_seconds, min_gap_seconds))
    tasks = int(log.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    instants = log.groupBy(*by, F.unix_micros(F.col(ts).cast("timestamp")).alias("_t")).agg(
        F.count("*").alias("requests")
    )
    moves = instants.select(
        *by,
        F.inline(
            F.array(
                F.struct(F.col("_t").alias("t"), F.col("requests").alias("step"), F.col("_t").alias("hit")),
                F.struct(
                    (F.col("_t") + window).alias("t"), (-F.col("requests")).alias("step"),
                    F.lit(None).cast("long").alias("hit"),
                ),
            )
        ),
    )
    moves = moves.withColumn("slice", equal_slices(moves, slices or min(_EACH * tasks, _MOST)))
    expiry = F.when(F.col("step") < 0, F.col("t"))

    inside = Window.partitionBy(*by, "slice").orderBy("t")
    up_to = inside.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = inside.rangeBetween(Window.unboundedPreceding, -1)
    # backwards, as a running minimum: a frame to the end would be read anew for every row
    later = Window.partitionBy(*by, "slice").orderBy(F.desc("t")).rangeBetween(Window.unboundedPreceding, -1)
    local = moves.select(
        *by, "slice", "t", "step", "hit",
        F.sum("step").over(up_to).alias("running"),
        F.max("hit").over(earlier).alias("hit_before"),
        F.min(expiry).over(later).alias("expiry_after"),
    ).where("hit IS NOT NULL")

    totals = moves.groupBy(*by, "slice").agg(
        F.sum("step").alias("net"), F.max("hit").alias("last_hit"), F.min(expiry).alias("first_expiry")
    )
    joined = local.join(_chain_slices(totals, by), [*by, "slice"])
    in_window = F.col("carried") + F.col("running")
    gap_us = F.when(F.col("step") > 1, F.lit(0)).otherwise(
        F.col("t") - F.coalesce("hit_before", "carried_hit")
    )
    frees_at = F.coalesce("expiry_after", "coming_expiry")
    full_wait = F.when(in_window >= capacity, frees_at - F.col("t")).otherwise(F.lit(0))
    return joined.select(
        *by,
        F.col("t").alias("ts_us"),
        F.col("step").alias("requests"),
        in_window.alias("in_window"),
        gap_us.cast("long").alias("gap_us"),
        full_wait.cast("long").alias("wait_full_us"),
        F.when(in_window >= capacity, full_wait).otherwise(F.lit(gap)).cast("long").alias("wait_next_us"),
        (in_window > capacity).alias("over_capacity"),
        F.coalesce(gap_us < gap, F.lit(False)).alias("too_close"),
    )
