"""Mixing sources to target weights: budgets by tree, then seeded token prefixes of every leaf.

A budget in tokens goes down a tree of domains, languages and sources. At each node it is shared among the children
by weight; a child whose whole subtree cannot use its share takes all it can, and what it leaves is shared among its
siblings first. Only what a whole family cannot use is left to the siblings of its parent. A leaf may be read several
times (epochs), each time in another seeded order; the last epoch taken is cut after a prefix of tokens.

The cut is found without sorting a leaf: tokens are summed by leaf and hash bucket, sums are chained over the buckets,
and only the bucket in which the cut lies is looked at row by row. Texts are never shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxlake.llm.common import broadcast_if_small, stored

#: Whole numbers, so that sums of weights are exact. A name that is not listed weighs OTHER.
DOMAIN_WEIGHTS = {"crawl": 30, "web": 30, "books": 25, "reference": 15}
LANGUAGE_WEIGHTS = {"en": 50, "de": 20, "fr": 15, "es": 15}
OTHER = 5
BUDGET_SHARE, EPOCHS, SEED = 0.75, 2, 17
#: Leaves of the tree that are broadcast at most; a larger tree is joined by shuffle.
MOST_LEAVES = 200_000
LEAF = ["domain", "language", "origin"]


def domain_of(source: Column) -> Column:
    """The domain of a numbered source: 0 is the crawl, 1-7 are web, 8-13 books, 14 and above reference; else other."""
    number = F.regexp_extract(source, r"^src([0-9]{1,9})$", 1).try_cast("int")
    return F.when(number == 0, "crawl").when(number < 8, "web").when(number < 14, "books").when(number >= 14, "reference").otherwise("other")


def n_words(text: Column) -> Column:
    """Words of a text, the measure of tokens here; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _weight(name: Column, weights: Mapping[str, int], other: int) -> Column:
    found = F.lit(None)
    for key, weight in weights.items():
        found = F.when(name == key, F.lit(weight)).otherwise(found)
    return F.coalesce(found, F.lit(other)).cast("double")


def _shares(nodes: DataFrame, parents: list[str], name: str) -> DataFrame:
    """``nodes`` with ``share`` of their parent's ``budget`` by ``weight``, none above its ``capacity``.

    Children are filled from the one that is full first; the level at which the rest stand is the largest quotient of
    what is left and the weights it is left to.
    """
    family = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    ordered = family.orderBy(F.col("capacity") / F.col("weight"), name)
    left = F.col("budget") - F.coalesce(F.sum("capacity").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    nodes = nodes.withColumn("level", left / F.sum("weight").over(ordered.rowsBetween(0, Window.unboundedFollowing)))
    nodes = nodes.withColumn("level", F.max("level").over(family))
    return nodes.withColumn("share", F.least("capacity", F.col("weight") * F.col("level"))).drop("level", "budget", "weight", "capacity")


def budgets(sums: DataFrame, total: Column, domain_weights=DOMAIN_WEIGHTS, language_weights=LANGUAGE_WEIGHTS, other: int = OTHER, epochs: int = EPOCHS) -> DataFrame:
    """domain, language, origin, tokens and allotted tokens of every leaf in ``sums`` (LEAF columns and tokens).

    ``total`` is an aggregate over ``sums`` that gives the budget. Sources weigh the same within a language.
    """
    sums = sums.withColumn("capacity", F.col("tokens").cast("double") * epochs)
    whole = sums.agg(total.cast("double").alias("budget"))
    domains = sums.groupBy("domain").agg(F.sum("capacity").alias("capacity")).crossJoin(F.broadcast(whole))
    domains = _shares(domains.withColumn("weight", _weight(F.col("domain"), domain_weights, other)), [], "domain")
    languages = sums.groupBy("domain", "language").agg(F.sum("capacity").alias("capacity")).join(domains.withColumnRenamed("share", "budget"), "domain")
    languages = _shares(languages.withColumn("weight", _weight(F.col("language"), language_weights, other)), ["domain"], "language")
    leaves = sums.join(languages.withColumnRenamed("share", "budget"), ["domain", "language"]).withColumn("weight", F.lit(1.0))
    return _shares(leaves, ["domain", "language"], "origin").withColumn("allotted", F.floor("share").cast("long")).drop("share")


def _key(seed: int, epoch: Column) -> Column:
    """A row's place in an epoch's order."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))


def cuts(rows: DataFrame, sums: DataFrame, plan: DataFrame, seed: int = SEED, hex_digits: int = 3) -> DataFrame:
    """LEAF, whole_epochs and the key up to which the epoch after those is taken.

    ``hex_digits`` of the key make the buckets: 16 to their power, for each leaf.
    """
    plan = plan.withColumn("whole_epochs", F.when(F.col("tokens") > 0, F.floor(F.col("allotted") / F.col("tokens"))).otherwise(0).cast("int"))
    plan = plan.withColumn("rest", F.col("allotted") - F.col("whole_epochs") * F.col("tokens")).select(*LEAF, "whole_epochs", "rest")
    plan = stored(plan, "mix-plan")
    held = broadcast_if_small(plan, MOST_LEAVES)
    keyed = rows.join(held, LEAF).withColumn("place", _key(seed, F.col("whole_epochs")))
    bucketed = keyed.withColumn("bucket", F.substring("place", 1, hex_digits))
    by_bucket = bucketed.groupBy(*LEAF, "bucket").agg(F.sum("tokens").alias("tokens"), F.first("rest").alias("rest"))
    chain = Window.partitionBy(*LEAF).orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    chained = by_bucket.withColumn("upto", F.sum("tokens").over(chain))
    crossed = (
        chained.filter(F.col("upto") > F.col("rest")).groupBy(*LEAF)
        .agg(F.min("bucket").alias("bucket"), F.min(F.struct("bucket", (F.col("upto") - F.col("tokens")).alias("base"))).alias("at"))
        .select(*LEAF, "bucket", F.col("at.base").alias("base"))
    )
    crossed = broadcast_if_small(stored(crossed, "mix-crossed"), MOST_LEAVES)
    inside = Window.partitionBy(*LEAF).orderBy("place").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    last = (
        bucketed.join(crossed, [*LEAF, "bucket"])
        .select(*LEAF, "place", "rest", "base", F.sum("tokens").over(inside).alias("upto"))
        .filter(F.col("base") + F.col("upto") <= F.col("rest"))
        .groupBy(*LEAF).agg(F.max("place").alias("last"))
    )
    # A leaf without a crossed bucket is taken to its end; one whose crossed bucket gives no row is cut before that bucket.
    return (
        plan.join(crossed.select(*LEAF, "bucket"), LEAF, "left").join(last, LEAF, "left")
        .select(*LEAF, "whole_epochs", F.coalesce("last", "bucket", F.lit("g")).alias("cut"), (F.col("rest") > 0).alias("partly"))
    )


def mix(docs: DataFrame, budget_share: float = BUDGET_SHARE, epochs: int = EPOCHS, seed: int = SEED, domain_weights=DOMAIN_WEIGHTS, language_weights=LANGUAGE_WEIGHTS, other: int = OTHER) -> DataFrame:
    """Rows of ``docs`` (doc_id, text, lang, source and any others, all kept) chosen by weight, with their ``mix_epoch``.

    The budget is ``budget_share`` of all tokens. A row appears once for each epoch that takes it. Null languages and
    sources are leaves of their own, named ``und`` and ``unknown``. Rows of one doc_id in a leaf stand at the same place
    and are taken together. Texts without a word cost nothing and come along where their place is before the cut; a leaf
    without tokens gives none. A column named mix_epoch is replaced; other extra columns pass through, whatever their
    names. An empty table gives no rows.
    """
    leaf = [
        F.coalesce(domain_of(F.col("source")), F.lit("other")).alias("domain"),
        F.coalesce(F.col("lang"), F.lit("und")).alias("language"),
        F.coalesce(F.col("source"), F.lit("unknown")).alias("origin"),
    ]
    rows = stored(docs.select("doc_id", *leaf, n_words(F.col("text")).alias("tokens")), "mix-rows")
    sums = rows.groupBy(*LEAF).agg(F.sum("tokens").alias("tokens"))
    plan = budgets(sums, F.floor(F.sum("tokens") * budget_share), domain_weights, language_weights, other, epochs)
    ends = broadcast_if_small(stored(cuts(rows, sums, plan, seed), "mix-cuts"), MOST_LEAVES)
    wide = docs.select(F.struct(*[c for c in docs.columns if c != "mix_epoch"]).alias("row"), "doc_id", *leaf)
    joined = wide.join(ends, LEAF)
    taken = joined.withColumn("times", F.col("whole_epochs") + F.when(F.col("partly") & (_key(seed, F.col("whole_epochs")) <= F.col("cut")), 1).otherwise(0))
    return taken.filter("times > 0").select("row.*", F.explode(F.sequence(F.lit(0), F.col("times") - 1)).alias("mix_epoch"))
