"""Connected components of a graph whose links are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxlake.llm.common import stored


def connected_components(links: DataFrame, name: str = "components") -> DataFrame:
    """node and component (smallest node it reaches) of every node in ``links`` (a, b longs).

    Large-star and small-star steps alternate until every node hangs on the smallest node of its component; the number
    of rounds grows with the logarithm of the longest path. Minima are combined before each shuffle; no neighbourhood is
    ever gathered. Each round is written to the shared folder.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), name)
    seen = None
    while True:
        both = edges.union(edges.select("v", "u")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_least, "u").filter("v <> m").select("v", "m").union(small_least).toDF("u", "v").distinct()
        edges = stored(small, name)
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen = now
    roots = edges.select("v").distinct()
    return edges.toDF("node", "component").union(roots.select(F.col("v").alias("node"), F.col("v").alias("component")))
