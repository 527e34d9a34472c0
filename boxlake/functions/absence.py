"""First-match classification of free-text absence reasons."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from boxlake.fixed_values import ABSENCE_RULES, UNKNOWN


def classify(text: Column, rules=None) -> Column:
    """struct(status, reason) of the first rule whose pattern occurs in the upper-cased text.

    One CASE expression: it stops at the first hit and stays in generated code. ``(?U)`` makes
    word boundaries follow letters of every script whatever the Java version.
    """
    upper = F.upper(F.coalesce(text, F.lit("")))

    def verdict(status: str, reason: str) -> Column:
        return F.struct(F.lit(status).alias("status"), F.lit(reason).alias("reason"))

    def add(chain, rule):
        status, reason, pattern = rule
        hit = upper.rlike(f"(?U){pattern}")
        return F.when(hit, verdict(status, reason)) if chain is None else chain.when(hit, verdict(status, reason))

    chain = reduce(add, ABSENCE_RULES if rules is None else rules, None)
    return chain.otherwise(verdict(UNKNOWN, UNKNOWN))
