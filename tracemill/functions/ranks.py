"""Exact percentiles of groups of any size: distinct values counted, sorted by ranges, and ranks found from running counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import settle
from .prefix import running


def percentiles(rows: DataFrame, group: str, value: str, shares: dict[str, float]) -> DataFrame:
    """Per group the interpolated percentiles of value, named; nulls are left out, and a group of nulls only isn't there.

    A group's values are neither collected in a buffer nor sorted in one task: equal ones are counted before the shuffle, and
    places in the sorted ranges give every value its rank.
    """
    counts = rows.filter(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("_n"))
    placed = counts.repartitionByRange(group, value).sortWithinPartitions(group, value).withColumn("_place", F.monotonically_increasing_id())
    upto = running(settle(placed, "ranks"), group, "_place", {"_upto": F.col("_n")})
    total = counts.groupBy(F.col(group).alias("_group")).agg(F.sum("_n").alias("_all"))
    ranked = upto.join(total, F.col(group).eqNullSafe(F.col("_group")))
    at = {name: (F.col("_all") - 1) * F.lit(share) for name, share in shares.items()}
    ends = [e for n, r in at.items() for e in (F.min(F.when(F.col("_upto") > F.floor(r), F.col(value))).alias(f"{n}_low"), F.min(F.when(F.col("_upto") > F.ceil(r), F.col(value))).alias(f"{n}_high"), F.first(r - F.floor(r)).alias(f"{n}_part"))]
    found = ranked.groupBy(group).agg(*ends)
    return found.select(group, *[(F.col(f"{n}_low") * (1 - F.col(f"{n}_part")) + F.col(f"{n}_high") * F.col(f"{n}_part")).alias(n) for n in shares])
