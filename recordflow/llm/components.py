"""Connected components of a graph of long ids, by alternating star contraction.

Each round points every neighbour at the smallest id around it, first upwards, then
downwards, until only stars are left. A round is two grouped minima and two joins over the
links; the minima are combined before the shuffle and the joins are plain equi joins whose
skewed keys adaptive execution splits, so a hub with a third of all links is no single task.
The number of links never grows. Lineage is cut in each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` of every id that a link names, component being the smallest id
    reachable. Links with a null end, loops and repeats count for nothing."""
    ends = links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    stars = cut(ends.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct())
    seen = None
    while True:
        both = stars.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
            stars.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        up = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        up = up.distinct()
        low = up.groupBy("hi").agg(F.min("lo").alias("m"))
        down = up.join(low, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        stars = cut(down.union(low.select("hi", F.col("m").alias("lo"))).distinct())
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    roots = stars.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return stars.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(roots)
