"""Connected components of an edge list by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navloom.llm.shared import keep


def components(edges: DataFrame) -> DataFrame:
    """node and component (the smallest node reachable) for every node of the edges (a, b), all long.

    Each step replaces every edge by one to the smallest neighbour, so edges never multiply; the
    steps end when nothing changes. Hubs are only ever grouped by partial aggregates and joined
    against one row. Loops and repeated edges are allowed; no edges give no rows.
    """
    stars = keep(
        edges.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), "edges"
    )
    before = None
    while (now := _fingerprint(stars)) != before and now[0]:
        before = now
        both = stars.union(stars.select("u", "v")).toDF("x", "y")
        low = both.groupBy("x").agg(F.least("x", F.min("y")).alias("m"))
        large = stars.join(low, stars.u == low.x).select("v", F.col("m").alias("u")).distinct()
        lowest = large.groupBy("v").agg(F.min("u").alias("m"))
        turned = large.join(lowest, "v").where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u"))
        stars = keep(turned.union(lowest).toDF("v", "u").distinct(), "edges")
    ends = stars.toDF("node", "component")
    return ends.union(ends.select("component", "component").distinct())


def _fingerprint(stars: DataFrame) -> tuple:
    row = stars.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("v", "u"))).first()
    return tuple(row)
