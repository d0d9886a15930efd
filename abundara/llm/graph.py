"""Connected components by alternating large and small stars, entirely in joins and grouped minima.

No neighbour list is ever gathered: each step is a grouped minimum (combined before the
shuffle) that is written and then joined back to the links, so that adaptive execution can
split a hub's rows.  Steps are written to the shared folder, so a lost executor costs one
step at most; tables that no later step reads are removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abundara.llm.common import cut, discard


def connected(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(a, b) links of longs to (node, root), root the least node reachable, for every node with a link.

    Nulls and self-links are ignored, repeated links count once, no links give an empty table.
    Rounds grow with the logarithm of the longest path; needing more than ``max_rounds`` is an error.
    """

    def tally(e):
        return e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    e = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = tally(e)
    settled = not before[0]
    for _ in range(max_rounds):
        if settled:
            break
        both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = cut(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
        large = cut(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        low = cut(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e"))
        found = cut(small.select(F.col("e.a").alias("a"), F.col("e.m").alias("b")).where("a <> b").distinct())
        discard(e, least, large, low)
        e, after = found, tally(found)
        settled, before = after == before, after
    if not settled:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
