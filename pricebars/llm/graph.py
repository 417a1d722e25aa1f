"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricebars.llm.settle import beside, checkpointed, shuffles_freed


def components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` of every node of ``edges`` (columns ``u`` and ``v``, longs);
    the component is its smallest id.

    Each step moves edges towards the smallest neighbour, until every node hangs on
    its component's smallest id; the steps grow with the logarithm of the longest
    path.  Every step is written to the shared checkpoint folder, so a lost executor
    repeats one step at most.  Equal edges and loops change nothing."""
    def least(part: DataFrame) -> DataFrame:
        return part.groupBy("u").agg(F.min("v").alias("m"))

    last = None
    e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct().transform(checkpointed)
    while True:
        with shuffles_freed(e.sparkSession):
            n = 2 * e.count()
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (beside(both, "u", least, n).filter("v > u")
                 .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct().transform(checkpointed))
        small = beside(large, "u", least, n).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = small.unionByName(least(large).withColumnRenamed("m", "v")).distinct().transform(checkpointed)
        # a state that a step leaves as it is: every node has its one edge to the root
        with shuffles_freed(e.sparkSession):
            state = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == last:
            break
        last = state
    roots = e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
