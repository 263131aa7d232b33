"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evallens.llm.common import stored


def _star(edges: DataFrame) -> DataFrame:
    """(u, v) links -> each u with the least of itself and its neighbours."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))


def connected_components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(node, component) for every node of `edges` (a, b: long); component: the least node reachable.

    Each step is one map-side combined minimum per node and one join, which AQE
    splits at a hub; no node's neighbours are gathered in one place.  Every
    round is written to the shared folder, so nothing is recomputed when an
    executor is lost.  Loops and repeated links are harmless; no edges: no rows.
    """
    e = stored(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc-0")
    mark = None
    for i in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_star(both), "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where(F.col("u") != F.col("v")).distinct()
        small = large.join(_star(large), "u")
        small = small.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                               F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        e = stored(small.where(F.col("u") != F.col("v")).distinct(), f"cc-{i + 1}")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    # stars now: every node points at its least one
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
