"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoforge.llm.common import scratch


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over directed rows (u, v). The least neighbour of each u is a partial
    aggregate, and the join that hands it to u's neighbours is an ordinary skew-splittable join."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else \
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("lo"))
    least = least.withColumn("m", F.least("lo", "w"))
    joined = both.join(least, both["u"] == least["w"])
    if large:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select(F.col("w").alias("u"), F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the least id reachable, for every id that has an edge in ``edges(a, b)``.
    Each round is written to the shared folder; it ends when a round changes nothing."""
    now = scratch(edges.where(F.col("a") != F.col("b"))
                  .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = None
    while True:
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark or not seen[0]:
            break
        mark = seen
        now = scratch(_star(_star(now, True), False))
    return scratch(now.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component"))
                   .unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()))
