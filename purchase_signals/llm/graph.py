"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """``(id, component_id)`` of every node of ``edges (a, b)``, the smallest id of each.

    Large and small stars by turns (Kiveris et al., 2014): each node's neighbours
    are tied to its smallest one, until nothing changes. A round is two joins on
    a minimum that is aggregated before the shuffle; its edges are written to the
    shared folder, so neither lineage nor driver memory grows. Loops and nulls in
    ``edges`` are passed over; no edges give no rows.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    stars = materialise(
        edges.where("a <> b").select(high.alias("a"), low.alias("b")).distinct(), "components"
    )
    before = None
    while True:
        state = stars.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == before or not state[0]:
            break
        before = state
        both = stars.union(stars.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(least, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialise(large.distinct(), "components")
        root = large.groupBy("a").agg(F.min("b").alias("m"))
        near = large.join(root, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        stars = materialise(
            near.union(root.select("a", F.col("m").alias("b"))).distinct(), "components"
        )
    roots = stars.groupBy("a").agg(F.min("b").alias("component_id"))
    return roots.withColumnRenamed("a", "id").union(stars.select("b", "b").distinct())
