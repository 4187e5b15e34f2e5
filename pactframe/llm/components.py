"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import checkpointed


def _stars(edges: DataFrame) -> DataFrame:
    """Edges (high, low) after every node hands its higher neighbours, then its lower ones, to the
    least node it knows. Both steps keep the components as they are."""
    both = edges.select(F.col("high").alias("u"), F.col("low").alias("v")).union(
        edges.select(F.col("low").alias("u"), F.col("high").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("least"))
    least = least.select("u", F.least("u", "least").alias("least"))
    large = both.join(least, "u").where("v > u").select(
        F.col("v").alias("high"), F.col("least").alias("low")
    ).distinct()
    lowest = large.groupBy("high").agg(F.min("low").alias("least"))
    return (
        large.join(lowest, "high")
        .select(F.explode(F.array("high", "low")).alias("high"), F.col("least").alias("low"))
        .where("high <> low")
        .distinct()
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """`node, component` (the least node reachable) of every node of `edges(a, b)`.

    Directions, repeats and loops do not matter; rows with a null end are ignored. The edge set is written to the
    shared folder after each round and shrinks towards one star per component; rounds stop when a
    round changes nothing, after about log(longest chain) of them.
    """
    edges = checkpointed(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"))
        .distinct()
    )
    state = None
    while True:
        seen = edges.agg(
            F.count("*").alias("n"), F.expr("sum(cast(xxhash64(high, low) as decimal(38,0)))").alias("h")
        ).first()
        if seen == state or seen["n"] == 0:
            break
        state = seen
        edges = checkpointed(_stars(edges))
    stars = edges.select(F.col("high").alias("node"), F.col("low").alias("component"))
    return stars.union(edges.select("low", "low").distinct())
