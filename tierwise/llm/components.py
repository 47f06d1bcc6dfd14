"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.runtime import discard, durable


def checksum(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")
    ).first()
    return row["n"], row["s"]


def star(both: DataFrame, large: bool) -> DataFrame:
    """Link neighbours of a node to its smallest neighbour: the larger ones, or the smaller ones and itself.

    The smallest neighbour is aggregated map-side and joined back, so a node with very many
    neighbours is not gathered in one task.
    """
    near = both if large else both.where(F.col("b") < F.col("a"))
    lowest = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    joined = near.join(lowest, "a")
    if large:
        new = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        new = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(lowest.select("a", F.col("low").alias("b")))
    return new.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the smallest node of its component.

    Each round is written to shared storage, so lineage stays short and lost executors cost one
    round at most. Ends when a round changes nothing.
    """
    now = durable(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "component-edges",
    )
    seen = checksum(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        spread = star(both, large=True)
        before, now = now, durable(star(spread, large=False), "component-edges")
        discard(before)
        again = checksum(now)
        if again == seen:
            break
        seen = again
    roots = now.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
