"""Connected components of a graph too large for one machine."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopmetrics.scratch import written


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node in its neighbourhood."""
    both = _both_ways(edges).select("col.*")
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link the smaller neighbours of a node, and the node, to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (a long, b long); component is the smallest node reachable.

    Alternating large-star and small-star rounds: each round is two aggregations with map-side combining and two joins
    whose skewed keys adaptive execution can split, and it ends after about log(diameter) rounds. Every round is
    written to the shared folder, which cuts the lineage and survives lost executors. No edges give no rows; edges
    with a NULL end or from a node to itself are ignored, repeated ones count once.
    """
    known = written(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .distinct(),
        "edges",
    )
    state = None
    for _ in itertools.count():
        known = written(_small_star(_large_star(known)).distinct(), "edges")
        # The set of edges is stable when every component is a star; count and hash sum of the set tell.
        new = known.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 31)))).first()
        if new == state:
            break
        state = new
    return known.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        known.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
