"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricebasket.llm.common import written

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node joins its greater neighbours to its smallest one."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node joins its smaller neighbours and itself to the smallest one."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a")
    return (moved.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.withColumnRenamed("m", "b")).distinct())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b; any order, loops
    and repeats allowed) that isn't its component's smallest node.

    Each round shrinks the trees' height by half or more; a round's edges are
    written to the shared folder, so its lineage is one round long.  The
    rounds end when every node points straight at a node that points nowhere.
    """
    star = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .where("a != b").distinct(), "cc")
    for _ in range(MAX_ROUNDS):
        state = star.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if not state[0]:
            break
        star = written(_small_star(_large_star(star)), "cc")
        if star.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first() == state:
            break
    else:
        raise RuntimeError("components did not settle")
    return star.select(F.col("a").alias("node"), F.col("b").alias("root"))
