"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import durable


def connected_components(nodes: DataFrame, edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(`id`, `component`) with the smallest id of each component.

    Alternating large-star and small-star steps (Kiveris et al., 2014): the
    neighbours of a node are only ever reduced to their minimum, by an aggregate
    with a map-side partial, so a node with most of the edges costs no large
    group. Rounds grow with the logarithm of the component size. Each round is
    written to the checkpoint folder, which keeps the plan short and survives
    lost executors.
    """
    links = durable(_distinct(edges.where(F.col("a") != F.col("b"))))
    stamp = None
    for _ in range(max_rounds):
        links = durable(_small_star(_large_star(links)))
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == stamp:
            break
        stamp = tuple(now)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = links.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("_root"))
    return nodes.select("id").distinct().join(roots, "id", "left").select(
        "id", F.coalesce("_root", "id").alias("component"))


def _distinct(edges: DataFrame) -> DataFrame:
    """Edges pointing from the larger to the smaller id, once each."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(links: DataFrame) -> DataFrame:
    """Connect every larger neighbour of a node to the node's smallest neighbour."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("_m")).select(
        "a", F.least("_m", "a").alias("_m"))
    moved = both.where(F.col("b") > F.col("a")).join(least, "a")
    return _distinct(moved.select(F.col("b").alias("a"), F.col("_m").alias("b"))
                     .where(F.col("a") != F.col("b")))


def _small_star(links: DataFrame) -> DataFrame:
    """Connect a node and its smaller neighbours to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("_m"))
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("_m").alias("b"))
    own = least.select("a", F.col("_m").alias("b"))
    return _distinct(moved.unionByName(own).where(F.col("a") != F.col("b")))
