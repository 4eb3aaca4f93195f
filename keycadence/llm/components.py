"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import materialize, spread


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of ``(a, b)`` links; the smallest node names it.

    Alternates the large-star and small-star steps: each hangs the neighbours of
    a node below the smallest one it knows, so a chain of any length becomes a
    star in about log(length) rounds. A node's neighbours are never gathered:
    each step is a grouped minimum, combined before the shuffle, and a join whose
    hot keys AQE can split. ``rounds`` guards against an error in the links; a
    run that needs more fails rather than return open components.
    """
    edges = materialize(_both_down(links), "edges")
    before = _state(edges)
    for _ in range(rounds):
        edges = materialize(_small_star(_large_star(edges)), "edges")
        after = _state(edges)
        if after == before:
            found = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
            roots = edges.select("b").distinct().select(
                F.col("b").alias("node"), F.col("b").alias("component")
            )
            return found.unionByName(roots)
        before = after
    raise RuntimeError("components did not settle")


def _both_down(links: DataFrame) -> DataFrame:
    """Distinct links as (larger, smaller), without loops."""
    return (
        links.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node go below the smallest of node and neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(
        "a", F.least("a", "m").alias("m")
    )
    moved = both.filter(F.col("b") > F.col("a")).join(spread(least), "a")
    return _both_down(moved.select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node, go below the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(spread(least), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _both_down(moved.unionByName(least.select("a", F.col("m").alias("b"))))
