"""Connected components of an edge table as Spark joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise


def _to_minimum(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(u, v) with the smallest v of each u as ``m``; the grouped side is written (and returned to be
    discarded), so that the join has a plain exchange on both sides and AQE can split a node of high degree."""
    least = materialise(pairs.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m")), "cc_min")
    return pairs.join(least, F.col("u") == F.col("node")).select("u", "v", "m"), least


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v); component is its smallest node.

    Alternates two star steps until nothing changes: every node points its larger
    neighbours, then itself and its smaller neighbours, to the smallest node it
    sees. The number of rounds grows with the logarithm of the longest path.
    Null ends and loops are ignored; each step is a written table, so a lost
    executor costs one step at most.
    """
    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())

    edges = edges.select("u", "v").where("u <> v")
    edges = materialise(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc_edges")
    seen = state(edges)
    for _ in range(rounds):
        if not seen[0]:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large, least = _to_minimum(both)
        hung = materialise(large.where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct(), "cc_large")
        discard(edges, least)
        small, least = _to_minimum(hung)
        small = small.select("u", F.col("m").alias("v")).unionByName(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = materialise(small.distinct(), "cc_small")
        discard(hung, least)
        now = state(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots).distinct()
