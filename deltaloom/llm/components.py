"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(a, b) edges of longs -> (node, component): the smallest node that each node reaches.

    Only nodes of an edge between different nodes appear; null ends, loops and repeated edges are ignored. A hub's
    neighbours are reduced to one minimum before the shuffle, and a step emits one row for each edge, so that a hub
    never becomes all pairs of its neighbours. Every round is written to the shared folder, and deleted after the next one.
    """

    def star(e: DataFrame, larger: bool) -> DataFrame:
        both = e.unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b"))) if larger else e
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        near = both.where("b > a") if larger else both
        out = near.join(least, "a").select(F.col("b").alias("x"), "m")
        if not larger:
            out = out.unionAll(least.select(F.col("a").alias("x"), "m"))
        return out.where("x <> m").select(F.col("x").alias("a"), F.col("m").alias("b")).distinct()

    def sign(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    e = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = written(e, "edges")
    seen = sign(e)
    for _ in range(most_rounds):
        if not seen[0]:
            break
        before, e = e, written(star(star(e, True), False), "edges")
        now = sign(e)
        discard(before)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(e.select("b", "b").distinct())
