"""Connected components by alternating star contraction, as joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.session import materialise

MAX_ROUNDS = 60


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): root is the smallest node reachable.

    Each round first hooks the larger neighbours of a node onto the smallest of its
    neighbourhood (large star), then the smaller ones (small star). Rounds grow with the
    logarithm of the component size. Minima are partial aggregates and neighbourhoods are
    joined, never gathered, so a hub is split like any hot join key. Every round is a
    written table; the driver sees a count and a checksum.
    """
    e = materialise(edges.where(F.col("a") != F.col("b"))
                    .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc-edges")
    state = _state(e)
    for _ in range(MAX_ROUNDS):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(F.col("a").alias("_n")).agg(F.min("b").alias("_m"))
        low = low.select("_n", F.least("_n", "_m").alias("_m"))
        large = (both.join(low, both["a"] == low["_n"]).where(F.col("b") > F.col("a"))
                 .select(F.col("b").alias("a"), F.col("_m").alias("b")))
        large = materialise(large.where(F.col("a") != F.col("b")).distinct(), "cc-large")
        low = large.groupBy(F.col("a").alias("_n")).agg(F.min("b").alias("_m"))
        met = large.join(low, large["a"] == low["_n"])
        small = (met.select(F.col("b").alias("a"), F.col("_m").alias("b")).where(F.col("a") != F.col("b"))
                 .unionByName(low.select(F.col("_n").alias("a"), F.col("_m").alias("b"))).distinct())
        e = materialise(small, "cc-round")
        before, state = state, _state(e)
        if state == before:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
