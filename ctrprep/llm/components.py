"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ctrprep.sources.scratch import store


def apart(column: str) -> Column:
    """A key that tells rows apart as ``column`` does, without its partitioning.

    A join of rows with totals by the same key would take over the totals' partitioning, and adaptive execution
    could not split a frequent key. With this key both sides are dealt anew, and it can.
    """
    return F.bitwise_not(F.col(column))


def connected(edges: DataFrame, label: str) -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) of all nodes that have an edge to a smaller or larger one.

    ``edges`` are pairs ``a``, ``b`` of whole numbers in any order, repeated or not. Every round hangs a node's larger
    neighbours, then its smaller ones, on the smallest of them, until each component is a star. The rounds grow with the
    logarithm of the longest chain; each is written to the shared folder, so lineage stays short.
    """
    pairs = store(
        edges.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).where("high > low").distinct(),
        f"{label}-edges",
    )
    state = _state(pairs)
    while True:
        pairs = store(_small_star(_large_star(pairs)), f"{label}-round")
        before, state = state, _state(pairs)
        if state == before:
            break
    roots = pairs.select("low").distinct()
    return pairs.select(F.col("high").alias("node"), F.col("low").alias("component")).unionByName(
        roots.select(F.col("low").alias("node"), F.col("low").alias("component"))
    )


def _state(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("high", "low"))).first())


def _large_star(pairs: DataFrame) -> DataFrame:
    """Each node's larger neighbours, hung on the smallest of the node and its neighbours."""
    both = pairs.select(F.col("high").alias("node"), F.col("low").alias("near")).unionByName(
        pairs.select(F.col("low").alias("node"), F.col("high").alias("near"))
    )
    lowest = both.groupBy("node").agg(F.min("near").alias("least"))
    roots = lowest.select(apart("node").alias("key"), F.least("node", "least").alias("root"))
    larger = both.where("near > node").select(apart("node").alias("key"), "near")
    return larger.join(roots, "key").select(F.col("near").alias("high"), F.col("root").alias("low")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """Each node's smaller neighbours and the node itself, hung on the smallest of them."""
    lowest = pairs.groupBy("high").agg(F.min("low").alias("root"))
    joined = pairs.select(apart("high").alias("key"), "high", "low").join(lowest.select(apart("high").alias("key"), "root"), "key")
    ends = joined.select(F.explode(F.array("high", "low")).alias("high"), F.col("root").alias("low"))
    return ends.where("high > low").distinct()
