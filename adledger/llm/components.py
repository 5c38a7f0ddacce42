"""Connected components of a graph given as edges, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adledger.llm.rows import Scratch, dealt


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1_000_003)).first())


def _least(scratch: Scratch, pairs: DataFrame, rows: int, label: str) -> DataFrame:
    """The least neighbour of each node, written so that Spark can split the join of a node with very many."""
    return scratch.saved(dealt(pairs.groupBy("u").agg(F.min("v").alias("m")), rows), label)


def components(edges: DataFrame, rows: int = 0) -> DataFrame:
    """``node`` and ``root`` (the least node of its component) for all nodes of ``edges`` (a, b).

    A step links the neighbours of each node to the least of them. Steps are written to the shared folder, each in the place of the one before, and go on
    until one changes nothing, a number that grows with the logarithm of the longest path. Per node, tasks hold one
    minimum and no lists. ``rows`` is about how many edges there can be, where the caller knows.
    """
    edges = (edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    scratch = Scratch()
    edges = scratch.saved(dealt(edges, rows) if rows else edges, "edges")
    state = _state(edges)
    while state[0]:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        large = both.join(_least(scratch, both, 2 * state[0], "large-star"), "u").filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        large = scratch.saved(dealt(large, 2 * state[0]), "large")
        near = large.join(_least(scratch, large, state[0], "small-star"), "u")
        small = near.filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).union(near.select("u", "m")).distinct()
        stepped = scratch.saved(dealt(small, state[0]), "edges")
        scratch.remove(*(t for t, _ in scratch.held if t is not stepped))
        edges, before = stepped, state
        state = _state(edges)
        if state == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", "b").distinct())
