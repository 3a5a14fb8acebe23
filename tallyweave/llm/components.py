"""Connected components of a graph in DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyweave.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """Rows ``(node, component)`` for every node of ``edges`` (``a``, ``b``, BIGINT).

    Alternating large and small stars: each round links every node's greater neighbours
    to the least one, then its lesser ones, until nothing changes; the number of rounds
    grows with the logarithm of the graph's size. A round groups with a map-side step and
    joins on nodes, never holding a node's neighbours in one place; a hub's rows are split
    by the adaptive skew join. The component is its least node.
    """
    ends = (F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = written(edges.filter("a <> b").select(*ends).distinct())
    state = _state(now)
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        )
        now = written(small.select("e.*").filter("a <> b").distinct())
        after = _state(now)
        if after == state:
            break
        state = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
