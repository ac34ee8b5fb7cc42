"""Connected components of an edge table, distributed.

Alternating large-star and small-star rounds: each round is joins and
``min`` aggregates over the edges (map-side combined, so a node with very
many neighbours never meets in one task), and the edges are written to the
shared folder after each round.  Ends when a round changes nothing; the
number of rounds grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizlog.llm.shared import cut


def _state(e: DataFrame) -> tuple:
    r = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.hash("u", "v"))).first()
    return tuple(r)


def components(edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` of longs to ``(node, component)``: for every node that
    has an edge, the smallest node reachable.  Null ends and self links are
    ignored."""
    e = cut(
        edges.where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    state = _state(e)
    while state[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = (
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u").select(F.explode(F.array(
                F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
            )).alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        )
        e = cut(small)
        was, state = state, _state(e)
        if was == state:
            break
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
