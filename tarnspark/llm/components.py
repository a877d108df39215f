"""Connected components of an edge table by contraction.

Each round points every node at its least neighbour (a partial aggregate before the shuffle, so a node with very many links
is no single group of rows; joins with the node that very many point at are salted), goes on from there once more, and replaces the ends of all edges by the nodes they point at. What has become one node drops
out, so that the tables of the rounds shrink and long chains halve twice a round. At the end the pointers are followed back from the last round to the first. Every round ends in written tables.
Only counts come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnspark.llm.common import drop, materialize, salted_join

#: Rows of one node that one task joins; those of a node with more are dealt to several.
NODE_ROWS = 1_000_000


def _once(edges: DataFrame) -> DataFrame:
    return edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges``: columns a and b of one type that can be ordered. Returns id and comp, the least id of its component, for every node of an edge."""
    own, rounds = materialize(_once(edges.select("a", "b")), "edges"), []
    while True:
        ends = own.select(F.col("a").alias("id"), "b").unionByName(own.select(F.col("b").alias("id"), F.col("a").alias("b")))
        near = materialize(ends.groupBy("id").agg(F.min("b").alias("low")).select("id", F.least("id", "low").alias("low")), "near")
        up = near.select(F.col("id").alias("low"), F.col("low").alias("comp"))
        to = materialize(salted_join(near, up, "low", "id", NODE_ROWS).select("id", "comp"), "labels")
        drop(near)
        rounds.append(to)
        left, right = to.select(F.col("id").alias("a"), F.col("comp").alias("x")), to.select(F.col("id").alias("b"), F.col("comp").alias("y"))
        met = salted_join(salted_join(own, left, "a", "b", NODE_ROWS), right, "b", "a", NODE_ROWS, keys=own)
        nxt = materialize(_once(met.select(F.col("x").alias("a"), F.col("y").alias("b"))), "edges")
        drop(own)
        own = nxt
        if not own.limit(1).count():
            drop(own)
            break
    out = rounds.pop()
    while rounds:
        to = rounds.pop()
        last = out.select(F.col("id").alias("comp"), F.col("comp").alias("end"))
        joined = materialize(salted_join(to, last, "comp", "id", NODE_ROWS, "left").select("id", F.coalesce("end", "comp").alias("comp")), "labels")
        drop(out)
        drop(to)
        out = joined
    return out
