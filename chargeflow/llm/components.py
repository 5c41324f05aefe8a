"""Connected components of a graph held as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import discard, materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (its smallest node) for every node of the table of
    edges ``a``, ``b``. Loops and null ends are no edges.

    Rounds of two steps, until nothing changes: each node hands its larger
    neighbours to its smallest neighbour, then its smaller ones and itself to
    the smallest. The number of edges never grows and paths halve, so a round
    costs a few shuffles of edges and few rounds are needed. Rounds are
    written tables, each deleted when the next is there: nothing is held in
    executors, nothing comes to the driver.
    """
    e = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct())
    seen = None
    while True:
        state = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum("v")).first()
        if state == seen or not state[0]:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select("v", "v").distinct())
        seen = state
        both = e.union(e.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        last, e = e, materialize(small.union(least.select("u", "m")).distinct())
        discard(last)
