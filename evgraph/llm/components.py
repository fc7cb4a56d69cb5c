"""Connected components of a graph of ids, by alternating large and small stars.

Every round hangs neighbours on the smallest id they can see, so chains shrink by halves and the
number of rounds grows with the logarithm of the longest one. Nothing is collected; each
round is written to the shared folder.

Edge cases: no edges give no rows; loops and repeated edges change nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from evgraph.session import written


def _least(edges: DataFrame) -> DataFrame:
    """(u, v, m): each edge with the smallest id among u and its neighbours."""
    least = edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return edges.join(least, "u")


def components(pairs: DataFrame) -> DataFrame:
    """(id, label) of every id in ``pairs`` (a, b); the label is the smallest id of the component."""
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    edges = written(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "stars")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        met = _least(large)
        small = met.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(met.select("u", F.col("m").alias("v")))
        edges = written(small.where("u != v").distinct(), "stars")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    labels = edges.select(F.col("u").alias("id"), F.col("v").alias("_label"))
    return ids.join(labels, "id", "left").select("id", F.coalesce("_label", "id").alias("label"))
