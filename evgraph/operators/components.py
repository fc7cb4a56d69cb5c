"""Connected components of a graph in rounds that grow with the logarithm of its longest chain.

Large and small stars alternate: every neighbour a node sees above itself hangs on the smallest node it can see, then every
node hangs all it sees below itself on the smallest of them. Each round about halves a chain and is written to the
shared folder; nothing but a count and a sum of hashes reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from evgraph.session import written


def _with_least(edges: DataFrame) -> DataFrame:
    """(u, v, m): each edge with the smallest of u and all its neighbours."""
    least = edges.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("_m"))
    return edges.join(least, F.col("u") == F.col("_u")).select("u", "v", F.least("u", "_m").alias("m"))


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(pairs: DataFrame) -> tuple[DataFrame, int]:
    """(id, label) of every id in ``pairs`` (a, b) and the number of rounds; a label is the smallest id
    of its component. Ids are of any type with an order; loops and repeated pairs change nothing."""
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    edges = pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    edges, rounds = written(edges, "stars"), 0
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        met = _with_least(large)
        small = met.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(met.select("u", F.col("m").alias("v")))
        edges, rounds = written(small.where("u != v").distinct(), "stars"), rounds + 1
        before, state = state, _state(edges)
        if state == before:
            break
    labels = edges.select(F.col("u").alias("_u"), F.col("v").alias("_label"))
    return ids.join(labels, F.col("id") == F.col("_u"), "left").select("id", F.coalesce("_label", "id").alias("label")), rounds
