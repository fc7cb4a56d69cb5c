"""The k nearest vectors of each query vector, through cells with bounds on their angles.

The angle between directions is a metric. Profiles go to the nearest of a few pivots and, inside that cell, to a
ring of angles; a ring is cut into blocks of about ``block`` profiles. All that is known of a block is its pivot and the
range of its members' angles to it, and that bounds the best cosine any member can have with a query. A query opens
its blocks in order of that bound, a few at first and then ever more, and stops when no block left can beat its k-th
best: results are those of a comparison with every profile.

Only the pivots and one small row per block are known everywhere, as constants of the plan: at most ``MOST_PIVOTS``
pivots, and blocks in proportion to the profiles divided by ``block``.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, functions as F

from evgraph.functions.text import let
from evgraph.session import written

SCORE_DIGITS = 6
MOST_PIVOTS, MOST_RINGS = 64, 64
FEW = 8  # profiles a ring should hold at least
FIRST, GROWTH = 4, 4  # blocks a query opens in the first round, and how much more in each later one
SLACK = 2 * 10.0**-SCORE_DIGITS  # scores are compared rounded


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def with_length(df: DataFrame, vector: str, name: str) -> DataFrame:
    """The vector as doubles, with its length; vectors without a direction have length 0, null or NaN."""
    v = F.transform(vector, lambda x: x.cast("double"))
    return df.withColumn(vector, v).withColumn(name, F.sqrt(dot(F.col(vector), F.col(vector))))


def directed(df: DataFrame, length: str) -> DataFrame:
    return df.where((F.col(length) > 0) & (F.col(length) < F.lit(math.inf)))


def _constant(values: list, ddl: str) -> Column:
    """A nested list as one constant; number by number it would be an expression each."""
    return F.from_json(F.lit(json.dumps(values)), ddl)


def _angles(vector: Column, length: Column, pivots: list[list[float]]) -> Column:
    cosine = lambda p: dot(vector, p) / length
    return F.transform(_constant(pivots, "array<array<double>>"), lambda p: F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine(p)))))


def choose_pivots(profiles: DataFrame, count: int) -> list[list[float]]:
    """Directions of a few profiles, by hash: about the root of their number."""
    wanted = min(MOST_PIVOTS, math.ceil(math.sqrt(count)))
    unit = F.transform("profile", lambda x: x / F.col("plen"))
    return [r.unit for r in profiles.orderBy(F.xxhash64("office"), "office").limit(wanted).select(unit.alias("unit")).collect()]


def cells(profiles: DataFrame, pivots: list[list[float]], rings: int, block: int) -> DataFrame:
    """block, cell, lo, hi, n and the members of every block, as a written table."""
    placed = profiles.withColumn("_a", _angles(F.col("profile"), F.col("plen"), pivots))
    nearest = F.array_min(F.transform("_a", lambda a, i: F.struct(a.alias("angle"), i.alias("cell"))))
    placed = placed.withColumn("_near", nearest).select("office", "profile", "plen", "_near.angle", "_near.cell")
    ring = F.least(F.floor(F.col("angle") * (rings / math.pi)), F.lit(rings - 1))
    placed = placed.withColumn("ring", (F.col("cell") * rings + ring).cast("long"))
    sizes = placed.groupBy(F.col("ring").alias("_ring")).agg(F.ceil(F.count(F.lit(1)) / block).cast("long").alias("_parts"))
    cut = placed.join(sizes, F.col("ring") == F.col("_ring"))
    part = F.pmod(F.xxhash64("office"), F.col("_parts"))
    members = F.array_sort(F.collect_list(F.struct("office", "profile", "plen")))
    return written(
        cut.groupBy((F.col("ring") * (1 << 32) + part).alias("block"), "cell").agg(
            F.min("angle").alias("lo"), F.max("angle").alias("hi"), F.count(F.lit(1)).alias("n"), members.alias("members")
        ),
        "cells",
    )


def _bounds(angles: Column, blocks: list[dict]) -> Column:
    """(negated best score possible, block, n) of every block, best first."""
    def bound(b: Column) -> Column:
        at = F.get(angles, b["cell"])
        return F.cos(F.greatest(F.lit(0.0), at - b["hi"], b["lo"] - at))

    every = _constant(blocks, "array<struct<block:bigint,cell:int,lo:double,hi:double,n:bigint>>")
    return F.array_sort(F.transform(every, lambda b: F.struct((-bound(b)).alias("neg"), b["block"].alias("block"), b["n"].alias("n"))))


def _closest(members: Column, k: int) -> Column:
    """The k best (negated score, office) of a row's vector among the members of a block."""
    scored = F.transform(
        members,
        lambda p: F.struct(
            (-F.round(dot(F.col("embedding"), p["profile"]) / (F.col("_len") * p["plen"]), SCORE_DIGITS)).alias("neg"),
            p["office"].alias("office"),
        ),
    )
    return F.slice(F.array_sort(scored), 1, k)


def nearest(needs: DataFrame, profiles: DataFrame, k: int, block: int) -> DataFrame:
    """need, top (the k best as (neg, office), best first) and n_compared, the profiles it was compared with."""
    profiles = written(directed(with_length(profiles, "profile", "plen"), "plen"), "profiles")
    count = profiles.count()
    pivots = choose_pivots(profiles, count)
    rings = min(MOST_RINGS, max(1, count // (FEW * max(1, len(pivots)))))
    index = cells(profiles, pivots, rings, block)
    blocks = [r.asDict() for r in index.select("block", "cell", "lo", "hi", "n").collect()]
    asked = directed(with_length(needs.select("need", "embedding"), "embedding", "_len"), "_len")
    asked = written(asked.withColumn("_angles", _angles(F.col("embedding"), F.col("_len"), pivots)), "asked")
    members = index.select("block", "members")
    found, opened, width = None, 0, FIRST
    while opened < len(blocks):
        rest = let(F.col("_angles"), lambda angles: F.slice(_bounds(angles, blocks), opened + 1, len(blocks)))
        if found is None:
            current = asked.withColumn("_rest", rest)
        else:
            kth = F.when(F.size("top") >= k, -F.get("top", F.lit(k - 1))["neg"])
            can = lambda b: kth.isNull() | (-b["neg"] + SLACK >= kth)
            current = asked.join(found.select("need", "top"), "need").withColumn("_rest", F.filter(rest, can)).drop("top")
        step = current.select("need", "embedding", "_len", F.explode(F.slice("_rest", 1, width)).alias("b"))
        step = step.select("need", "embedding", "_len", F.col("b.block").alias("block"), F.col("b.n").alias("n"))
        met = step.join(members, "block").select("need", _closest(F.col("members"), k).alias("top"), F.col("n").alias("n_compared"))
        if found is not None:
            met = written(met, "met")
            if met.isEmpty():
                break
            met = found.unionByName(met)
        best = F.slice(F.array_sort(F.flatten(F.collect_list("top"))), 1, k)
        found = met.groupBy("need").agg(best.alias("top"), F.sum("n_compared").alias("n_compared"))
        opened, width = opened + width, width * GROWTH
        if opened < len(blocks):
            found = written(found, "found")
    if found is None:  # no profile has a direction
        none = F.array().cast(f"array<struct<neg:double,office:{profiles.schema['office'].dataType.simpleString()}>>")
        found = asked.select("need", none.alias("top"), F.lit(0).cast("long").alias("n_compared"))
    return found
