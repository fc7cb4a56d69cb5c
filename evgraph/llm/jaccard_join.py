"""N-gram Jaccard join: documents linked by the Jaccard distance of their shingle sets, exactly.

Unrelated texts lie at distance 1 from any third one, so documents as first pivots would put almost all of
a corpus on every border. The first pivots are therefore sets of one shingle: a set is nearest to the
pivots it holds, ties go to the rarest, and that region is its Voronoi cell. A set within the radius of another
must share one of its first ``n - ceil(t n) + 1`` pivots in that order, so it is replicated to the regions of those, its
border window, and no further.

Regions of up to ``SMALL`` sets are joined at once. A larger region picks a few documents as pivots, those
that meet most others, and measures the distance of all its sets to them. A region whose sets have all come into
one component is done. In the others ``GROWTH`` times as many pivots follow in the next level, against sets
that the triangle inequality allows (their distances to the region's first pivot differ by the radius at most) and that
are in another component, until every open set has been a pivot: one that could be linked with a set of its own size although
the shingles before the region's are not shared. Of two linked sets the smaller is open in the region of the first
pivot they share. So no link is lost between components, and groups of copies never form all their pairs.

Most sets that share a pivot are far apart, so pairs meet by sketches first: how many shingles a set has in each of
``SKETCH`` hash buckets, up to 255. Two sketches lie no further apart, bucket by bucket, than their sets differ in shingles;
this gap is the distance used with the triangle inequality, and only pairs whose gap allows a link are compared whole.

Rarity is read from a histogram of ``1 << BUCKET_BITS`` hash buckets, which only orders the pivots; equal sets are
collapsed first.

Edge cases: null texts, and texts without a word, have the empty set, which is linked with nothing; texts with
fewer words than a shingle have one shingle, their whole sequence; null ids come after all others as
representatives; rows with equal ids are rows of their own; the empty table gives the empty table; further columns are kept
by ``one_of_each`` and left out of ``classes``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from evgraph.llm.components import components
from evgraph.llm.textnum import Words, flat, mix, signed, slices
from evgraph.session import passing, written

BUCKET_BITS, PART_BITS = 20, 10
SMALL, GROWTH = 12, 8
SKETCH = 256


def _buckets(value: np.ndarray) -> np.ndarray:
    return (value >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def rarity(texts: DataFrame, width: int) -> np.ndarray:
    """Shingles in each hash bucket, of all texts, as eighths of a binary order: a byte for each of a fixed number."""
    part = 1 << BUCKET_BITS - PART_BITS

    def run(batches):
        total = np.zeros(1 << BUCKET_BITS, np.uint32)
        for batch in batches:
            for _, _, data, offsets in slices(batch.column(0)):
                _, value = Words(data, offsets, lower=True).shingles(width)
                np.add.at(total, _buckets(value), 1)
        if total.any():
            parts = [total[i : i + part].tobytes() for i in range(0, len(total), part)]
            for i in range(0, len(parts), 128):  # small batches: the other side holds them outside the heap
                some = pa.array(parts[i : i + 128])
                yield pa.RecordBatch.from_arrays([pa.array(range(i, i + len(some)), pa.int32()), some], names=["part", "counts"])

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(part, np.int64)
        for batch in batches:
            for counts in batch.column("counts"):
                total += np.frombuffer(counts.as_buffer(), np.uint32)
        orders = np.minimum(np.round(8 * np.log2(total + 1.0)), 255).astype(np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([orders.tobytes()])], names=["part", "orders"])

    found = texts.mapInArrow(run, "part int, counts binary").groupBy("part").applyInArrow(add, "part int, orders binary")
    orders = np.zeros(1 << BUCKET_BITS, np.uint8)
    for row in found.collect():  # a byte a bucket
        orders[row.part * part : (row.part + 1) * part] = np.frombuffer(row.orders, np.uint8)
    return orders


def sketches(row: np.ndarray, value: np.ndarray, rows: int) -> pa.Array:
    """For each row the number of its hashes in every bucket, a byte each."""
    bucket = row * SKETCH + (value % np.uint64(SKETCH)).astype(np.int64)
    counts = np.minimum(np.bincount(bucket, minlength=rows * SKETCH), 255).astype(np.uint8)
    offsets = np.arange(rows + 1, dtype=np.int32) * SKETCH
    return pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(offsets), pa.py_buffer(counts)])


def shingle_sets(docs: DataFrame, key: str, width: int) -> DataFrame:
    """key, n, h1, h2 (of the set), sketch and the distinct shingles, rarest first, as a written table with ``uid``."""
    text = F.col("text").cast("string").alias("_text")
    shared = docs.sparkSession.sparkContext.broadcast(rarity(docs.select(text), width))

    def run(batches):
        count = shared.value
        for batch in batches:
            for a, b, data, offsets in slices(batch.column(1)):
                row, value = Words(data, offsets, lower=True).shingles(width)
                order = np.lexsort((value, row))
                row, value = row[order], value[order]
                fresh = np.ones(len(row), bool)
                fresh[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
                row, value = row[fresh], value[fresh]
                order = np.lexsort((value, count[_buckets(value)], row))
                value = value[order]
                bounds = np.searchsorted(row, np.arange(b - a + 1))
                sums = []
                for salt in (0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179):
                    part = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(value ^ np.uint64(salt)), dtype=np.uint64)])
                    sums.append(part[bounds[1:]] - part[bounds[:-1]])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a), pa.array(np.diff(bounds).astype(np.int64)), pa.array(signed(sums[0])),
                        pa.array(signed(sums[1])), sketches(row, value, b - a),
                        pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(signed(value))),
                    ],
                    names=["key", "n", "h1", "h2", "sketch", "shingles"],
                )

    kind = docs.schema[key].dataType.simpleString()
    found = docs.select(F.col(f"`{key}`"), text).mapInArrow(run, f"key {kind}, n long, h1 long, h2 long, sketch binary, shingles array<long>")
    return written(found.withColumn("uid", F.monotonically_increasing_id()), "sets")


def window_size(n: Column, percent: int) -> Column:
    """How many of its first pivots a set must share one of: n - ceil(t n) + 1."""
    return (n - F.ceil(n * percent / F.lit(100)) + 1).cast("int")


def gaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, total, gap) of pairs (a, b): both sizes together, and by how many shingles the sets differ at least."""
    left = sets.select(F.col("uid").alias("a"), F.col("n").alias("_n"), F.col("sketch").alias("_x"))
    right = sets.select(F.col("uid").alias("b"), F.col("n").alias("_m"), F.col("sketch").alias("_y"))

    def run(batches):
        for batch in batches:
            x, y = (flat(batch.column(i))[0].reshape(-1, SKETCH).astype(np.int16) for i in (3, 4))
            gap = np.abs(x - y).sum(axis=1, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(gap)], names=["a", "b", "total", "gap"])

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", (F.col("_n") + F.col("_m")).alias("total"), "_x", "_y")
    return joined.mapInArrow(run, "a long, b long, total long, gap long")


def within_radius(gap: Column, total: Column, percent: int) -> Column:
    """Whether sets of ``total`` shingles that differ in ``gap`` can be linked: gap / union <= 1 - t."""
    return (100 + percent) * gap <= (100 - percent) * total


def near_pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) of those pairs (a, b, total, gap) that are linked. Only sets of pairs whose gap allows it move."""
    open_ = written(pairs.where(within_radius(F.col("gap"), F.col("total"), percent)).select("a", "b"), "open")
    ids = written(open_.select(F.explode(F.array("a", "b")).alias("uid")).distinct(), "open-sets")
    whole = written(sets.select("uid", "shingles").join(ids, "uid", "left_semi"), "whole")
    left = whole.select(F.col("uid").alias("a"), F.col("shingles").alias("_x"))
    right = whole.select(F.col("uid").alias("b"), F.col("shingles").alias("_y"))
    both = F.size(F.array_intersect("_x", "_y")).cast("long")
    joined = open_.join(left, "a").join(right, "b").select("a", "b", both.alias("_i"), (F.size("_x") + F.size("_y")).cast("long").alias("_s"))
    return joined.where(100 * F.col("_i") >= percent * (F.col("_s") - F.col("_i"))).select("a", "b")


def can_meet(n: str, reach: str, m: str, reach_m: str) -> Column:
    """Whether the shared pivot can be the first of two linked sets of n and m shingles."""
    return (F.col(m) <= F.col(reach)) & (F.col(n) <= F.col(reach_m))


def regions(sets: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """(pivot, uid, n, reach, c, k) of every region with two of ``reps`` (uid) or more, one of them open.

    ``reach`` is the size up to which a set can be linked with this one if the pivot is the first they share: the
    shingles before it are not shared. Of two linked sets the smaller reaches the larger, and so itself; it is open.
    c is the region's size, k the number of its open sets."""
    window = F.slice("shingles", F.lit(1), window_size(F.col("n"), percent))
    rows = sets.select(F.posexplode(window).alias("_at", "pivot"), "uid", "n").join(reps, "uid")  # a semi join would move the arrays
    reach = F.floor((F.col("n") - F.col("_at")) * (100 + percent) / F.lit(percent)) - F.col("n")
    rows = rows.select("pivot", "uid", "n", reach.alias("reach"))
    counts = rows.groupBy("pivot").agg(F.count(F.lit(1)).alias("c"), F.count_if(F.col("n") <= F.col("reach")).alias("k"))
    return written(rows.join(counts.where("c > 1 AND k > 0"), "pivot"), "regions")


def links(sets: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """(id, label) of the components of ``reps`` under links of similarity ``percent`` / 100 or more."""
    cells = regions(sets, reps, percent)
    few = cells.where(F.col("c") <= SMALL)
    a = few.select("pivot", F.col("uid").alias("a"), F.col("n").alias("_n"), F.col("reach").alias("_u"))
    b = few.select("pivot", F.col("uid").alias("b"), F.col("n").alias("_m"), F.col("reach").alias("_v"))
    pairs = a.join(b, "pivot").where((F.col("a") < F.col("b")) & can_meet("_n", "_u", "_m", "_v")).select("a", "b").distinct()
    found = written(near_pairs(gaps(pairs, sets), sets, percent), "links")

    central = cells.groupBy("uid").agg(F.sum("c").alias("_met"))
    many = cells.where(F.col("c") > SMALL).join(central, "uid")
    # the open members of a region are taken as pivots in this order: those that meet most others first
    closed = F.col("n") > F.col("reach")
    rank = F.row_number().over(Window.partitionBy("pivot").orderBy(closed, F.desc("_met"), "uid"))
    crowd = written(many.select("pivot", "uid", "n", "reach", "k", rank.alias("place")), "crowd")
    done, wanted, first = 0, 1, None
    while not crowd.isEmpty():
        own = crowd.where((F.col("place") > done) & (F.col("place") <= F.least(F.lit(done + wanted), "k")))
        own = own.select("pivot", F.col("uid").alias("_p"), F.col("n").alias("_m"), F.col("reach").alias("_v"), F.col("place").alias("_place"), *([F.col("label").alias("_l"), F.col("d").alias("_d")] if first else []))
        fits = (F.col("place") > F.col("_place")) | (F.col("place") <= done)
        fits = fits & (F.col("uid") != F.col("_p"))
        if first:
            fits = fits & (F.col("label") != F.col("_l")) & within_radius(F.abs(F.col("d") - F.col("_d")), F.col("n") + F.col("_m"), percent)
            fits = fits & can_meet("n", "reach", "_m", "_v")
        met = crowd.join(own, "pivot").where(fits)
        measured = written(gaps(met.select(F.col("uid").alias("a"), F.col("_p").alias("b")).distinct(), sets), "measured")
        found = written(found.unionByName(near_pairs(measured, sets, percent)), "links")
        if not first:  # distances to the first pivot of each region
            to_pivot = own.select("pivot", F.col("_p").alias("b")).join(crowd.select("pivot", F.col("uid").alias("a")), "pivot").join(measured.select("a", "b", "gap"), ["a", "b"], "left")
            to_pivot = to_pivot.select("pivot", F.col("a").alias("uid"), F.coalesce("gap", F.lit(0)).alias("d"))
            crowd = crowd.join(to_pivot, ["pivot", "uid"])
            first = True
        else:
            crowd = crowd.drop("label")
        labels = components(found)
        crowd = crowd.join(labels.withColumnRenamed("id", "uid"), "uid", "left").withColumn("label", F.coalesce("label", "uid"))
        done, wanted = done + wanted, wanted * GROWTH
        open_ = crowd.groupBy("pivot").agg(F.min("label").alias("_a"), F.max("label").alias("_b")).where("_a != _b").select("pivot")
        crowd = written(crowd.where(F.col("k") > done).join(open_, "pivot"), "crowd")
    return components(found)


def classes(docs: DataFrame, width: int = 3, percent: int = 90, key: str = "doc_id") -> DataFrame:
    """key, n_shingles, component_id (smallest key of the component) for every row."""
    found = shingle_sets(docs, key, width)
    some = found.where("n > 0")
    smallest = F.min(F.struct(F.col("key").isNull().alias("null"), "key")).alias("first")
    same = written(some.groupBy("h1", "h2").agg(smallest, F.min("uid").alias("rep")), "classes")
    labels = written(links(some, same.select(F.col("rep").alias("uid")), percent), "labels")
    labelled = same.join(labels.withColumnRenamed("id", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    labelled = written(labelled, "labelled")
    least = labelled.groupBy("label").agg(F.min("first").alias("least"))
    ends = labelled.join(least, "label").select("h1", "h2", F.col("least.key").alias("component_id"))
    linked = some.join(ends, ["h1", "h2"]).select(F.col("key").alias(key), F.col("n").alias("n_shingles"), "component_id", "uid")
    alone = found.where("n = 0").select(F.col("key").alias(key), F.col("n").alias("n_shingles"), F.col("key").alias("component_id"), "uid")
    return linked.unionByName(alone).drop("uid")


def row_hash(key: str) -> list[Column]:
    """128 bits that stand for a row's key and text; nulls differ from each other and from every value."""
    key, text = F.col(f"`{key}`"), F.col("text").cast("string")
    return [F.xxhash64(F.lit(i), key.isNull(), key, text.isNull(), text).alias(f"_h{i}") for i in (0, 1)]


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80, key: str = "doc_id") -> DataFrame:
    """One row of each component, that of the smallest key; of rows with that key, the one whose key and text
    have the smallest hash. Rows equal in key and text are one document, also those without a word."""
    hashes = row_hash(key)
    row = F.struct(F.col(f"`{key}`").isNull().alias("null"), F.col(f"`{key}`").alias("key"), *hashes)
    with passing(docs.sparkSession) as paths:
        found = classes(docs.select(row.alias("_row"), "text"), width, percent, "_row")
        first = written(found.where(F.col("_row") == F.col("component_id")).select("_row._h0", "_row._h1").distinct(), "first")
        paths.pop()
    # equal rows meet in each task before the shuffle; the join then reads the same partitions
    columns = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rest = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.groupBy(*hashes).agg(F.min_by(columns, rest).alias("_r"))
    return rows.join(first, ["_h0", "_h1"], "left_semi").select(*[F.col(f"_r.`{c}`").alias(c) for c in docs.columns])
