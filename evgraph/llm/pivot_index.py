"""Embedding near-duplicates by a pivot-permutation index.

Every vector is described by its ``NEAREST`` nearest reference points in order of their closeness. Vectors whose
descriptions agree are close, so candidates come from inverted lists of reference points: one list for each three
points, which a vector enters if all three are in its description. Two vectors on a common list share three points,
and the number of lists they have in common gives the number of points they share. Candidates are verified by their
cosine in double precision.

* Equal vectors are one class from the start; its rows are counted, not paired.
* A list longer than ``CROWD`` is a crowd. Its members' mean is taken as a centre: those within half the angle of the
  threshold are within the whole angle of each other, so they are linked without looking at pairs, and one of them
  stands for all. The rest of a crowd meets in blocks of ``BLOCK`` rows by matrix products, in each vector's longest
  list, and the first vector of each other long list. What this leaves open is closed afterwards: in every long list
  all vectors outside its largest component so far meet all its vectors, in blocks again, and so do vectors that another
  stood for in short lists. Only pairs already in one component are spared, so the components are those of all pairs.
* Links are counted at the end inside each component: by matrix products in blocks, where components above
  ``BLOCK`` count what lies around their centre by the same bound and multiply only the rest. No pair of a group is
  ever a row.

The reference points are a bounded sample: distinct vectors of the smallest hashes, none within a cosine of
``APART`` of another. Their number grows with the cube root of the number of vectors, which keeps the lists
short, up to ``MOST_POINTS``; every row is indexed. The index finds nearly all links, not all (the tests hold it to a
recall of 0.9 at least, at the threshold itself too); no pair below the threshold is ever linked.

Edge cases: null and zero vectors, and those with null, infinite or NaN entries, are linked with nothing and are
components of their own, null keys too; shorter vectors end in zeros; repeated keys are rows of their own whose
component is the smallest key in it, null keys last; the empty table gives the empty table; further columns are left out.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from evgraph.llm.components import components
from evgraph.llm.vectors import longest, matrix
from evgraph.session import written

NEAREST = 7  # reference points in a description
LIST_SHARE = 1200.0  # reference points: the cube root of this many times the vectors
LEAST_POINTS, MOST_POINTS = 32, 16_384
APART = 0.8
CROWD, BLOCK = 24, 1024


def _hashes(values: np.ndarray) -> tuple[list[int], list[int]]:
    """128 bits of each row; -0.0 counts as 0.0."""
    data = np.ascontiguousarray(values + 0.0)
    both = [np.frombuffer(hashlib.blake2b(row.tobytes(), digest_size=16).digest(), np.int64) for row in data]
    return [int(b[0]) for b in both], [int(b[1]) for b in both]


def _lists(values: np.ndarray) -> pa.Array:
    n, dim = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * dim), pa.array(values.ravel()))


def _matrix(column, dim: int) -> np.ndarray:
    return matrix(column, dim)[1]


def _units(values: np.ndarray) -> np.ndarray:
    return values / np.sqrt((values * values).sum(1))[:, None]


def hashed_rows(vectors: DataFrame, key: str, column: str, dim: int, with_vector: bool) -> DataFrame:
    """key, h1, h2 of every row, null where the vector takes no part; the unit vector too where asked for."""
    kind = vectors.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            rows, values = matrix(batch.column(1), dim)
            some = (values * values).sum(1) > 0 if dim else np.zeros(len(rows), bool)
            rows, values = rows[some], values[some]
            largest = np.abs(values).max(axis=1, initial=0)[:, None] if len(values) else np.ones((0, 1))
            # scaled by a power of two, which changes no cosine, so that squares neither overflow nor vanish
            units = _units(np.ldexp(values, -np.frexp(largest)[1]))
            h1, h2 = _hashes(values)
            if with_vector:
                columns = [batch.column(0).take(pa.array(rows)), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), _lists(units)]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "h1", "h2", "vec"])
            else:
                a, b = np.zeros((2, len(batch)), np.int64)
                a[rows], b[rows] = h1, h2
                gone = np.ones(len(batch), bool)
                gone[rows] = False
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(a, mask=gone), pa.array(b, mask=gone)], names=["key", "h1", "h2"])

    schema = f"key {kind}, h1 long, h2 long" + (", vec array<double>" if with_vector else "")
    return vectors.select(F.col(f"`{key}`"), F.col(f"`{column}`")).mapInArrow(run, schema)


def reference_points(classes: DataFrame, dim: int) -> np.ndarray:
    """A bounded sample of the distinct vectors, far from each other, as rows of a matrix."""
    n = classes.count()
    wanted = int(min(MOST_POINTS, max(LEAST_POINTS, np.ceil((LIST_SHARE * n) ** (1 / 3)))))
    sample = classes.orderBy("h1", "h2").limit(2 * wanted).select("vec").toArrow()
    points = np.zeros((0, dim))
    for start in range(0, sample.num_rows, 256):
        new = _matrix(sample.column("vec").slice(start, 256), dim)
        new = new[(new @ points.T < APART).all(axis=1)] if len(points) else new
        near, chosen = new @ new.T >= APART, []
        for i in range(len(new)):
            if not near[i, chosen].any():
                chosen.append(i)
        points = np.concatenate([points, new[chosen]])[:wanted]
    return points


def described(classes: DataFrame, dim: int) -> DataFrame:
    """uid, h1, h2, copies, least, vec and the nearest reference points in order, as a written table."""
    shared = classes.sparkSession.sparkContext.broadcast(reference_points(classes, dim))

    def run(batches):
        points = shared.value
        m = min(NEAREST, len(points))
        for batch in batches:
            close = _matrix(batch.column(0), dim) @ points.T
            first = np.argpartition(-close, m - 1, axis=1)[:, :m] if m < len(points) else np.tile(np.arange(m), (len(close), 1))
            order = np.take_along_axis(first, np.argsort(-np.take_along_axis(close, first, 1), axis=1, kind="stable"), 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, _lists(order.astype(np.int32))], names=[*batch.schema.names, "nearest"])

    columns = ["vec", "uid", "h1", "h2", "copies"]
    found = classes.select(*columns).mapInArrow(run, "vec array<double>, uid long, h1 long, h2 long, copies long, nearest array<int>")
    return written(found, "described")


def on_lists(index: DataFrame) -> DataFrame:
    """(list, uid): every three reference points of each description."""
    sorted_points = F.array_sort(F.col("nearest").cast("array<bigint>"))
    points = index.select("uid", sorted_points.alias("p"))
    keys = [
        F.shiftleft(F.get("p", F.lit(i)), 42).bitwiseOR(F.shiftleft(F.get("p", F.lit(j)), 21)).bitwiseOR(F.get("p", F.lit(k)))
        for i, j, k in combinations(range(NEAREST), 3)
    ]
    few = F.array(F.aggregate("p", F.lit(0).cast("long"), lambda s, x: s * (1 << 14) + x))  # fewer than three points at all
    full = F.filter(F.array(*keys), lambda x: x.isNotNull())
    return points.select("uid", F.explode(F.when(F.size("p") < 3, few).otherwise(full)).alias("list"))


def around_centre(members: DataFrame, group: str, dim: int, cosine: float) -> DataFrame:
    """``members`` (group, uid, vec, further columns) with ``core``: true within half the angle of the threshold of
    the group's mean direction, so any two such members are within the whole angle of each other."""
    half = np.sqrt((1 + cosine) / 2) + 1e-9
    centres = members.groupBy(F.col(group).alias("_g")).agg(F.array(*[F.sum(F.col("vec")[i]) for i in range(dim)]).alias("_mean"))
    joined = members.join(centres, F.col(group) == F.col("_g"))

    def dot(a: str, b: str):
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)

    core = F.col("_dot") >= half * F.sqrt(F.col("_square"))
    return joined.withColumns({"_dot": dot("vec", "_mean"), "_square": dot("_mean", "_mean")}).withColumn("core", core).drop("_g", "_mean", "_dot", "_square")


def met_in_blocks(rows: DataFrame, dim: int, cosine: float) -> DataFrame:
    """(uid, n, root) for groups of bounded size: rows (g, i, j, ask, answer, told, part, uid, copies, vec).

    Within a group, rows that ask are compared with rows that answer, in the same ``part`` only. ``n`` adds the copies
    of the other rows linked, for rows that ask and for those to be told who asked; ``root`` is the smallest uid that
    links of the group reach."""

    def run(table: pa.Table) -> pa.Table:
        vec = _matrix(table.column("vec"), dim)
        uid, part, copies = (table.column(c).to_numpy() for c in ("uid", "part", "copies"))
        ask, answer = (np.flatnonzero(table.column(c).to_numpy(zero_copy_only=False)) for c in ("ask", "answer"))
        near = (vec[ask] @ vec[answer].T >= cosine) & (part[ask][:, None] == part[answer][None, :]) & (uid[ask][:, None] != uid[answer][None, :])
        n = np.zeros(len(uid), np.int64)
        n[ask] = near @ copies[answer]
        told = table.column("told").to_numpy(zero_copy_only=False)[answer]
        n[answer[told]] = copies[ask] @ near[:, told]
        root = uid.copy()
        while True:
            top = np.iinfo(np.int64).max
            seen = np.where(near, root[answer][None, :], top).min(axis=1, initial=top)
            fresh = root.copy()
            fresh[ask] = np.minimum(fresh[ask], seen)
            back = np.where(near, fresh[ask][:, None], top).min(axis=0, initial=top)
            np.minimum.at(fresh, answer, back)
            if (fresh == root).all():
                break
            root = fresh
        some = (n > 0) | (root != uid)
        return pa.table({"uid": uid[some], "n": n[some], "root": root[some]})

    return rows.groupBy("g", "i", "j").applyInArrow(run, "uid long, n long, root long")


def blocks(members: DataFrame, group: str, sizes: DataFrame) -> DataFrame:
    """Rows for ``met_in_blocks``: askers meet all members of their group, block by block. Members that don't ask
    are told; those that ask count by their own questions alone.

    ``members``: group, uid, copies, vec, ask. ``sizes``: group, members and askers of it."""
    table = members.join(sizes.select(F.col(group).alias("_g"), "n_members", "n_askers"), F.col(group) == F.col("_g"))
    place = F.xxhash64("uid", F.lit(17))
    across, down = F.ceil(F.col("n_members") / BLOCK).cast("int"), F.ceil(F.col("n_askers") / BLOCK).cast("int")
    own_i, own_j = F.pmod(place, down).cast("int"), F.pmod(place, across).cast("int")
    keep = ["uid", "copies", "vec", F.lit(0).cast("long").alias("part")]
    asking = table.where("ask").select(F.col(group).alias("g"), own_i.alias("i"), F.explode(F.sequence(F.lit(0), across - 1)).alias("j"), F.lit(True).alias("ask"), F.lit(False).alias("answer"), F.lit(False).alias("told"), *keep)
    telling = table.select(F.col(group).alias("g"), F.explode(F.sequence(F.lit(0), down - 1)).alias("i"), own_j.alias("j"), F.lit(False).alias("ask"), F.lit(True).alias("answer"), (~F.col("ask")).alias("told"), *keep)
    return asking.unionByName(telling)


def group_sizes(members: DataFrame, group: str) -> DataFrame:
    asks = F.sum(F.col("ask").cast("long")).alias("n_askers")
    return members.groupBy(group).agg(F.count(F.lit(1)).alias("n_members"), asks).where("n_askers > 0")


def verified(pairs: DataFrame, index: DataFrame, dim: int, cosine: float) -> DataFrame:
    """The pairs (a, b) whose cosine is at least ``cosine``."""

    def run(batches):
        for batch in batches:
            x, y = (_matrix(batch.column(i), dim) for i in (2, 3))
            near = pa.array(np.einsum("ij,ij->i", x, y) >= cosine)
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(near) for i in (0, 1)], names=["a", "b"])

    left, right = (index.select(F.col("uid").alias(i), F.col("vec").alias(f"v{i}")) for i in "ab")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "va", "vb").mapInArrow(run, "a long, b long")


def members_of_lists(index: DataFrame) -> DataFrame:
    """(list, uid, c): every list of two vectors or more with its length."""
    listed = on_lists(index)
    lengths = listed.groupBy("list").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    return written(listed.join(lengths, "list"), "members")


def links_of_lists(members: DataFrame, index: DataFrame, dim: int, cosine: float) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) that join nearly all components the lists can see, and the uids that another stood for in them."""
    vectors = index.select("uid", "vec", "copies")
    stars, spared = [], index.select("uid").limit(0)

    def homes(rows: DataFrame) -> DataFrame:
        """Each vector of a crowd in its longest list, with its vector."""
        longest_list = rows.where(F.col("c") > CROWD).groupBy("uid").agg(F.max(F.struct("c", "list")).alias("_h"))
        return longest_list.select("uid", F.col("_h.list").alias("list")).join(vectors, "uid")

    crowd = written(homes(members), "crowd")
    if not crowd.isEmpty():
        core = around_centre(crowd, "list", dim, cosine).where("core").select("list", "uid")
        core = written(core, "core")
        first = core.groupBy("list").agg(F.min("uid").alias("a"))
        star = written(core.join(first, "list").select("a", F.col("uid").alias("b")).where("a != b"), "stars")
        stars.append(star)
        spared = star.select(F.col("b").alias("uid")).distinct()
        rest = members.drop("c").join(star.select(F.col("b").alias("uid")), "uid", "left_anti")
        rest = written(rest, "members")
        lengths = rest.groupBy("list").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
        members = written(rest.join(lengths, "list"), "members")
        crowd = homes(members).withColumn("ask", F.lit(True))
        crowd = written(crowd, "crowd")
        met = met_in_blocks(blocks(crowd, "list", group_sizes(crowd, "list")), dim, cosine)
        stars.append(written(met.where("uid != root").select(F.col("root").alias("a"), F.col("uid").alias("b")), "stars"))
    short = members.where(F.col("c") <= CROWD)
    a, b = (short.select("list", F.col("uid").alias(name)) for name in "ab")
    pairs = a.join(b, "list").where("a < b").select("a", "b")
    long = members.where(F.col("c") > CROWD)
    first = long.groupBy("list").agg(F.min("uid").alias("a"))
    pairs = pairs.unionByName(long.join(first, "list").where("a != uid").select("a", F.col("uid").alias("b"))).distinct()
    found = verified(pairs, index, dim, cosine)
    for star in stars:
        found = found.unionByName(star)
    return found, spared


def links_across(members: DataFrame, index: DataFrame, labels: DataFrame, spared: DataFrame, dim: int, cosine: float) -> DataFrame:
    """(a, b): the links between components ``labels`` (id, label) that ``links_of_lists`` left open in the lists."""
    named = members.join(labels.withColumnRenamed("id", "uid"), "uid", "left").withColumn("label", F.coalesce("label", "uid"))
    named = named.join(spared.withColumn("spared", F.lit(True)), "uid", "left").withColumn("spared", F.coalesce("spared", F.lit(False)))
    parts = named.groupBy("list", "label").agg(F.count(F.lit(1)).alias("m"), F.max("spared").alias("some"))
    mixed = parts.groupBy("list").agg(F.max(F.struct("m", "label"))["label"].alias("top"), F.count(F.lit(1)).alias("k"), F.max("some").alias("some"))
    rows = written(named.join(mixed.where("k > 1"), "list").where((F.col("c") > CROWD) | F.col("some")), "mixed")
    long = rows.where(F.col("c") > CROWD).select("list", "uid", (F.col("label") != F.col("top")).alias("ask"))
    met = met_in_blocks(blocks(long.join(index.select("uid", "vec", "copies"), "uid"), "list", group_sizes(long, "list")), dim, cosine)
    short = rows.where(F.col("c") <= CROWD)
    a, b = (short.select("list", F.col("uid").alias(n), F.col("label").alias(f"l{n}"), F.col("spared").alias(f"s{n}")) for n in "ab")
    pairs = a.join(b, "list").where("a < b and la != lb and (sa or sb)").select("a", "b").distinct()
    return verified(pairs, index, dim, cosine).unionByName(met.where("uid != root").select(F.col("root").alias("a"), F.col("uid").alias("b")))


def counted(labelled: DataFrame, dim: int, cosine: float) -> DataFrame:
    """uid, n: the rows linked with each vector, of vectors (uid, label, copies, vec) in components ``label``."""
    sizes = labelled.groupBy("label").agg(F.count(F.lit(1)).alias("m"))
    rows = written(labelled.join(sizes, "label"), "labelled")
    total = rows.where(F.col("m") <= BLOCK).count()
    small = rows.where(F.col("m") <= BLOCK).select(
        F.pmod(F.xxhash64("label"), F.lit(total // BLOCK + 1)).alias("g"), F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(True).alias("ask"),
        F.lit(True).alias("answer"), F.lit(False).alias("told"), "uid", "copies", "vec", F.col("label").alias("part"),
    )
    found = met_in_blocks(small, dim, cosine).select("uid", "n")
    large = written(around_centre(rows.where(F.col("m") > BLOCK), "label", dim, cosine), "large")
    inside = large.where("core").groupBy(F.col("label").alias("_l")).agg(F.sum("copies").alias("_all"))
    proven = large.where("core").join(inside, F.col("label") == F.col("_l")).select("uid", (F.col("_all") - F.col("copies")).alias("n"))
    asking = large.withColumn("ask", ~F.col("core"))
    rest = met_in_blocks(blocks(asking, "label", group_sizes(asking, "label")), dim, cosine).select("uid", "n")
    return found.unionByName(proven).unionByName(rest).groupBy("uid").agg(F.sum("n").alias("n"))


def near_classes(vectors: DataFrame, cosine: float = 0.95, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """key, n_links (other rows linked directly), component_id (smallest key of the component), kept."""
    dim = longest(vectors, column)
    usable = hashed_rows(vectors, key, column, dim, True)
    least = F.min(F.struct(F.col("key").isNull().alias("null"), "key")).alias("least")
    same = usable.groupBy("h1", "h2").agg(F.first("vec").alias("vec"), F.count(F.lit(1)).alias("copies"), least)
    same = written(same.withColumn("uid", F.monotonically_increasing_id()), "distinct")
    index = described(same, dim)
    members = members_of_lists(index)
    links, spared = links_of_lists(members, index, dim, cosine)
    links = written(links, "links")
    labels = written(components(links), "labels")
    more = written(links_across(members, index, labels, spared, dim, cosine), "links")
    if not more.isEmpty():
        labels = written(components(links.unionByName(more)), "labels")
    labelled = labels.withColumnRenamed("id", "uid").join(index.select("uid", "copies", "vec"), "uid")
    n = counted(labelled, dim, cosine)
    ends = same.select("uid", "h1", "h2", "copies", "least").join(labels.withColumnRenamed("id", "uid"), "uid", "left").withColumn("label", F.coalesce("label", "uid"))
    smallest = ends.groupBy(F.col("label").alias("_l")).agg(F.min("least").alias("_least"))
    result = ends.join(smallest, F.col("label") == F.col("_l")).join(n, "uid", "left").select(
        F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.col("_least.key").alias("component_id"), F.lit(True).alias("_met")
    )
    result = written(result, "classes")
    rows = hashed_rows(vectors, key, column, dim, False)
    joined = rows.join(result, (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")), "left")
    component = F.when(F.col("_met"), F.col("component_id")).otherwise(F.col("key"))
    return joined.select(F.col("key").alias(key), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id")).withColumn(
        "kept", F.col(key).eqNullSafe(F.col("component_id"))
    )
