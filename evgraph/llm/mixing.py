"""Mixing sources to target weights: nested histograms of hashes give each source a threshold.

A source whose target is r times its size gives every document floor(r) times and those
below a hash threshold once more. The threshold comes from sums of sizes by (source, leading
hash digit): the digit in which the budget runs out is refined by the next digit, only that
bucket, until the hash is used up. Rows are never sorted, only aggregated and filtered, and
the result depends on nothing but the rows, so reruns agree.

Edge cases: null texts have size 0; the null source is a source, last in order; rows that share
id and text share a hash and are taken or left together; sources without a word have target 0;
the empty table gives the empty table; further columns are left out of ``mix`` and kept by
``resample``, whatever their names, in which a row's number of repeats is ``taken`` over ``size``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from evgraph.session import written

WEIGHTS = (5.0, 2.0, 1.0)  # by a source's place in order, repeating
MOST = 3.0  # no source, and so no document, is taken more often
DIGIT_BITS, DIGITS = 14, 4  # 56 bits of hash


def words(text: Column) -> Column:
    """Number of runs of characters other than \\x20 and \\x09-\\x0D."""
    spaces = " \t\n\x0b\f\r"
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(spaces))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, "[ \\t\\n\\x0B\\f\\r]+"))).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target: shares by weight of the sum of all sizes, none above
    ``MOST`` times its source's size; what is above is shared anew by weight. Works on one row per source."""
    by_code_point = Window.orderBy(F.col("source").isNull(), F.col("source"))
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = (F.row_number().over(by_code_point) - 1) % len(WEIGHTS)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), place + 1)
    sources = written(sources.withColumn("weight", weight), "sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, most = 0.0, MOST * F.col("source_size")
    while True:  # the level rises until no further source is capped
        capped = F.col("weight") * level >= most
        held, free = sources.agg(
            F.sum(F.when(capped, most).otherwise(0.0)), F.sum(F.when(capped, 0.0).otherwise(F.col("weight")))
        ).first()
        rising = (total - held) / free if free else level
        if not free or rising <= level * (1 + 1e-12):
            break
        level = rising
    return sources.select("source", "source_size", F.least(F.col("weight") * level, most).alias("target"))


def thresholds(sizes: DataFrame, budgets: DataFrame) -> DataFrame:
    """source, threshold, of ``sizes`` (source, size, hash) and ``budgets`` (source, budget):
    the sizes of the rows with a hash below the threshold sum to about the budget.

    A source whose rows at one hash hold the boundary takes them if that lands nearer."""
    rests = written(budgets.select(F.col("source").alias("_s"), F.col("budget").cast("double").alias("_rest")), "rests")
    rows = sizes.select("source", "size", "hash")
    for digit in range(1, DIGITS + 1):
        bucket = F.shiftright("hash", DIGIT_BITS * (DIGITS - digit)).alias("_bucket")
        sums = rows.groupBy("source", bucket).agg(F.sum("size").alias("_n"))
        sums = sums.join(rests, F.col("source").eqNullSafe(F.col("_s"))).drop("source")
        before = Window.partitionBy("_s").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("_left", F.col("_rest") - F.coalesce(F.sum("_n").over(before), F.lit(0)))
        # the first bucket that is not wholly inside the budget, else the last bucket
        first = F.min(F.when(F.col("_n") > F.col("_left"), F.struct("_bucket", "_left", "_n")))
        last = F.max(F.struct("_bucket", "_left", "_n"))
        rests = written(sums.groupBy("_s").agg(F.coalesce(first, last).alias("_cut")).select("_s", "_cut.*").withColumnRenamed("_left", "_rest"), "boundary")
        if digit < DIGITS:
            edge = rests.select(F.col("_s").alias("_t"), F.col("_bucket").alias("_edge"))
            rows = rows.withColumn("_b", bucket).join(edge, F.col("source").eqNullSafe(F.col("_t")) & (F.col("_b") == F.col("_edge")))
            rows = written(rows.select("source", "size", "hash"), "edge")
            rests = rests.select("_s", "_rest")
    past = F.when(F.col("_n") <= 2 * F.col("_rest"), 1).otherwise(0)
    return rests.select(F.col("_s").alias("source"), (F.col("_bucket") + past).alias("threshold"))


def hashed(key: str) -> Column:
    """56 bits that decide whether a row is taken once more."""
    return F.shiftrightunsigned(F.xxhash64(F.col(key).cast("string"), "text"), 64 - DIGIT_BITS * DIGITS)


def plan(sizes: DataFrame) -> DataFrame:
    """_source, source_size, target, whole, threshold: one row per source."""
    repeats = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    shares = targets(sizes).withColumn("whole", F.floor(repeats + 1e-9))
    shares = written(shares.withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size")), "shares")
    lines = thresholds(sizes.where("size > 0"), shares.where("budget > 0 and source_size > 0").select("source", "budget"))
    lines = lines.withColumnRenamed("source", "_s")
    joined = shares.join(lines, F.col("source").eqNullSafe(F.col("_s")), "left")
    threshold = F.coalesce("threshold", F.lit(0).cast("long")).alias("threshold")
    return written(joined.select(F.col("source").alias("_source"), "source_size", "target", "whole", threshold), "mix")


def measured(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, source, size and hash of every row, as a narrow written table."""
    return written(docs.select(key, "source", words(F.col("text")).alias("size"), hashed(key).alias("hash")), "sizes")


def mix(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, size, source_size, target and taken (words the mix takes, repeats counted)."""
    sizes = measured(docs, key)
    taken = F.col("size") * (F.col("whole") + F.when(F.col("hash") < F.col("threshold"), 1).otherwise(0))
    return sizes.join(plan(sizes), F.col("source").eqNullSafe(F.col("_source"))).select(
        key, "size", "source_size", "target", taken.cast("long").alias("taken")
    )


def resample(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of the mix with their own columns: each as often as it is taken. Rows
    without a word carry no weight and stay once."""
    name = "_" * (1 + max(map(len, docs.columns))) + "mix"  # longer than any given
    lines = plan(measured(docs, key)).select(F.struct("_source", "whole", "threshold").alias(name))
    times = F.col(f"{name}.whole") + F.when(hashed(key) < F.col(f"{name}.threshold"), 1).otherwise(0)
    times = F.when(words(F.col("text")) == 0, 1).otherwise(times).cast("int")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return (
        docs.join(lines, F.col("source").eqNullSafe(F.col(f"{name}._source")))
        .select(*columns, F.explode(F.array_repeat(F.lit(0), times)).alias(name))
        .select(*columns)
    )
