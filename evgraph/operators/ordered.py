"""Ordered computations over groups too large for one task.

A window over a key sorts the whole group in one task. Here the group is cut into
buckets along its order; rows are windowed inside (key, bucket), and
one summary row per bucket carries what earlier buckets contribute. ``with_buckets`` cuts each hot
key at quantiles of its own order, so it does not matter how that order is spread.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

_BUCKET = "_bucket"
ROWS = 65_536  # rows of a key that stay together
MOST_PARTS = 1024  # buckets of a key at most: its summary rows are windowed in one task
DRAWN = 16  # rows drawn for each bucket to place its ends


def with_buckets(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, rows: int = ROWS) -> DataFrame:
    """``df`` with a bucket number that never falls along ``order`` within a key; keys of at most ``rows`` rows are one
    bucket, larger ones are cut at quantiles of a sample of their own rows.

    Rows are drawn by a hash of key and order, ``DRAWN`` a bucket, so a key's sample is bounded and a rerun cuts alike.
    The sample only places the ends: every row gets a bucket, whatever was drawn. Rows equal in ``order`` share one.
    """
    named = [f"_k{i}" for i in range(len(keys))]
    place = F.struct(*order)

    def same(side: DataFrame, other: DataFrame) -> list[Column]:
        return [side[k].eqNullSafe(other[n]) for k, n in zip(keys, named)]

    counts = df.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, named)]).agg(F.count(F.lit(1)).alias("_n"))
    parts = F.least(F.ceil(F.col("_n") / rows), F.lit(MOST_PARTS)).cast("int")
    hot = counts.where(F.col("_n") > rows).withColumn("_parts", parts)
    drawn = df.select(*keys, *[c for c in order if c not in keys]).join(hot, same(df, hot))
    drawn = drawn.where(F.pmod(F.xxhash64(*keys, *order), F.col("_n")) < F.col("_parts") * DRAWN)
    drawn = drawn.groupBy(*named, "_parts").agg(F.sort_array(F.collect_set(place)).alias("_drawn"))
    step = F.size("_drawn") / F.col("_parts")
    cut = F.transform(F.sequence(F.lit(1), F.col("_parts") - 1), lambda i: F.col("_drawn")[F.floor(i * step).cast("int")])
    ends = drawn.select(*named, F.array_distinct(cut).alias("_ends"))

    def halved(low: Column, width: Column) -> Column:
        """``low`` moved past ``width`` more ends, where the last of them does not lie after the row."""
        end = F.get("_ends", low + width - 1)
        return F.when(end.isNotNull() & (end <= place), low + width).otherwise(low)

    # number of ends at or before the row, by halving
    widths = F.array(*[F.lit(1 << i) for i in reversed(range(MOST_PARTS.bit_length()))])
    number = F.when(F.col("_ends").isNull(), 0).otherwise(F.aggregate(widths, F.lit(0), halved))
    return df.join(ends, same(df, ends), "left").withColumn(name, number).drop(*named, "_ends")


def _attach(rows: DataFrame, summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    on = [*keys, _BUCKET]
    side = summary.select(*[F.col(c).alias(f"_s_{c}") for c in on], "_carry")
    same = [rows[c].eqNullSafe(side[f"_s_{c}"]) for c in on]
    return rows.join(side, same, "left").drop(*[f"_s_{c}" for c in on])


def with_previous(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, bucket: Column, name: str
) -> DataFrame:
    """``name`` = ``value`` of the preceding row of the key, null on its first row."""
    rows = df.withColumn(_BUCKET, bucket)
    inside = Window.partitionBy(*keys, _BUCKET).orderBy(*order)
    across = Window.partitionBy(*keys).orderBy(_BUCKET)
    summary = rows.groupBy(*keys, _BUCKET).agg(
        F.max_by(F.struct(F.col(value).alias("v")), F.struct(*order)).alias("_last")
    )
    summary = summary.withColumn("_carry", F.lag("_last").over(across))
    rows = rows.withColumn("_lag", F.lag(F.struct(F.col(value).alias("v"))).over(inside))
    return (
        _attach(rows, summary, keys)
        .withColumn(name, F.coalesce("_lag", "_carry")["v"])
        .drop("_lag", "_carry", _BUCKET)
    )


def with_running_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, bucket: Column, name: str
) -> DataFrame:
    """``name`` = sum of ``value`` over the key up to and including the row."""
    rows = df.withColumn(_BUCKET, bucket)
    inside = Window.partitionBy(*keys, _BUCKET).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    across = Window.partitionBy(*keys).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    summary = rows.groupBy(*keys, _BUCKET).agg(F.sum(value).alias("_total"))
    summary = summary.withColumn("_carry", F.coalesce(F.sum("_total").over(across), F.lit(0)))
    rows = rows.withColumn("_run", F.sum(value).over(inside))
    return (
        _attach(rows, summary, keys)
        .withColumn(name, F.col("_run") + F.col("_carry"))
        .drop("_run", "_carry", _BUCKET)
    )


def with_last_known(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, bucket: Column, name: str
) -> DataFrame:
    """``name`` = the latest non-null ``value`` of the key up to and including the row."""
    rows = df.withColumn(_BUCKET, bucket)
    inside = Window.partitionBy(*keys, _BUCKET).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    across = Window.partitionBy(*keys).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    known = F.when(F.col(value).isNotNull(), F.struct(*order))
    summary = rows.groupBy(*keys, _BUCKET).agg(F.max_by(F.col(value), known).alias("_last"))
    summary = summary.withColumn("_carry", F.last("_last", ignorenulls=True).over(across))
    rows = rows.withColumn("_run", F.last(value, ignorenulls=True).over(inside))
    return (
        _attach(rows, summary, keys)
        .withColumn(name, F.coalesce("_run", "_carry"))
        .drop("_run", "_carry", _BUCKET)
    )
