"""Document fingerprints: the k smallest hashes of a text's word shingles.

Sketches are sorted arrays of 48-bit hashes. They merge by keeping the k smallest of their union,
and estimate the resemblance and containment of shingle sets and the number of distinct
shingles; where a sketch has fewer than k hashes, it holds the whole set and is exact.

Edge cases: a null text is the empty text; a text without words has the empty sketch,
which resembles another empty one fully and any other not at all; a text of fewer words than a shingle
has one shingle, its whole word sequence; equal texts have equal sketches; in ``edited_pairs``
rows with equal ids follow each other by text, null ids come last, a single row follows itself, and the
empty table gives the empty table; further columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from evgraph.session import written

WIDTH, SIZE, HASH_BITS = 5, 256, 48
_SPACES = " \t\n\x0b\f\r"


def with_sketch(rows: DataFrame, text: str, name: str, width: int = WIDTH, size: int = SIZE) -> DataFrame:
    """``rows`` with the sketch of column ``text``. Every step is a column of its own, so that
    Spark computes it once."""
    trimmed = F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(_SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \\t\\n\\x0B\\f\\r]+"))
    w, s = f"_words_{name}", f"_shingles_{name}"

    def shingle(i: Column) -> Column:
        return F.shiftrightunsigned(F.xxhash64(*[F.get(F.col(w), i + j) for j in range(width)]), 64 - HASH_BITS)

    n = F.size(w)
    shingles = (
        F.when(n >= width, F.transform(F.sequence(F.lit(0), F.greatest(n - width, F.lit(0))), shingle))
        .when(n > 0, F.array(F.shiftrightunsigned(F.xxhash64(w), 64 - HASH_BITS)))
        .otherwise(F.array().cast("array<long>"))
    )
    # Of many shingles only those below a cut that twice the sketch's size is expected to pass
    # are sorted; should too few distinct ones pass, all are.
    cut = (F.lit(float(1 << HASH_BITS)) * 2 * size / F.greatest(F.size(s), F.lit(1))).cast("long")
    low, all_of_them = f"_low_{name}", F.slice(F.sort_array(F.array_distinct(s)), 1, size)
    return (
        rows.withColumn(w, F.transform(words, lambda word: F.xxhash64(word)))
        .withColumn(s, shingles)
        .withColumn(low, F.when(F.size(s) > 3 * size, F.slice(F.sort_array(F.array_distinct(F.filter(s, lambda h: h < cut))), 1, size)))
        .withColumn(name, F.when(F.size(low) >= size, F.col(low)).otherwise(all_of_them))
        .drop(w, s, low)
    )


def merged(a: Column, b: Column, size: int = SIZE) -> Column:
    """The sketch of the union of two sets."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, size)


def merge_parts(parts: DataFrame, by: str, sketch: str, size: int = SIZE) -> DataFrame:
    """One sketch for each ``by``: ranks are cut in each task before the shuffle."""
    order = Window.partitionBy(by).orderBy("_hash")
    hashes = parts.select(by, F.explode(sketch).alias("_hash")).distinct()
    kept = hashes.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= size)
    return kept.groupBy(by).agg(F.sort_array(F.collect_list("_hash")).alias(sketch))


def distinct_count(sketch: Column, size: int = SIZE) -> Column:
    full = (size - 1) * float(1 << HASH_BITS) / (F.element_at(sketch, size) + 1)
    return F.when(F.size(sketch) < size, F.size(sketch).cast("double")).otherwise(full)


def resemblance(a: Column, b: Column, size: int = SIZE) -> Column:
    """|A and B| / |A or B|; 1 for two empty sets."""
    union = merged(a, b, size)
    both = F.array_intersect(F.array_intersect(union, a), b)
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(F.size(both) / F.size(union))


def containment(a: Column, b: Column, size: int = SIZE) -> Column:
    """|A and B| / |A|; 1 for an empty A."""
    ratio = resemblance(a, b, size) * distinct_count(merged(a, b, size), size) / distinct_count(a, size)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), ratio))


def as_text(sketch: Column) -> Column:
    """Twelve hexadecimal digits for each hash."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.lower(F.hex(h)), HASH_BITS // 4, "0")), "")


def blocks(ids: DataFrame, key: str, number: int) -> Column:
    """An expression that cuts the order of descending ``key`` into about ``number`` even blocks; null keys
    come last. Only the block bounds reach the driver."""
    shares = [i / number for i in range(1, number)]
    found = ids.select(F.percentile_approx(key, shares, 100 * number).alias("b")).first()[0] if shares else None
    bounds = sorted(set(found or []), reverse=True)
    step = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    if not groups:
        return F.when(F.col(key).isNull(), 1).otherwise(0)
    # first among every step-th bound, then inside that group
    heads = F.array(*[F.lit(g[0]) for g in groups])
    inner = F.array(*[F.array(*map(F.lit, g)) for g in groups])
    group = F.size(F.filter(heads, lambda b: b > F.col(key)))
    inside = F.size(F.filter(F.get(inner, group - 1), lambda b: b > F.col(key)))
    place = F.when(group == 0, 0).otherwise((group - 1) * step + inside)
    return F.when(F.col(key).isNull(), len(bounds) + 1).otherwise(place)


def with_next(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, text, sketch, and the next row's text and sketch in descending order of ``key``; the first
    row follows the last.

    The order is cut into blocks, one shuffle brings a block together, and the first row of
    each block also closes the block before it, so no window spans the table."""
    spark = docs.sparkSession
    number = min(65_536, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    block = blocks(docs.select(key), key, number)
    rows = docs.select(F.col(key), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), block.alias("_block"))
    heads = written(rows.groupBy("_block").agg(F.max(key).alias("_head")), "heads")  # at most one row a block
    around = Window.orderBy("_block")
    last = F.max("_block").over(Window.partitionBy())
    heads = heads.withColumn("_closes", F.coalesce(F.lag("_block").over(around), last))
    same = rows["_block"].eqNullSafe(heads["_block"]) & rows[key].eqNullSafe(heads["_head"])
    firsts = rows.join(F.broadcast(heads.select("_block", "_head", "_closes")), same).select(
        rows[key], rows["text"], F.col("_closes").alias("_block")
    )
    first = Window.partitionBy("_block").orderBy(F.desc("text"))
    firsts = firsts.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
    both = rows.withColumn("_tail", F.lit(0)).unionByName(firsts.withColumn("_tail", F.lit(1)))
    dealt = with_sketch(both.repartition("_block"), "text", "sketch")
    order = Window.partitionBy("_block").orderBy("_tail", F.desc_nulls_last(key), F.desc("text"))
    follows = dealt.select(
        key, "text", "sketch", "_tail", F.lead("text").over(order).alias("next_text"), F.lead("sketch").over(order).alias("next_sketch")
    )
    return follows.where("_tail = 0").drop("_tail")


def edited_pairs(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Every document's fingerprint, that of its text with the last third replaced by the
    beginning of the next document, and their likeness."""
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    rows = with_next(docs, key)
    rows = rows.withColumn("n_chars", n.cast("long")).withColumn(
        "edited", F.concat(F.substr("text", F.lit(1), n - third), F.substr("next_text", F.lit(1), third))
    )
    rows = with_sketch(rows.drop("next_text"), "edited", "edited_sketch")
    return rows.select(
        key,
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        distinct_count(F.col("sketch")).alias("distinct_shingles"),
        containment(F.col("edited_sketch"), F.col("sketch")).alias("edited_inside"),
    )
