"""Line dedup: a line goes when an earlier line of the corpus equals it or, from ``near`` characters on,
is within ``most`` edits of it.

Lines are ordered by (doc_id, place). Equal lines collapse to their first occurrence; distinct ones
meet by segments: a line cut into ``most`` + 1 even segments keeps one of them whole under
``most`` edits, so every line looks, for every length that fits, for those segments at the places
where the edits before and after can have moved them. Segments shared by many lines do not pair
them all: those lines look again with what is left of them beside the segment, which is within
``most`` edits too. Keys are counted before any line is joined with another: most belong to one line alone.
Pairs are verified by a banded edit distance that steps over the characters with one bit vector per
number of edits, a bit for each diagonal.

Exact repeats go at any length from ``least`` characters; lines of spaces alone stay. Under two edits all lines of two
characters are alike, so the edits are counted only between two lines of at least ``near`` characters.

Edge cases: a null text stays null and has no line; null ids come last in order; rows equal in
id and text are one document and keep the same lines; ties of id are ordered by a hash of
id and text; line ends are ``\\n`` alone; the empty table gives the empty table; further columns
are kept by ``dedup``, whatever their names, and left out of ``report``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from evgraph.functions.text import let
from evgraph.session import passing, written

MOST, LEAST, NEAR = 2, 1, 20
CROWD, LEVELS = 32, 4  # lines that share a segment are paired up to this number, else look again


def document_key() -> Column:
    return F.xxhash64(F.col("doc_id").cast("string"), "text")


def occurrences(docs: DataFrame, least: int) -> DataFrame:
    """(doc_id, _doc, pos, line) of every line that takes part."""
    lines = docs.select("doc_id", document_key().alias("_doc"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return lines.where((F.length("line") >= least) & (F.length(F.btrim("line")) > 0))


def line_key() -> list[Column]:
    return [F.xxhash64("line").alias("h1"), F.hash("line").alias("h2")]  # 96 bits


def distinct_lines(found: DataFrame) -> DataFrame:
    """line_id, h1, h2, line, number and first of the occurrences of every distinct line, as a written table."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "_doc", "pos")).alias("first")
    lines = found.groupBy(*line_key()).agg(
        first, F.any_value("line").alias("line"), F.count(F.lit(1)).alias("n")
    )
    return written(lines.select(F.monotonically_increasing_id().alias("line_id"), "*"), "lines")


def shifts(most: int) -> list[tuple[int, int, int]]:
    """(characters by which the other line is shorter, segment from 1, shift of its place) that a line looks for."""
    return [
        (shorter, i, shift)
        for shorter in range(most + 1)
        for i in range(1, most + 2)
        for shift in range(max(1 - i, shorter - (most + 1 - i)), min(i - 1, shorter + most + 1 - i) + 1)
    ]


def looks(rows: DataFrame, most: int) -> DataFrame:
    """(row, line_id, key, at, size, own): every segment that a text has (own) or looks for in texts up to ``most``
    characters shorter; ``at`` is its place in this text. Segments are even, the last ones longer. Texts too short
    to be cut meet under their tag."""
    parts = most + 1
    kinds = F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip(("shorter", "i", "shift"), kind)]) for kind in shifts(most)])
    cut = rows.where(F.length("x") > most).select("*", F.length("x").alias("m"), F.inline(kinds))
    cut = cut.withColumn("n", F.col("m") - F.col("shorter"))
    cut = cut.withColumn("least", F.floor(F.col("n") / parts).cast("int"))
    cut = cut.withColumn("plain", parts - (F.col("n") - F.col("least") * parts))  # so many segments are not longer
    at = F.col("least") * (F.col("i") - 1) + F.greatest(F.lit(0), F.col("i") - 1 - F.col("plain")) + F.col("shift")
    size = F.col("least") + (F.col("i") > F.col("plain")).cast("int")
    cut = cut.withColumns({"at": at, "size": size})
    cut = cut.where((F.col("size") > 0) & (F.col("at") >= 0) & (F.col("at") + F.col("size") <= F.col("m")))
    key = F.xxhash64("tag", "i", "n", F.substr("x", F.col("at") + 1, F.col("size")))
    own = (F.col("shorter") == 0) & (F.col("shift") == 0)
    cut = cut.select("row", "line_id", key.alias("key"), "at", "size", own.alias("own"))
    whole = [F.xxhash64("tag").alias("key"), F.lit(0).alias("at"), F.lit(0).alias("size"), F.lit(True).alias("own")]
    return cut.unionByName(rows.where(F.length("x") <= most).select("row", "line_id", *whole))


def candidates(lines: DataFrame, most: int) -> DataFrame:
    """(a, b), a < b: pairs of line ids that share a segment, at every level of a crowd.

    Keys are counted first, in each task before the shuffle, so a hot segment costs a row a task and the many keys
    of one line alone end there. A key of two rows is a pair already; the rows of the others are looked up again."""
    rows = lines.select(F.col("line_id").alias("row"), "line_id", F.col("line").alias("x"), F.lit(0).cast("long").alias("tag"))
    pairs = []
    for level in range(LEVELS):
        seen = looks(rows, most)
        counted = seen.groupBy("key").agg(
            F.count(F.lit(1)).alias("n"), F.max("own").alias("own"), F.min("line_id").alias("a"), F.max("line_id").alias("b")
        )
        shared = written(counted.where("n > 1 AND own AND a < b").drop("own"), f"shared-{level}")
        pairs.append(shared.where("n = 2").select("a", "b"))
        met = written(seen.join(shared.where("n > 2").select("key", "n"), "key"), f"segments-{level}")
        last = level == LEVELS - 1
        few = met if last else met.where(F.col("n") <= CROWD)
        own = few.where("own").select("key", F.col("line_id").alias("i"))
        other = few.select("key", F.col("line_id").alias("j"))
        pairs.append(own.join(other, "key").where("i != j").select(F.least("i", "j").alias("a"), F.greatest("i", "j").alias("b")))
        crowded = met.where(F.col("n") > CROWD)
        if last or crowded.isEmpty():
            break
        # what is left of a text beside the shared segment, with a mark in its place
        crowded = crowded.join(rows.select("row", "x"), "row")
        left = F.concat(F.substr("x", F.lit(1), F.col("at")), F.lit("\x01"), F.substr("x", F.col("at") + F.col("size") + 1))
        rest = crowded.select("line_id", left.alias("x"), F.col("key").alias("tag")).distinct()
        rows = written(rest.select(F.monotonically_increasing_id().alias("row"), "*"), f"crowd-{level}")
    return written(reduce(DataFrame.unionByName, pairs).distinct(), "pairs")


def within(a: Column, b: Column, most: int) -> Column:
    """Whether two texts are within ``most`` edits of each other.

    Bit d of vector e says that the first j - d + ``most`` characters of ``a`` turn into the first j of ``b``
    with at most e edits; each character of ``b`` moves all diagonals of the band at once. Characters are read
    from arrays, and once no diagonal is left nothing more is compared."""
    width = 2 * most + 1
    full = (1 << width) - 1
    m, n = F.length(a), F.length(b)
    edge = F.array_repeat(F.lit(""), 2 * most)  # equal to no character

    # before any character of b, the first i of a are dropped with i edits: diagonal -i
    start = F.struct(*[F.lit(sum(1 << (most - i) for i in range(e + 1))).alias(f"r{e}") for e in range(most + 1)])

    def walk(chars: Column) -> Column:
        def step(state: Column, j: Column) -> Column:
            c = F.get(chars["b"], j - 1)
            hits = [F.when(F.get(chars["a"], j + (3 * most - 1 - d)) == c, 1 << d).otherwise(0) for d in range(width)]
            old = [state[f"r{e}"] for e in range(most + 1)]

            def moved(match: Column) -> Column:
                new = [old[0].bitwiseAND(match)]
                for e in range(1, most + 1):
                    grown = old[e].bitwiseAND(match).bitwiseOR(old[e - 1]).bitwiseOR(F.shiftleft(old[e - 1], 1))
                    new.append(grown.bitwiseOR(F.shiftright(new[e - 1], 1)).bitwiseAND(F.lit(full)))
                return F.struct(*[v.cast("int").alias(f"r{e}") for e, v in enumerate(new)])

            return F.when(old[most] == 0, state).otherwise(let(reduce(Column.__add__, hits), moved))

        return F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), start, step)

    end = let(F.struct(F.concat(edge, F.split(a, ""), edge).alias("a"), F.split(b, "").alias("b")), walk)
    bit = F.getbit(end[f"r{most}"], F.least(F.greatest(n - m + most, F.lit(0)), F.lit(width - 1))) == 1
    return F.when(F.abs(n - m) > most, False).when((m == 0) | (n == 0), F.greatest(m, n) <= most).otherwise(bit)


def later_lines(lines: DataFrame, pairs: DataFrame, most: int) -> DataFrame:
    """line_id of every distinct line that has an earlier one within ``most`` edits."""
    ids = pairs.select(F.col("a").alias("line_id")).unionByName(pairs.select(F.col("b").alias("line_id"))).distinct()
    texts = written(lines.join(ids, "line_id", "left_semi").select("line_id", "line", "first"), "paired")
    a = texts.select(F.col("line_id").alias("a"), F.col("line").alias("line_a"), F.col("first").alias("first_a"))
    b = texts.select(F.col("line_id").alias("b"), F.col("line").alias("line_b"), F.col("first").alias("first_b"))
    near = pairs.join(a, "a").join(b, "b").where(within(F.col("line_a"), F.col("line_b"), most))
    return near.select(F.when(F.col("first_a") < F.col("first_b"), F.col("b")).otherwise(F.col("a")).alias("line_id")).distinct()


def removed_lines(docs: DataFrame, most: int = MOST, least: int = LEAST, near: int = NEAR) -> DataFrame:
    """(doc_id, _doc, gone): sorted places of the lines that go, one row per document that loses some."""
    with passing(docs.sparkSession) as paths:
        found = occurrences(docs, least)
        lines = distinct_lines(found)
        long = lines.where(F.length("line") >= near)
        late = later_lines(long, candidates(long, most), most)
        # a line without an earlier one like it, found once, removes nothing
        firsts = lines.select("line_id", "h1", "h2", "first", "n").join(late.withColumn("late", F.lit(True)), "line_id", "left")
        firsts = written(firsts.where("late OR n > 1").select("h1", "h2", "first", "late"), "late")
        own = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("_doc") == F.col("first._doc")) & (F.col("pos") == F.col("first.pos"))
        places = found.select("doc_id", "_doc", "pos", *line_key())
        gone = places.join(firsts, ["h1", "h2"]).where(~own | F.col("late"))
        removed = written(gone.groupBy("doc_id", "_doc").agg(F.sort_array(F.collect_set("pos")).alias("gone")), "removed")
        paths.pop()
    return removed


def with_kept(docs: DataFrame, most: int = MOST, least: int = LEAST, near: int = NEAR) -> tuple[DataFrame, str]:
    """``docs`` with one more column, and its name, which is longer than any given: a struct of ``n_lines``,
    ``n_removed`` and ``text``, what stays."""
    name = "_" * (1 + max(map(len, docs.columns))) + "kept"
    columns = [F.col(f"`{c}`") for c in docs.columns]
    gone = removed_lines(docs, most, least, near).select(F.struct("doc_id", "_doc", "gone").alias(name))
    same = F.col("doc_id").eqNullSafe(F.col(f"{name}.doc_id")) & (document_key() == F.col(f"{name}._doc"))
    places = F.coalesce(F.col(f"{name}.gone"), F.array().cast("array<int>"))
    lines = F.split("text", "\n")
    # one flag a line: runs of lines that stay, a mark for each that goes
    ends = F.concat(places, F.array(F.size(lines)))
    starts = F.concat(F.array(F.lit(0)), F.transform(places, lambda p: p + 1))
    runs = F.transform(F.arrays_zip(starts.alias("s"), ends.alias("e")), lambda r: F.repeat(F.lit("1"), r["e"] - r["s"]))
    flags = F.split(F.array_join(runs, "0"), "")
    flagged = F.filter(F.arrays_zip(lines.alias("line"), flags.alias("flag")), lambda x: x["flag"] == "1")
    text = F.array_join(F.transform(flagged, lambda x: x["line"]), "\n")
    kept = F.struct(
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.size(places).cast("long").alias("n_removed"),
        F.when(F.size(places) == 0, F.col("text")).otherwise(text).alias("text"),
    )
    return docs.join(gone, same, "left").select(*columns, kept.alias(name)), name


def report(docs: DataFrame, most: int = MOST, least: int = LEAST, near: int = NEAR) -> DataFrame:
    """doc_id, number of lines, number of those that go, hash of what stays."""
    rows, kept = with_kept(docs.select("doc_id", "text"), most, least, near)
    return rows.select(
        "doc_id", f"{kept}.n_lines", f"{kept}.n_removed",
        F.sha2(F.coalesce(F.col(f"{kept}.text"), F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


def dedup(docs: DataFrame, most: int = MOST, least: int = LEAST, near: int = NEAR) -> DataFrame:
    """The rows without the lines that go; ``n_chars``, if present, is that of the new text.
    A document that had words and keeps none goes."""
    rows, kept = with_kept(docs, most, least, near)
    text = F.col(f"{kept}.text")
    empty = (F.col(f"{kept}.n_removed") > 0) & (F.length(F.btrim(text, F.lit(" \t\n\x0b\f\r"))) == 0)
    changed = {"text": text, "n_chars": F.length(text).cast("long")}
    return rows.where(~F.coalesce(empty, F.lit(False))).select(*[changed.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
