"""Phrase collocation mining: word sequences that occur together more often than their parts suggest, by language.

Counting. Three passes over the texts, each adding up in its task before anything is shuffled. The first two find
which pairs, then which triples, can reach the least count at all: they count 64-bit hashes, and what reaches it marks
a bitmap of ``1 << BITMAP_BITS`` bits, however large the corpus. A marked bit lets a phrase through and a
collision lets one more through, so nothing is lost; a full bitmap only saves less. A triple is looked at where both
its pairs are marked. The third pass counts the words, and the phrases let through, by their text.

Estimation. The counts are one stream in prefix order, (lang, first two words) and then length, and one in suffix
order, (lang, last two words) and then length. In either a pair comes just before the triples that extend it on that
side, so one sorted run hands each triple the count of its head or tail, and each pair the largest count among its
extensions. Counts of single words meet the streams by merge joins. No hash table of phrases is built.

Scores are computed in decimals of 38 digits, a score is a whole number.

Edge cases: null texts hold no word; null languages count as ``und``, together with a language of that name; a piece
of one word has no phrase; equal scores go by count, then by the UTF-8 bytes of the phrase; a language without a
candidate, and the empty table, have no row; repeated rows count as often as they are there; further columns are left out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from evgraph.llm.textnum import Words, lowered, mix, signed, slices
from evgraph.session import written

LONGEST = 3
BITMAP_BITS = 26
SHARES = 16  # of a language's phrases, each ranked by itself first
HELD = 1 << 21  # hashes a task keeps before it adds them up and sends them on
PHRASES = 1 << 18  # phrases a task keeps
SLICE = 1 << 20  # bytes of texts worked on at once, which bounds the arrays over them

_SEPARATORS = np.zeros(256, bool)
_SEPARATORS[list(b".,;:!?\n\x0b\x0c\r")] = True
_AS_LINE = np.arange(256, dtype=np.uint8)
_AS_LINE[_SEPARATORS] = 10


class Pieces(Words):
    """The words of some rows, cut into pieces at separators: ``row`` numbers the pieces, ``text`` the rows."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        super().__init__(_AS_LINE[lowered(data)], offsets)
        self.text = self.row
        if len(self.row):
            before = np.concatenate([[0], np.cumsum(_SEPARATORS[data])])
            cut = (self.row[1:] != self.row[:-1]) | (before[self.start[1:]] != before[self.end[:-1]])
            self.row = np.concatenate([[0], np.cumsum(cut)])

    def phrase(self, first: int, size: int) -> bytes:
        return b" ".join(self.data[self.start[i] : self.end[i]].tobytes() for i in range(first, first + size))


def _languages(column: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray]:
    """(number of each row's language, names, a 64-bit hash of each name)."""
    encoded = pc.fill_null(column.cast(pa.string()), "und").dictionary_encode()
    names = encoded.dictionary.to_pylist()
    hashes = [int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in names]
    return encoded.indices.to_numpy(), names, np.array(hashes, np.uint64)


def _place(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)


def _marked(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = _place(hashes)
    return (bitmap[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) == 1


def _phrases(pieces: Pieces, size: int, salt: np.ndarray, pairs: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash with the language) of the windows of ``size`` words; longer than
    two, only those whose pairs are all marked."""
    first, value = pieces.windows(size)
    value = mix(value ^ salt[pieces.text[first]])
    if size > 2 and pairs is not None:
        begins, pair = _phrases(pieces, 2, salt, None)
        whole = np.zeros(len(pieces.row) + 1, bool)
        whole[begins] = _marked(pairs, pair)
        fits = np.ones(len(first), bool)
        for j in range(size - 1):
            fits &= whole[first + j]
        first, value = first[fits], value[fits]
    return first, value


def _rows(batches):
    """(pieces, number of each text's language, language names, language hashes) slice by slice."""
    for batch in batches:
        number, names, hashes = _languages(batch.column(0))
        for a, b, data, offsets in slices(batch.column(1), SLICE):
            yield Pieces(data, offsets), number[a:b], names, hashes


def bitmap(texts: DataFrame, size: int, least: int, pairs) -> np.ndarray:
    """A bit for every hash bucket that holds a phrase of ``size`` words found ``least`` times or more."""

    def summed(held):
        hashes, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(signed(hashes)), pa.array(n)], names=["h", "n"])

    def run(batches):
        held, count = [], 0
        for pieces, number, _, hashes in _rows(batches):
            _, value = _phrases(pieces, size, hashes[number], pairs.value if pairs else None)
            held.append(value)
            count += len(value)
            if count >= HELD:
                yield summed(held)
                held, count = [], 0
        if count:
            yield summed(held)

    counts = texts.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    place = F.shiftrightunsigned("h", 64 - BITMAP_BITS)
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {64 - BITMAP_BITS}) & 63 as int))")
    words = counts.groupBy(F.shiftright(place, 6).alias("i")).agg(F.bit_or(bit).alias("bits")).toArrow()  # at most 1 << BITMAP_BITS bits
    found = np.zeros(1 << (BITMAP_BITS - 6), np.uint64)
    found[words.column("i").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return found


def counts(docs: DataFrame, least: int) -> DataFrame:
    """lang, size, phrase, a: every word, and the phrases of up to ``LONGEST`` words found ``least`` times, as a written table."""
    texts = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    share = docs.sparkSession.sparkContext.broadcast
    marked = {2: share(bitmap(texts, 2, least, None))}
    for size in range(3, LONGEST + 1):
        marked[size] = share(bitmap(texts, size, least, marked[2]))

    def run(batches):
        table: dict[tuple[str, int, bytes], int] = {}
        for pieces, number, names, hashes in _rows(batches):
            salt = hashes[number]
            for size in range(1, LONGEST + 1):
                first, value = _phrases(pieces, size, salt, marked[2].value if size > 2 else None)
                if size > 1:
                    keep = _marked(marked[size].value, value)
                    first, value = first[keep], value[keep]
                _, at, n = np.unique(value, return_index=True, return_counts=True)
                for i, c in zip(first[at].tolist(), n.tolist()):
                    key = names[number[pieces.text[i]]], size, pieces.phrase(i, size)
                    table[key] = table.get(key, 0) + c
            if len(table) >= PHRASES:
                yield batch_of(table)
                table = {}
        if table:
            yield batch_of(table)

    def batch_of(table):
        lang, size, phrase = zip(*table)
        columns = [pa.array(lang, pa.string()), pa.array(size, pa.int32()), pa.array(phrase, pa.binary()).cast(pa.string()), pa.array(table.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "size", "phrase", "a"])

    summed = texts.mapInArrow(run, "lang string, size int, phrase string, a long").groupBy("lang", "size", "phrase").agg(F.sum("a").alias("a"))
    return written(summed.where(f"size = 1 or a >= {int(least)}"), "counts")


def streams(counted: DataFrame) -> DataFrame:
    """Phrases of two and three words with the counts beside them in prefix and in suffix order: ``head`` and
    ``tail`` of a triple (its first and last two words), ``longer`` of a pair (its most frequent extension)."""

    def pair(which: int) -> Column:
        return F.when(F.col("size") == 2, F.col("phrase")).otherwise(F.substring_index("phrase", " ", which)).alias("_pair")

    def aside(rows: DataFrame, which: int, own: str, extension: str) -> DataFrame:
        run = Window.partitionBy("lang", "_pair").orderBy("size")
        whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        largest = F.max(F.when(F.col("size") > 2, F.col("a"))).over(whole)
        return rows.select("*", pair(which)).withColumns({own: F.first("a").over(run), extension: largest}).drop("_pair")

    phrases = counted.where("size > 1")
    both = aside(aside(phrases, 2, "head", "right"), -2, "tail", "left")
    return both.withColumn("longer", F.greatest("left", "right")).drop("left", "right")


def mine(docs: DataFrame, least: int = 10, percent: int = 50, most: int | None = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``most`` best phrases of each language (all where None)."""
    return scored(counts(docs, least), least, percent, most)


def scored(counted: DataFrame, least: int, percent: int, most: int | None) -> DataFrame:
    """The phrases of ``counted`` (lang, size, phrase, a), cut where their score is lowest and ranked. A phrase goes
    if ``percent`` of its occurrences or more lie in one longer phrase."""
    words = written(counted.where("size = 1").select(F.col("lang").alias("_lang"), F.col("phrase").alias("_word"), F.col("a").alias("_f")), "words")
    totals = words.groupBy("_lang").agg(F.sum("_f").alias("n"))
    frequent = words.where(F.col("_f") >= least)
    found = streams(counted).where((F.col("size") == LONGEST) | F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("a")))
    for name, which in (("first", 1), ("last", -1)):
        word = F.substring_index("phrase", " ", which)
        found = found.withColumn("_w", word).join(frequent.hint("merge"), (F.col("lang") == F.col("_lang")) & (F.col("_w") == F.col("_word")))
        found = found.withColumnRenamed("_f", name).drop("_lang", "_word", "_w")

    def cut(k: int, left: str, right: str) -> Column:
        wide = {c: f"cast(`{c}` as decimal(38,0))" for c in ("a", left, right)}
        score = F.expr(f"(1000000 * {wide['a']} * {wide['a']}) div ({wide[left]} * {wide[right]})")
        return F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(left).alias("l"), F.col(right).alias("r"))

    pair, triple = cut(1, "first", "last"), F.least(cut(1, "first", "tail"), cut(2, "head", "last"))
    found = found.withColumn("_cut", F.when(F.col("size") == 2, pair).otherwise(triple))
    found = found.select("lang", "phrase", "a", "_cut.l", "_cut.r", "_cut.score")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    if most is not None:  # the best of each share first, so that a language's ranking reads a bounded number of rows
        share = F.pmod(F.xxhash64("phrase"), F.lit(SHARES)).alias("_share")
        inside = F.row_number().over(Window.partitionBy("lang", "_share").orderBy(*order))
        found = found.select("*", share).withColumn("_r", inside).where(F.col("_r") <= most).drop("_share", "_r")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    if most is not None:
        ranked = ranked.where(F.col("rank") <= most)
    return ranked.join(totals, F.col("lang") == F.col("_lang")).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
