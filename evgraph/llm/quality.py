"""Quality rules: counts of a text, and the perplexity of an n-gram model of its language.

The model reads UTF-16 code units, A-Z lower-cased, four at a time, without white space and with runs of one unit read
once: a run of symbols is likely after its first, and a symbol between spaces is likely where others are, so that both
would pull the mean of a text back to that of prose. Four units are one exact 64-bit
number, and the set of n-grams grows with the corpus. Languages share 16 models by a hash of their
name. Spark counts the n-grams of all texts and applies modified Kneser-Ney smoothing by
aggregates and joins; the entries are kept in arrays sorted by hash. Up to ``MOST_ENTRIES`` of
them, checked by a count, are broadcast; a larger model stays a table and is joined with the
n-grams of each text, with equal results. ``perplexity`` counts every row's n-grams; the verdict
reads a second value, of a model that counts each distinct text once. Both models share all orders but
the longest, whose counts alone depend on copies. A language's band lies around the quartiles of the
second value over its distinct texts, and documents outside it are rejected, copies with the rest.

Edge cases: a null or empty text, or one of white space, has no words, so it fails the base rules, and its
perplexity is null; null languages are one language; repeated rows count as often as they occur in
``perplexity`` and once in the verdict; a language with one document keeps it; the empty table gives the empty table; further
columns are left out.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from evgraph.llm.textnum import Words, lowered, mix, slices
from evgraph.session import written

UNIT_BITS, ORDER, SLOTS = 16, 4, 16
MOST_ENTRIES = 4_000_000  # of 12 bytes each
SYMBOLS = "#*$%&|<>"
SPACES = np.array([9, 10, 11, 12, 13, 32], np.uint16)
UNIFORM = -float(np.log(1 << UNIT_BITS))


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each code unit that is read, and the rows' offsets in these units; 0 stands before a text.
    White space is not read, nor a unit equal to the one just before it."""
    units = np.frombuffer(lowered(data).tobytes().decode("utf-8", "replace").encode("utf-16-le"), np.uint16)
    begins = np.concatenate([[0], np.cumsum(((data & 0xC0) != 0x80).astype(np.int64) + (data >= 0xF0))])
    bounds = begins[offsets]
    read = ~np.isin(units, SPACES)
    same = np.concatenate([np.zeros(min(1, len(units)), bool), units[1:] == units[:-1]])
    same[bounds[:-1][bounds[:-1] < len(units)]] = False  # the first of a row
    read &= ~same
    bounds = np.concatenate([np.zeros(1, np.int64), np.cumsum(read)])[bounds]
    unit = units[read].astype(np.uint64)
    place = np.arange(len(unit)) - np.repeat(bounds[:-1], np.diff(bounds))
    gram = unit.copy()
    for back in range(1, ORDER):
        before = np.zeros_like(unit)
        before[back:] = unit[:-back]
        before[place < back] = 0
        gram |= before << np.uint64(UNIT_BITS * back)
    return gram.view(np.int64), bounds


def slot_of(lang: Column) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(lang, F.lit(""))), F.lit(SLOTS)).cast("int")


def text_key() -> list[Column]:
    """128 bits that stand for a text and its slot: equal ones have equal perplexities."""
    slot = slot_of(F.col("lang"))
    return [F.xxhash64(F.lit(i), slot, F.col("text").cast("string")).alias(f"_key{i}") for i in (0, 1)]


def gram_counts(docs: DataFrame) -> DataFrame:
    """(slot, gram, n, once) of all texts: ``n`` counts every row, ``once`` each distinct text. Copies
    meet in each task before the shuffle, and n-grams are counted in each slice before theirs."""

    def run(batches):
        for batch in batches:
            slot, copies = (batch.column(i).to_numpy() for i in (0, 1))
            for a, b, data, offsets in slices(batch.column(2)):
                gram, bounds = grams(data, offsets)
                owner, times = (np.repeat(x[a:b], np.diff(bounds)) for x in (slot, copies))
                for s in np.unique(owner).tolist():
                    place, own = pd.factorize(gram[owner == s])
                    n = np.zeros(len(own), np.int64)
                    np.add.at(n, place, times[owner == s])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(own), s, np.int32)), pa.array(own), pa.array(n), pa.array(np.bincount(place).astype(np.int64))],
                        names=["slot", "gram", "n", "once"],
                    )

    slot, text = slot_of(F.col("lang")).alias("slot"), F.col("text").cast("string").alias("text")
    texts = docs.where(F.length("text") > 0).select(*text_key(), slot, text).groupBy("_key0", "_key1")
    texts = texts.agg(F.first("slot").alias("slot"), F.count(F.lit(1)).alias("copies"), F.first("text").alias("text"))
    return (
        texts.select("slot", "copies", "text")
        .mapInArrow(run, "slot int, gram long, n long, once long")
        .groupBy("slot", "gram")
        .agg(F.sum("n").alias("n"), F.sum("once").alias("once"))
    )


def last_units(gram: Column, order: int) -> Column:
    return gram.bitwiseAND(F.lit((1 << (UNIT_BITS * order)) - 1)) if order < ORDER else gram


def context_of(gram: Column) -> Column:
    return F.shiftrightunsigned(gram, UNIT_BITS)


COUNTED = ("n", "once")
VALUES = (("n", "value"), ("once", "once"))  # the model's column by each count


def discounts(level: DataFrame) -> DataFrame:
    """(slot, units, n1, n2, n3, once1, once2, once3): what counts 1, 2 and 3 or more lose, from the numbers of
    n-grams seen 1 to 4 times. One row a slot."""
    seen = [F.count_if(F.col(c) == k).cast("double").alias(f"{c}_{k}") for c in COUNTED for k in (1, 2, 3, 4)]
    tally = level.groupBy("slot").agg(F.count(F.lit(1)).alias("units"), *seen)

    def lost(c: str, k: int, most: float) -> Column:
        n = {i: F.col(f"{c}_{i}") for i in (1, 2, 3, 4)}
        exact = k - (k + 1) * (n[1] / (n[1] + 2 * n[2])) * n[k + 1] / n[k]
        usable = (n[1] > 0) & (n[2] > 0) & (n[k] > 0)
        return F.when(usable, F.greatest(F.lit(0.05), F.least(F.lit(most), exact))).otherwise(0.5).alias(f"{c}{k}")

    return tally.select("slot", "units", *[lost(c, k, most) for c in COUNTED for k, most in ((1, 0.95), (2, 1.9), (3, 2.8))])


def smoothed(level: DataFrame, shorter: DataFrame | None, order: int) -> DataFrame:
    """(slot, gram, context, and p and rest by each count): interpolated modified Kneser-Ney of one order;
    ``rest`` is the weight that the context leaves to the next shorter order."""

    def lost(c: str) -> Column:
        n = F.col(c)
        return F.when(n == 1, F.col(f"{c}1")).when(n == 2, F.col(f"{c}2")).otherwise(F.col(f"{c}3")).alias(f"d_{c}")

    rows = level.join(F.broadcast(discounts(level)), "slot")  # at most SLOTS rows
    rows = rows.select("slot", "gram", *COUNTED, "units", *map(lost, COUNTED), context_of(F.col("gram")).alias("context"))
    sums = [F.sum(x).alias(name) for c in COUNTED for x, name in ((c, f"total_{c}"), (f"d_{c}", f"taken_{c}"))]
    rows = rows.join(rows.groupBy("slot", "context").agg(*sums), ["slot", "context"])
    if shorter is None:  # the rest is that of a unit never seen
        rows = rows.withColumn("of", F.lit(1.0) / (F.col("units") + 1))
    else:
        lower = shorter.select("slot", F.col("gram").alias("suffix"), *[F.col(f"p_{c}").alias(f"q_{c}") for c in COUNTED])
        rows = rows.withColumn("suffix", last_units(F.col("gram"), order - 1)).join(lower, ["slot", "suffix"])
    found = []
    for c in COUNTED:
        share, rest = (F.col(c) - F.col(f"d_{c}")) / F.col(f"total_{c}"), F.col(f"taken_{c}") / F.col(f"total_{c}")
        if shorter is None:
            rest = rest * F.col("of")
        found += [(share + (rest if shorter is None else rest * F.col(f"q_{c}"))).alias(f"p_{c}"), rest.alias(f"rest_{c}")]
    return rows.select("slot", "gram", "context", *found)


def fit(docs: DataFrame) -> DataFrame:
    """(slot, kind, gram, value, once) of all texts: kind k holds the log probabilities of the n-grams of order k,
    kind ``ORDER`` + k the log weights of their contexts; ``once`` is the value where each text counts once."""
    levels = {ORDER: written(gram_counts(docs), "grams")}
    for order in range(ORDER - 1, 0, -1):  # in how many contexts a shorter n-gram occurs
        suffix = last_units(F.col("gram"), order).alias("gram")
        longer = levels[order + 1].select("slot", suffix)
        n = F.count(F.lit(1))
        levels[order] = written(longer.groupBy("slot", "gram").agg(n.alias("n"), n.alias("once")), "grams")
    entries, shorter = None, None
    for order in range(1, ORDER + 1):
        shorter = written(smoothed(levels[order], shorter, order), "smoothed")
        own = shorter.select("slot", F.lit(order).alias("kind"), "gram", *[F.log(f"p_{c}").cast("float").alias(v) for c, v in VALUES])
        contexts = shorter.groupBy("slot", "context").agg(*[F.max(f"rest_{c}").alias(f"rest_{c}") for c in COUNTED])
        contexts = contexts.select("slot", F.lit(ORDER + order), "context", *[F.log(f"rest_{c}").cast("float") for c in COUNTED])
        both = own.union(contexts)
        entries = both if entries is None else entries.union(both)
    return written(entries, "model")


class Model:
    """The entries in one array sorted by hash."""

    def __init__(self, slot: np.ndarray, kind: np.ndarray, gram: np.ndarray, value: np.ndarray, once: np.ndarray):
        key = self.hashed(slot, kind, gram)
        order = np.argsort(key)
        self.keys, self.values, self.once = key[order], value[order], once[order]

    @staticmethod
    def hashed(slot, kind, gram: np.ndarray) -> np.ndarray:
        salt = mix(np.atleast_1d(np.asarray(slot, np.uint64) * np.uint64(16) + np.asarray(kind, np.uint64)))
        return mix(gram.view(np.uint64) ^ salt)

    def find(self, slot: int, kind: int, gram: np.ndarray, once: bool = False) -> np.ndarray:
        wanted = self.hashed(slot, kind, gram)
        at = np.searchsorted(self.keys, wanted)
        hit = at < len(self.keys)
        hit[hit] = self.keys[at[hit]] == wanted[hit]
        out = np.full(len(wanted), np.nan)
        out[hit] = (self.once if once else self.values)[at[hit]]
        return out

    def logs(self, slot: int, gram: np.ndarray, once: bool = False) -> np.ndarray:
        """Log probability of each n-gram's last unit; n-grams never seen back off."""
        out, weight = np.full(len(gram), np.nan), np.zeros(len(gram))
        for order in range(ORDER, 0, -1):
            at = np.flatnonzero(np.isnan(out))
            own = gram[at] & np.int64((1 << (UNIT_BITS * order)) - 1) if order < ORDER else gram[at]
            out[at] = weight[at] + self.find(slot, order, own, once)
            context = (own.view(np.uint64) >> np.uint64(UNIT_BITS)).view(np.int64)
            weight[at] += np.nan_to_num(self.find(slot, ORDER + order, context, once), nan=UNIFORM if order == 1 else 0.0)
        return np.where(np.isnan(out), weight, out)


def in_arrays(entries: DataFrame) -> Model:
    rows = entries.toArrow()
    return Model(*(rows.column(c).to_numpy() for c in ("slot", "kind", "gram", "value", "once")))


def joined_logs(rows: DataFrame, entries: DataFrame) -> DataFrame:
    """``rows`` (slot, gram and more) with ``log`` and ``log_once``, as ``Model.logs`` gives them, by joins."""
    kinds = (("log", "weight", "value"), ("log_once", "weight_once", "once"))
    for log, weight, _ in kinds:
        rows = rows.withColumn(log, F.lit(None).cast("double")).withColumn(weight, F.lit(0.0))

    def found(kind: int) -> DataFrame:
        return entries.where(F.col("kind") == kind).select(
            F.col("slot").alias("_s"), F.col("gram").alias("_g"), *[F.col(value).alias(f"_{value}") for *_, value in kinds]
        )

    drop = ("_s", "_g", *(f"_{value}" for *_, value in kinds))
    for order in range(ORDER, 0, -1):
        own = last_units(F.col("gram"), order)
        rows = rows.join(found(order), (F.col("slot") == F.col("_s")) & (own == F.col("_g")), "left")
        for log, weight, value in kinds:
            rows = rows.withColumn(log, F.coalesce(log, F.col(weight) + F.col(f"_{value}")))
        rows = rows.drop(*drop)
        rows = rows.join(found(ORDER + order), (F.col("slot") == F.col("_s")) & (context_of(own) == F.col("_g")), "left")
        for _, weight, value in kinds:
            left = F.coalesce(f"_{value}", F.lit(UNIFORM if order == 1 else 0.0))
            rows = rows.withColumn(weight, F.col(weight) + left)
        rows = rows.drop(*drop)
    for log, weight, _ in kinds:
        rows = rows.withColumn(log, F.coalesce(log, weight)).drop(weight)
    return rows


_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS.encode())] = True


def sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, flags.dtype if flags.dtype.kind == "f" else np.int64), np.cumsum(flags)])
    return total[offsets[1:]] - total[offsets[:-1]]


def duplicates(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of (row, hash): whether the hash occurs again in its row, and whether it occurred before."""
    key = mix(value ^ mix(row.astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    again, before = np.zeros(len(key), bool), np.zeros(len(key), bool)
    before[order[1:][same]] = True
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    return again, before


def base_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each row."""
    words = Words(data, offsets)
    space = np.isin(data, np.array([9, 10, 11, 12, 13, 32], np.uint8))
    word_chars = sums(((data & 0xC0) != 0x80) & ~space, offsets)
    # lines end at newlines and at the end of their row
    newline = np.flatnonzero(data == 10)
    end = np.concatenate([newline, offsets[1:]])
    row = np.concatenate([np.searchsorted(offsets, newline, side="right") - 1, np.arange(words.rows)])
    order = np.lexsort((end, row))
    end, row = end[order], row[order]
    start = np.concatenate([[0], end[:-1] + 1])[: len(end)]
    fresh = np.concatenate([[True], row[1:] != row[:-1]])[: len(end)]
    start = np.where(fresh, offsets[row], start)
    with_word = np.searchsorted(words.start, end) > np.searchsorted(words.start, start)
    start, end, row = start[with_word], end[with_word], row[with_word]
    _, before = duplicates(row, words.hash_ranges(start, end))
    dup_lines = np.bincount(row[before], minlength=words.rows)
    first, value = words.windows(3)
    again, _ = duplicates(words.row[first], value)
    cover = np.zeros(len(words.start) + 3, np.int64)
    np.add.at(cover, first[again], 1)
    np.add.at(cover, first[again] + 3, -1)
    repeated = np.cumsum(cover)[: len(words.start)] > 0
    return {
        "n_words": words.count,
        "word_chars": word_chars,
        "n_symbols": sums(_SYMBOL[data], offsets),
        "n_dup_lines": dup_lines,
        "n_repeat_words": np.bincount(words.row[repeated], minlength=words.rows),
    }


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
LOGS = ("log_perplexity", "log_once")  # under the model of all rows, and of each distinct text once


def measured(docs: DataFrame, keep: tuple[str, ...], model: Model | None) -> DataFrame:
    """``keep`` columns, the base counts, and ``log_perplexity`` and ``log_once`` (null for an empty text or without a model)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # MOST_ENTRIES at most

    def run(batches):
        model = shared.value
        for batch in batches:
            slot = batch.column(batch.num_columns - 2).to_numpy()
            parts: dict[str, list[np.ndarray]] = {c: [] for c in (*COUNTS, *LOGS)}
            for a, b, data, offsets in slices(batch.column(batch.num_columns - 1)):
                for c, found in base_counts(data, offsets).items():
                    parts[c].append(found)
                if model is None:
                    for c in LOGS:
                        parts[c].append(np.full(b - a, np.nan))
                    continue
                gram, bounds = grams(data, offsets)
                owner = np.repeat(slot[a:b], np.diff(bounds))
                log = np.zeros((len(LOGS), len(gram)))
                for s in np.unique(owner).tolist():
                    place, own = pd.factorize(gram[owner == s])
                    for i in range(len(LOGS)):
                        log[i, owner == s] = model.logs(s, own, once=i > 0)[place]
                size = np.diff(bounds)
                for i, c in enumerate(LOGS):
                    parts[c].append(np.where(size > 0, -sums(log[i], bounds) / np.maximum(size, 1), np.nan))
            arrays = [pa.array(np.concatenate([np.zeros(0, np.int64), *parts[c]]).astype(np.int64)) for c in COUNTS]
            for c in LOGS:
                log = np.concatenate([np.zeros(0), *parts[c]])
                arrays.append(pa.array(log, pa.float64(), mask=np.isnan(log)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *arrays], names=[*keep, *COUNTS, *LOGS])

    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
    columns = [F.col(f"`{c}`") for c in keep]
    return docs.select(
        *columns, slot_of(F.col("lang")).alias("_slot"), F.col("text").cast("string").alias("_text")
    ).mapInArrow(run, ", ".join([*kinds, *(f"{c} long" for c in COUNTS), *(f"{c} double" for c in LOGS)]))


def joined_perplexities(docs: DataFrame, entries: DataFrame) -> DataFrame:
    """(_key0, _key1, log_perplexity, log_once) of every text that is not empty, by joins with the whole model."""

    def run(batches):
        for batch in batches:
            slot = batch.column(2).to_numpy()
            for a, b, data, offsets in slices(batch.column(3)):
                gram, bounds = grams(data, offsets)
                for i in range(a, b):
                    place, own = pd.factorize(gram[bounds[i - a] : bounds[i - a + 1]])
                    same = [pa.repeat(batch.column(j)[i], len(own)) for j in (0, 1)]
                    arrays = [*same, pa.array(np.full(len(own), slot[i], np.int32)), pa.array(own), pa.array(np.bincount(place).astype(np.int64))]
                    yield pa.RecordBatch.from_arrays(arrays, names=["_key0", "_key1", "slot", "gram", "n"])

    texts = docs.select("_key0", "_key1", slot_of(F.col("lang")).alias("slot"), F.col("text").cast("string"))
    rows = texts.mapInArrow(run, "_key0 long, _key1 long, slot int, gram long, n long")
    means = [(-F.sum(F.col("n") * F.col(log)) / F.sum("n")).alias(c) for log, c in zip(("log", "log_once"), LOGS)]
    return joined_logs(rows, entries).groupBy("_key0", "_key1").agg(*means)


def scores(docs: DataFrame, keep: tuple[str, ...], most_entries: int = MOST_ENTRIES) -> DataFrame:
    """``keep`` columns, the text's key, base counts, ``log_perplexity`` and ``log_once``."""
    entries = fit(docs)
    names = ("_key0", "_key1")
    docs = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys((*keep, "lang", "text"))], *text_key())
    if entries.count() <= most_entries:
        return measured(docs, (*keep, *names), in_arrays(entries))
    rows = measured(docs, (*keep, *names), None).drop(*LOGS)
    return rows.join(joined_perplexities(docs, entries), list(names), "left")


def bands(scored: DataFrame, width: float, least: float) -> DataFrame:
    """(_lang, low, high): ``width`` quartile distances, ``least`` at least, around the quartiles of the log perplexities
    of a language's distinct texts that pass the base rules."""
    texts = scored.where("not base_failed").groupBy("lang", "_key0", "_key1")
    texts = texts.agg(F.max("log_once").alias("log_once"))
    found = texts.groupBy(F.col("lang").alias("_lang")).agg(F.percentile_approx("log_once", [0.25, 0.75], 10_000).alias("q"))
    slack = F.greatest((F.col("q")[1] - F.col("q")[0]) * width, F.lit(least))
    return written(found.select("_lang", (F.col("q")[0] - slack).alias("low"), (F.col("q")[1] + slack).alias("high")), "bands")


def judge(docs: DataFrame, width: float = 2.0, least: float = 0.05, most_entries: int = MOST_ENTRIES) -> DataFrame:
    """doc_id, the base counts, base_failed, kept, perplexity."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    scored = scores(docs, ("doc_id", "lang"), most_entries).withColumn("base_failed", failed)
    scored = written(scored, "scored")
    lines = bands(scored, width, least)
    inside = F.col("log_once").between(F.col("low"), F.col("high"))
    return scored.join(lines, F.col("lang").eqNullSafe(F.col("_lang")), "left").select(
        "doc_id", *COUNTS, "base_failed", F.coalesce(~F.col("base_failed") & inside, F.lit(False)).alias("kept"),
        F.exp("log_perplexity").alias("perplexity"),
    )
