"""Base counts and the language model against plain Python."""

import collections
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from evgraph.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def base(text):
    words = WORD.findall(text)
    lines, before = collections.Counter(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            before += lines[line] > 0
            lines[line] += 1
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = collections.Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    symbols = sum(c in quality.SYMBOLS for c in text)
    return len(words), sum(map(len, words)), symbols, before, len(covered)


def units(text):
    raw = text.translate(LOWER).encode("utf-16-le")
    every = [raw[i] + 256 * raw[i + 1] for i in range(0, len(raw), 2)]
    read = [u for i, u in enumerate(every) if u not in (9, 10, 11, 12, 13, 32) and (i == 0 or u != every[i - 1])]
    return [0] * (quality.ORDER - 1) + read


def kneser_ney(texts):
    """A function of an n-gram (tuple) that gives its last unit's probability."""
    order = quality.ORDER
    counts = {order: collections.Counter()}
    for u in map(units, texts):
        counts[order].update(tuple(u[i : i + order]) for i in range(len(u) - order + 1))
    for k in range(order - 1, 0, -1):
        counts[k] = collections.Counter(g[1:] for g in counts[k + 1])
    lost, totals, taken = {}, {}, {}
    for k, level in counts.items():
        n = collections.Counter(min(c, 5) for c in level.values())
        lost[k] = [0, 0.5, 0.5, 0.5]
        if n[1] and n[2]:
            y = n[1] / (n[1] + 2 * n[2])
            for j, most in ((1, 0.95), (2, 1.9), (3, 2.8)):
                if n[j]:
                    lost[k][j] = min(most, max(0.05, j - (j + 1) * y * n[j + 1] / n[j]))
        totals[k], taken[k] = collections.Counter(), collections.Counter()
        for g, c in level.items():
            totals[k][g[:-1]] += c
            taken[k][g[:-1]] += lost[k][min(c, 3)]

    def p(g):
        k = len(g)
        shorter = p(g[1:]) if k > 1 else 1 / (len(counts[1]) + 1)
        if not totals[k][g[:-1]]:
            return shorter
        c = counts[k][g]
        return (c - lost[k][min(c, 3)] + taken[k][g[:-1]] * shorter) / totals[k][g[:-1]]

    return p


def log_perplexity(p, text):
    u = units(text)
    logs = [math.log(p(tuple(u[i : i + quality.ORDER]))) for i in range(len(u) - quality.ORDER + 1)]
    return -sum(logs) / len(logs)


def test_labelled_bad_documents_are_rejected(spark):
    """By perplexity alone, on a table with enough documents a language for quartiles."""
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = quality.judge(spark.read.parquet(f"{folder}/documents.parquet")).join(labels, "doc_id").where("not base_failed").collect()
    good, bad = ([r.kept for r in rows if r.quality == q] for q in (1, 0))
    assert len(bad) > 200 and sum(bad) <= 0.1 * len(bad)
    assert sum(good) >= 0.95 * len(good)


@pytest.fixture(scope="module")
def given(docs):
    return docs.withColumn("lang", F.lit("xx")).withColumn("kept", F.lit(1)).withColumn("n_words", F.lit("x"))


@pytest.mark.parametrize("most_entries", [quality.MOST_ENTRIES, 0])
def test_counts_and_perplexity(given, texts, most_entries):
    rows = {r.doc_id: r for r in quality.judge(given, most_entries=most_entries).collect()}
    assert sorted(rows) == list(range(len(texts)))
    p = kneser_ney([t or "" for t in texts])
    for i, text in enumerate(t or "" for t in texts):
        r = rows[i]
        counts = base(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts, i
        assert r.base_failed == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert not (r.base_failed and r.kept)
        if text.strip() and len(text) < 3000:
            assert math.log(r.perplexity) == pytest.approx(log_perplexity(p, text), rel=1e-5), i
        elif not text.strip():
            assert r.perplexity is None


def test_unseen_grams_back_off_alike(spark, given, texts):
    entries = quality.fit(given)
    p = kneser_ney([t or "" for t in texts])
    some = ["qzqz never seen", "a\U0001F600b", "abc", "日本x"]
    seen = {tuple(units(s)[i : i + 4]) for s in some for i in range(len(units(s)) - 3)}
    assert len(seen) > 10
    signed = {g: sum(u << (16 * (3 - j)) for j, u in enumerate(g)) for g in seen}
    signed = {g: n - (1 << 64) if n >> 63 else n for g, n in signed.items()}
    slot = given.select(quality.slot_of(F.col("lang"))).first()[0]
    import numpy as np

    model = quality.in_arrays(entries)
    rows = spark.createDataFrame([(slot, n) for n in signed.values()], "slot int, gram long")
    joined = {r.gram: r.log for r in quality.joined_logs(rows, entries).collect()}
    for g, n in signed.items():
        assert math.exp(model.logs(slot, np.array([n]))[0]) == pytest.approx(p(g), rel=1e-5)
        assert math.exp(joined[n]) == pytest.approx(p(g), rel=1e-5)


def test_gibberish_is_rejected_and_prose_kept(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = quality.judge(docs).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    good = [r for r in rows if r.quality == 1 and not r.base_failed]
    assert good and sum(r.kept for r in good) >= 0.95 * len(good)


def test_copies_of_one_text_change_no_verdict(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang", "text")
    before = {r.doc_id: r.kept for r in quality.judge(docs).collect()}
    one = docs.where(F.col("doc_id").isin([i for i, kept in before.items() if kept])).orderBy("doc_id").limit(1)
    copies = one.drop("doc_id").crossJoin(spark.range(10**6, 10**6 + len(before) // 2).withColumnRenamed("id", "doc_id"))
    rows = quality.judge(docs.unionByName(copies)).collect()
    assert len(rows) == len(before) + len(before) // 2
    assert {r.doc_id: r.kept for r in rows if r.doc_id < 10**6} == before
    assert all(r.kept for r in rows if r.doc_id >= 10**6)


def test_model_of_distinct_texts(spark):
    """``once`` is the model of the texts without their copies, by the arrays and by joins."""
    texts = ["the cat sat on the mat", "a dog ran", "the dog sat"]
    docs = spark.createDataFrame([("xx", t) for t in texts + texts[1:2] * 5], "lang string, text string")
    entries, p = quality.fit(docs), kneser_ney(texts)
    seen = {tuple(units(s)[i : i + 4]) for s in texts for i in range(len(units(s)) - 3)}
    grams = {sum(u << (16 * (3 - j)) for j, u in enumerate(g)): p(g) for g in seen}
    slot = docs.select(quality.slot_of(F.col("lang"))).first()[0]
    rows = spark.createDataFrame([(slot, n) for n in grams], "slot int, gram long")
    model = quality.in_arrays(entries)
    for r in quality.joined_logs(rows, entries).collect():
        assert math.exp(r.log_once) == pytest.approx(grams[r.gram], rel=1e-5)
        assert math.exp(model.logs(slot, np.array([r.gram]), once=True)[0]) == pytest.approx(grams[r.gram], rel=1e-5)


def test_odd_tables(given, empty):
    assert quality.judge(empty).count() == 0
    nulls = given.where("doc_id < 3").select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in given.schema])
    rows = quality.judge(nulls).collect()
    assert [(r.n_words, r.base_failed, r.kept, r.perplexity) for r in rows] == [(0, True, False, None)] * 3
    assert quality.judge(given.union(given)).count() == 2 * given.count()
