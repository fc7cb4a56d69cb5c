"""Collocation mining against plain Python."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from evgraph.llm import collocations, queries

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def brute(rows, least=10, percent=50, most=2000):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i : i + k])] += 1
    result = []
    for lang in totals:
        phrases = {p: a for (x, p), a in counts.items() if x == lang and len(p) > 1 and a >= least}
        kept = []
        for p, a in phrases.items():
            longer = [b for q, b in phrases.items() if len(q) == 3 and len(p) == 2 and p in (q[:2], q[1:])]
            if any(100 * b >= percent * a for b in longer):
                continue
            cuts = []
            for k in range(1, len(p)):
                l, r = counts[lang, p[:k]], counts[lang, p[k:]]
                cuts.append((1_000_000 * a * a // (l * r), k, l, r))
            score, _, l, r = min(cuts)
            kept.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(kept)[:most], 1):
            result.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(result)


def made(seed=11):
    rng = random.Random(seed)
    words = ["the", "of", "New", "York", "city", "é", "日本", "a'b", "x-y", "Ñandú", "\x01", " wide", "zz"]
    weights = [9, 7, 5, 5, 3, 2, 2, 2, 1, 1, 1, 1, 1]
    joins = [" "] * 12 + ["  ", "\t", ". ", ",", "\n", ";", "!?", "\x0b", "\r\n", " : "]
    rows = []
    for i in range(150):
        parts = []
        for w in rng.choices(words, weights, k=rng.randint(0, 60)):
            parts += [w, rng.choice(joins)]
            if w == "New":
                parts += ["york", " ", "city", rng.choice(joins)]
        rows.append((rng.choice(["en", "fr", None, "und"]), "".join(parts)))
    rows += [("en", None), (None, None), ("xx", ""), ("de", "one"), ("de", "Kelvin K K")] + [("en", "again and again and again")] * 12
    return rows


SCHEMA = "lang string, text string, doc_id long, phrase string, n long, a string, size int, _lang string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, i % 7, "p", 3, "a", 4, None) for i, r in enumerate(rows)], SCHEMA).repartition(4)


@pytest.mark.parametrize("least,percent,most,held", [(10, 50, 2000, 1 << 21), (2, 80, 5, 64), (1, 101, 2000, 1 << 21)])
def test_equals_plain_python(spark, monkeypatch, least, percent, most, held):
    monkeypatch.setattr(collocations, "HELD", held)
    monkeypatch.setattr(collocations, "PHRASES", held)
    monkeypatch.setattr(collocations, "SLICE", held)
    rows = made()
    got = sorted(tuple(r) for r in collocations.mine(frame(spark, rows), least, percent, most).collect())
    assert got == brute(rows, least, percent, most)
    assert len(got) > 5


def test_equals_its_sql(spark, tmp_path):
    rows = made(12)
    frame(spark, rows).select("lang", "text").write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op11_collocations"](spark, str(tmp_path))
    duckdb.sql(f"create or replace temp view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = duckdb.sql(queries.ORACLES["op11_collocations"])
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())


def test_tables_without_a_phrase(spark):
    for rows in ([], [(None, None)], [("en", "once only, and never again")]):
        assert collocations.mine(frame(spark, rows)).collect() == []


def test_scores_past_64_bits_are_whole(spark):
    big = 7 * 10**9
    rows = [("en", 1, "x", big), ("en", 1, "y", big + 3), ("en", 2, "x y", big - 11)]
    counted = spark.createDataFrame(rows, "lang string, size int, phrase string, a long")
    found = collocations.scored(counted, 10, 50, None).collect()
    assert [r.score for r in found] == [1_000_000 * (big - 11) ** 2 // (big * (big + 3))]


def test_a_full_bitmap_loses_nothing(spark, monkeypatch):
    """Where every bit is set, phrases are only counted in vain."""
    rows = made()
    monkeypatch.setattr(collocations, "bitmap", lambda *_: np.full(1 << 20, 2**64 - 1, np.uint64))
    got = sorted(tuple(r) for r in collocations.mine(frame(spark, rows)).collect())
    assert got == brute(rows)
