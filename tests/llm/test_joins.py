"""Jaccard join, line dedup and repeat index against brute force."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from evgraph.llm import jaccard_join, line_dedup, repeat_index
from evgraph.llm.components import components

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def shingle_set(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def joined(n, linked):
    least = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(least[a], least[b])
            if least[a] != low or least[b] != low:
                least[a] = least[b] = low
                changed = True
    return least


def brute_components(texts, width, percent):
    sets = [shingle_set(t, width) for t in texts]
    linked = [
        (a, b)
        for b in range(len(sets))
        for a in range(b)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    return sets, joined(len(sets), linked)


@pytest.mark.parametrize("width,percent", [(3, 90), (1, 50)])
def test_components_are_exact(docs, texts, width, percent):
    sets, least = brute_components(texts, width, percent)
    rows = {r.doc_id: r for r in jaccard_join.classes(docs, width, percent).collect()}
    assert len(rows) == len(texts)
    for i in range(len(texts)):
        assert rows[i].n_shingles == len(sets[i])
        assert rows[i].component_id == least[i]


def test_crowded_regions_without_a_centre_stay_exact(spark):
    """A ring of sets in one region: each is linked with its neighbours alone, and no pivot is near all."""
    rng = np.random.default_rng(3)
    common = [f"c{i}" for i in range(90)]
    texts = []
    for group in range(4):
        for i in range(12):
            texts.append(" ".join(common + [f"g{group}w{(i + j) % 40}" for j in range(10)]))
    texts = [texts[i] for i in rng.permutation(len(texts))]
    sets, least = brute_components(texts, 1, 97)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r.component_id for r in jaccard_join.classes(docs, 1, 97).collect()}
    assert [rows[i] for i in range(len(texts))] == least
    assert len(set(least)) > 1


def test_far_sets_of_one_region_are_not_compared_whole(spark):
    """Texts that share their rarest word alone meet, but their sketches differ too much for a link."""
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(3000)]
    texts = ["rare " + " ".join(rng.choice(words, 200, replace=False)) for _ in range(10)]
    texts += [texts[0] + " more", "rare " * 300, texts[1].replace("rare", "rare2")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = jaccard_join.shingle_sets(docs, "doc_id", 1)
    sets = {r.uid: set(r.shingles) for r in found.collect()}
    pairs = found.select(F.col("uid").alias("a")).crossJoin(found.select(F.col("uid").alias("b"))).where("a < b")
    gaps = jaccard_join.gaps(pairs, found).collect()
    assert len(gaps) == len(texts) * (len(texts) - 1) // 2
    assert all(r.gap <= len(sets[r.a] ^ sets[r.b]) and r.total == len(sets[r.a]) + len(sets[r.b]) for r in gaps)
    open_ = jaccard_join.gaps(pairs, found).where(jaccard_join.within_radius(F.col("gap"), F.col("total"), 90))
    near = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])}
    assert {(r.a, r.b) for r in open_.collect()} == near and len(near) == 2
    assert {(r.a, r.b) for r in jaccard_join.near_pairs(jaccard_join.gaps(pairs, found), found, 90).collect()} == near


def test_one_of_each_keeps_columns_and_unlinked_rows(docs, texts):
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    _, least = brute_components(texts, 5, 80)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(least))


def test_null_and_repeated_ids(spark):
    rows = [(None, "a b c d"), (4, "a b c d"), (4, "a b c d"), (None, None), (7, "z y x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(((r.doc_id, r.component_id) for r in jaccard_join.classes(docs).collect()), key=str)
    assert found == sorted([(None, 4), (4, 4), (4, 4), (None, None), (7, 7)], key=str)


def test_one_of_each_leaves_one_row_of_a_component(spark):
    long = [" ".join(f"{c}{i}" for i in range(30)) for c in "abcd"]
    rows = [
        (4, long[0]), (4, long[0]), (9, long[0]),  # repeated rows and a copy
        (1, long[1]), (5, long[1] + " x"), (5, long[2]),  # the first of id 5 is a near copy, the second is not
        (None, long[0]), (None, long[3]), (None, long[3]), (None, long[3] + " x"),
        (6, ""), (6, ""), (7, ""), (8, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = jaccard_join.one_of_each(docs).collect()
    nulls = [r.text for r in found if r.doc_id is None]
    assert len(nulls) == 1 and nulls[0].startswith(long[3])
    assert sorted((r.doc_id, r.text or "") for r in found if r.doc_id is not None) == [
        (1, long[1]), (4, long[0]), (5, long[2]), (6, ""), (7, ""), (8, "")
    ]


def test_components_of_a_chain_and_a_star(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(5, 5)]
    rows = dict(components(spark.createDataFrame(pairs, "a long, b long")).collect())
    assert {rows[i] for i in range(41)} == {0} and {rows[i] for i in range(100, 130)} == {100}


def brute_removed(texts, long=50):
    bodies, least, out = [(t or "").encode() for t in texts], {}, []
    for i, body in enumerate(bodies):
        for j in range(len(body) - long + 1):
            least.setdefault(body[j : j + long], i)
    for i, body in enumerate(bodies):
        gone = bytearray(len(body))
        for j in range(len(body) - long + 1):
            if least[body[j : j + long]] < i:
                gone[j : j + long] = b"\1" * long
        spans = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(x for x, y in zip(body, gone) if not y)
        out.append((i, len(body), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("crowd", [256, 2])
def test_repeats_equal_brute_force(docs, texts, crowd, monkeypatch):
    monkeypatch.setattr(repeat_index, "CROWD", crowd)
    assert sorted(map(tuple, repeat_index.report(docs).collect())) == brute_removed(texts)


@pytest.mark.parametrize("rounds", [1, 3])
def test_repeats_by_any_number_of_rounds(docs, texts, rounds, monkeypatch):
    monkeypatch.setattr(repeat_index, "ROUNDS", rounds)
    assert sorted(map(tuple, repeat_index.report(docs).collect())) == brute_removed(texts)


def test_repeats_leave_only_their_plan_and_move_no_bytes_of_lone_segments(spark, docs, monkeypatch):
    """Segments overlap, so their bytes are several times the input's: only those are fetched whose anchor has others."""
    from pathlib import Path

    from evgraph import session

    made, kinds, path, write = [], {}, session.scratch_path, repeat_index.written
    monkeypatch.setattr(session, "scratch_path", lambda *a: made.append(path(*a)) or made[-1])
    monkeypatch.setattr(repeat_index, "written", lambda df, name: kinds.setdefault(name, df.dtypes) and write(df, name))
    assert repeat_index.report(docs).count() == docs.count()
    left = [p for p in made if Path(p.removeprefix("file:")).exists()]
    assert len(made) > 1 and left == made[-1:]
    wide = {name for name, columns in kinds.items() if {"string", "binary"} & {kind for _, kind in columns}}
    assert wide == {"texts", "bodies"}


def test_segments_of_a_string_that_repeats_itself_stay_short():
    data = np.frombuffer(b"a" * 400 + b"the end of it, after which comes no other a" * 3, np.uint8)
    row, anchor, code, start, size = repeat_index.segments(data, np.array([0, len(data)]))
    assert size.max() <= 2 * repeat_index.LONG - repeat_index.GRAM
    windows = [i for a, n in zip(start.tolist(), size.tolist()) for i in range(a, a + n - repeat_index.LONG + 1)]
    assert windows == list(range(len(data) - repeat_index.LONG + 1))


def test_repeats_of_null_and_equal_ids(spark):
    text = "x" + "".join(chr(97 + i * 7 % 26) for i in range(80))
    docs = spark.createDataFrame([(None, text), (3, text), (3, text), (2, "short")], "doc_id long, text string")
    found = sorted(((r.doc_id, r.n_removed) for r in repeat_index.report(docs).collect()), key=str)
    assert found == sorted([(None, 81), (3, 0), (3, 0), (2, 0)], key=str)


def test_run_index_walks_every_suffix():
    strings = [b"abracadabra", b"abra", b"cadabra", b"aaaaaaaa", b"aaaa"]
    doc = np.arange(len(strings))
    string, start = repeat_index.RunIndex(strings, doc, long=4).matches()
    found = set(zip(string.tolist(), start.tolist()))
    wanted = {
        (i, p)
        for i, s in enumerate(strings)
        for p in range(len(s) - 3)
        if any(s[p : p + 4] in strings[j] for j in range(i))
    }
    assert found == wanted


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        old, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def within(a, b, most=2):
    """By the first difference: at each, one character is dropped on either side or on both."""
    if abs(len(a) - len(b)) > most:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    a, b = a[i:], b[i:]
    if not a or not b:
        return max(len(a), len(b)) <= most
    return most > 0 and (within(a[1:], b[1:], most - 1) or within(a[1:], b, most - 1) or within(a, b[1:], most - 1))


def test_band_equals_edit_distance(spark):
    import random

    rng = random.Random(1)
    pairs = []
    for _ in range(300):
        a = "".join(rng.choice("ab") for _ in range(rng.randint(0, 9)))
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            at = rng.randint(0, len(b))
            b[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "b"])
        pairs.append((a, "".join(b)))
    rows = spark.createDataFrame(pairs, "a string, b string").select("a", "b", line_dedup.within(F.col("a"), F.col("b"), 2).alias("near"))
    for a, b, near in rows.collect():
        assert within(a, b) == near
        assert near == (edits(a, b) <= 2), (a, b)


@pytest.mark.parametrize("crowd", [2, 32])
def test_lines_equal_brute_force(docs, texts, crowd, monkeypatch):
    monkeypatch.setattr(line_dedup, "CROWD", crowd)
    seen, wanted = [], {}
    for i, text in enumerate(texts):
        kept, gone = [], 0
        for line in text.split("\n") if text is not None else []:
            if len(line) >= line_dedup.LEAST and line.strip(" "):
                near = any(within(line, s) for s in seen)
                if line not in seen:
                    seen.append(line)
                if near:
                    gone += 1
                    continue
            kept.append(line)
        wanted[i] = (gone, hashlib.sha256("\n".join(kept).encode()).hexdigest())
    found = {r.doc_id: (r.n_removed, r.kept_sha256) for r in line_dedup.report(docs).collect()}
    assert found == wanted


def test_short_lines_go_when_repeated_exactly(spark):
    texts = ["Les.\na b\n \n日本語の文。", "Les.\na c\n \n日本語の文。\nLes", "\n\na c", "x" * 20, "x" * 19 + "y", "x" * 19]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r.doc_id: r.text for r in line_dedup.dedup(docs).collect()}
    # "a c" is one edit from "a b" and stays: the edits are counted from 20 characters on
    assert kept == {0: texts[0], 1: "a c\n \nLes", 3: texts[3], 5: texts[5]}


def test_clashing_column_names_and_many_removed_lines(spark):
    text = "\n".join(["one line of some length"] * 40 + ["another one"] + ["\U0001F600" * 30, "\U0001F600" * 29 + "x", ""])
    rows = [(1, text, 5, "a", "b", "c"), (2, "another one", 6, "d", "e", "f"), (3, None, 7, "g", "h", "i")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, line_id long, _doc string, gone string, `odd.name` string")
    found = line_dedup.dedup(docs)
    assert found.columns == docs.columns
    smile = "\U0001F600" * 30
    assert sorted(map(tuple, found.collect())) == [(1, f"one line of some length\nanother one\n{smile}\n", 5, "a", "b", "c"), rows[2]]


@pytest.mark.parametrize("operator", [jaccard_join.classes, line_dedup.report, repeat_index.report, line_dedup.dedup, jaccard_join.one_of_each])
def test_empty_table(empty, operator):
    assert operator(empty).collect() == []


def test_line_dedup_leaves_only_its_result_in_the_shared_folder(spark, docs, monkeypatch):
    """What it writes on the way is as large as the input, and would stay until the application ends."""
    from pathlib import Path

    from evgraph import session

    made, path = [], session.scratch_path
    monkeypatch.setattr(session, "scratch_path", lambda *a: made.append(path(*a)) or made[-1])
    rows = line_dedup.report(docs)
    left = [p for p in made if Path(p.removeprefix("file:")).exists()]
    assert len(made) > 1 and left == made[-1:]
    assert rows.count() == docs.count()
