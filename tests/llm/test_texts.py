"""Fingerprints, packing, mixing, token counts, languages and URL verdicts against brute force."""

import collections
import hashlib
import random
import re
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from evgraph.llm import fingerprints, langid, mixing, packing, token_counts, url_filter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def odd(spark, docs):
    """Rows with nulls in every column, a repeated row, and columns named like those that operators add."""
    rows = [(None, None, None, None, None, None, None, None), (3, "again and again", "xx", "s1", 15, "u", None, 5)]
    rows += [(900, "again and again", "xx", "s1", 15, "u", None, 5)] * 2
    extra = spark.createDataFrame(rows, docs.schema)
    names = ("score", "lang_pred", "size", "hash", "taken", "target", "threshold", "weight", "piece", "sketch", "rank", "n_words")
    return docs.unionByName(extra).select("*", *[F.lit(i).alias(n) for i, n in enumerate(names)])


# fingerprints


def shingles(text, width=fingerprints.WIDTH):
    words = WORD.findall(text)
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints_against_shingle_sets(docs, texts):
    rows = {r.doc_id: r for r in fingerprints.edited_pairs(docs).collect()}
    assert sorted(rows) == list(range(len(texts)))
    prints = collections.defaultdict(set)
    for i, text in enumerate(t or "" for t in texts):
        after = texts[i - 1] or ""  # descending ids; after the first comes the last
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        assert rows[i].n_chars == len(text)
        assert rows[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        own, other, following = shingles(text), shingles(edited), shingles(after)
        for found, a, b in ((rows[i].near_edited, own, other), (rows[i].near_next, own, following)):
            slack = 1e-12 if len(a | b) < fingerprints.SIZE else 0.12
            assert abs(found - likeness(a, b)) <= slack, i
        prints[text].add(rows[i].fingerprint)
        if len(own) < fingerprints.SIZE:
            assert rows[i].distinct_shingles == len(own)
        else:
            assert abs(rows[i].distinct_shingles / len(own) - 1) < 0.25
    assert all(len(p) == 1 for p in prints.values())


def test_sketches_merge_as_sets_do(spark):
    half = [" ".join(f"w{i}" for i in range(a, b)) for a, b in ((0, 400), (300, 700))]
    whole = " ".join(f"w{i}" for i in range(700))
    rows = spark.createDataFrame([(0, *half, whole)], "k int, a string, b string, c string")
    for name in "abc":
        rows = fingerprints.with_sketch(rows, name, f"s{name}", size=64)
    parts = rows.select("k", F.explode(F.array("sa", "sb")).alias("s"))
    merged = fingerprints.merge_parts(parts, "k", "s", 64).first().s
    row = rows.select("*", fingerprints.merged(F.col("sa"), F.col("sb"), 64).alias("m")).first()
    assert merged == row.m == row.sc


def test_fingerprints_of_odd_rows(odd, empty):
    assert fingerprints.edited_pairs(odd).count() == odd.count()
    assert fingerprints.edited_pairs(empty).count() == 0
    one = fingerprints.edited_pairs(odd.where("doc_id = 0")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


# packing


def best_fit_decreasing(lengths, size):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            gaps.remove(min(fits))
        gaps.append((min(fits) if fits else size) - n)
    return len(gaps)


def test_words_by_themselves_are_the_whole_text():
    """Ids of words encoded many at a time, with a mark between them, against those of each whole text."""
    rng = random.Random(3)
    parts = [
        "a", "B", "'s", "'", "\x01", "\u0301", " ", "\u00a0", "\u00e9", "\u1112\u1161", "\u11ab", "1", "\u00b2", "*", "<|endoftext|>", "</s>",
        "\n", "\t", "\x0b", "\x1c", "\x85", "\u65e5", "\U0001f642", "\x00", "\u200d", "\u3000", "[UNK]", "\u03a3", "\u0130",
    ]
    path = token_counts.vocabulary("word_bpe_49k.json")
    whole, words = token_counts.tokenizer(path), packing.WordIds(path)
    for _ in range(150):
        texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(5)]
        words.known.clear()
        for text, ids in zip(texts, words.encode(texts)):
            assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, text
    assert words.encode([None, ""]) == [b"", b""]



def test_frequent_words_are_encoded_once_while_others_are_forgotten(monkeypatch):
    path = token_counts.vocabulary("word_bpe_49k.json")
    monkeypatch.setattr(packing, "WORDS_KEPT", 20)
    monkeypatch.setattr(packing, "_ids", {})
    whole, words, learned = token_counts.tokenizer(path), packing.WordIds(path), []
    learn = words.learn
    monkeypatch.setattr(words, "learn", lambda new: learned.extend(new) or learn(new))
    for i in range(60):
        text = f"often seen x{i} y{i}"
        assert np.frombuffer(words.encode([text])[0], "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids
        assert sum(map(len, words.turns)) <= 20 + 2 * 4
    assert learned.count(b"often") == 1 and learned.count(b"seen") == 1


def test_packing_round_trip(odd, empty):
    path, size = token_counts.vocabulary("word_bpe_49k.json"), 256
    encode = token_counts.tokenizer(path).encode
    wanted = collections.Counter()
    lengths = []
    for row in odd.select("doc_id", "text").collect():
        ids = encode(row.text or "", add_special_tokens=False).ids + [1]
        for j, start in enumerate(range(0, len(ids), size)):
            part = ids[start : start + size]
            lengths.append(len(part))
            wanted[row.doc_id, j, start, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))] += 1
    found = packing.pack(odd, path, size).collect()
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == wanted
    places = collections.defaultdict(list)
    for r in found:
        places[r.sequence_id].append((r.offset, r.length))
    for place in places.values():
        at = 0
        for offset, length in sorted(place):
            assert offset == at
            at += length
        assert at <= size
    assert len(places) <= best_fit_decreasing(lengths, size) + 1
    assert packing.pack(empty, path, size).count() == 0


def test_least_squares_is_never_negative_and_fits():
    import numpy as np

    rng = np.random.default_rng(1)
    a, x = rng.random((30, 12)), np.maximum(rng.normal(size=12), 0)
    found = packing.least_squares(a, a @ x)
    assert (found >= 0).all() and np.allclose(found, x, atol=1e-6)


# mixing


def test_mix_against_water_filling(odd):
    rows = mixing.mix(odd).collect()
    given = collections.Counter()
    sizes = collections.Counter()
    for r in odd.select("doc_id", "text", "source").collect():
        n = len(WORD.findall(r.text or ""))
        given[r.doc_id, n] += 1
        sizes[r.source] += n
    assert collections.Counter((r.doc_id, r["size"]) for r in rows) == given
    names = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    targets, free, rest = {}, set(names), float(sum(sizes.values()))
    while True:
        share = {s: rest * weight[s] / sum(weight[t] for t in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            targets |= share
            break
        for s in over:
            targets[s] = 3.0 * sizes[s]
            rest -= targets[s]
        free -= over
    taken, source = collections.Counter(), {(r.doc_id, r.text): r.source for r in odd.collect()}
    by_id = {d: s for (d, _), s in source.items()}
    for r in rows:
        assert r.taken in (0, r["size"], 2 * r["size"], 3 * r["size"])
        if r.doc_id not in (None, 3):
            assert r.target == pytest.approx(targets[by_id[r.doc_id]])
            assert r.source_size == sizes[by_id[r.doc_id]]
        taken[r.source_size] += r.taken
    largest = max(r["size"] for r in rows)
    for s in names:
        assert abs(taken[sizes[s]] - targets[s]) <= largest
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mixing.mix(odd.repartition(5)).collect()), key=str)


def test_resample_repeats_rows_as_the_mix_takes_them(odd, empty):
    taken = {(r.doc_id, r["size"]): r.taken for r in mixing.mix(odd).collect()}
    kept = mixing.resample(odd)
    assert kept.columns == odd.columns
    found = collections.Counter((r.doc_id, r.text) for r in kept.collect())
    given = collections.Counter((r.doc_id, r.text) for r in odd.select("doc_id", "text").collect())
    for (doc, text), n in given.items():
        size = len(WORD.findall(text or ""))
        assert found[doc, text] == n * (taken[doc, size] // size if size else 1)
    assert mixing.resample(empty).count() == mixing.mix(empty).count() == 0


# token counts


def test_token_counts_are_those_of_whole_texts(spark, docs, empty, texts):
    path = token_counts.vocabulary("byte_bpe_50k.json")
    tokenizer = token_counts.tokenizer(path)
    special = ["a <|endoftext|> b", "x<|endoftext|>y", " <|endoftext|>  z ", "tab\t <|endoftext|>\n q"]
    long = [" ".join(f"wörd{i % 97}'s\n" * (i % 3) + str(i) for i in range(900)), "x" * 3000, "  " * 2000, "日本 語" * 900, "a.b-c" * 700]
    some = [*texts, *special, *long, *(t * 40 for t in special)]
    rows = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string")
    for chunk, overlap in ((32_768, 512), (300, 8)):
        found = token_counts.token_counts(rows, path, chunk=chunk, overlap=overlap).collect()
        assert len(found) == len(some)
        for r in found:
            text = some[r.doc_id] or ""
            n = len(tokenizer.encode(text, add_special_tokens=False).ids)
            assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 1024), (chunk, r.doc_id)
    assert token_counts.token_counts(empty, path).count() == 0


# languages


def test_languages_of_held_out_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = langid.identify(docs).collect()
    given = {r.doc_id: r for r in docs.collect()}
    assert len(rows) == len(given)
    right = total = 0
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        text, lang = given[r.doc_id].text, given[r.doc_id].lang
        if not any(c.isalpha() for c in text or ""):
            assert r.lang_pred == "und"
        elif r.held_out and lang is not None and len(text) > 100:
            total += 1
            right += r.lang_pred == lang
    assert total and right / total >= 0.9


def test_numbers_that_are_no_digits_are_no_letters(spark, folder):
    import unicodedata

    for text in ("² ½ 12", "Ⅷ ①", "x² + y½z", "naïve Ⅳa_b9c 日本", "", "ªº"):
        plain = "".join(c if unicodedata.category(c).startswith("L") else " " for c in text).split()
        assert langid.words_of(text) == plain
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(-1, "² ½ 12", None), (-2, "Ⅷ ① ٣", None), (-3, "² a", None)], "doc_id long, text string, lang string")
    found = {r.doc_id: r for r in langid.identify(docs.unionByName(odd)).where("doc_id < 0").collect()}
    assert [(found[-i].lang_pred, found[-i].score) for i in (1, 2)] == [("und", 0.0)] * 2 and found[-3].lang_pred != "und"


def test_languages_of_odd_rows(odd, empty):
    assert langid.identify(odd).count() == odd.count()
    assert langid.identify(empty).count() == 0
    kept = langid.reject_unknown(odd, least=0.0)
    assert kept.columns == odd.columns
    with_letter = [r for r in odd.collect() if any(c.isalpha() for c in r.text or "")]
    assert kept.count() == len(with_letter)


def test_without_a_label_every_text_is_undetermined(docs):
    found = langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in found} == {("und", 0.0)}


# urls


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), path


def rule_for(host, path):
    best = None
    for rule, verdict in url_filter.RULES:
        name, _, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            if best is None or len(rule) > len(best[0]):
                best = (rule, verdict)
    return best


def page_rank(edges, seeds, damping=0.85, rounds=20):
    total = collections.Counter()
    for (a, _), n in edges.items():
        total[a] += n
    whole = sum(seeds.values()) or 1
    seeds = {h: n / whole for h, n in seeds.items() if n}
    rank = dict(seeds)
    if not edges or not seeds:
        return rank
    for _ in range(rounds):
        moved = collections.Counter()
        for (a, b), n in edges.items():
            moved[b] += damping * rank.get(a, 0.0) * n / total[a]
        rest = 1.0 - sum(moved.values())
        rank = {h: moved.get(h, 0.0) + seeds.get(h, 0.0) * rest for h in {*moved, *seeds}}
    return rank


def test_url_verdicts_against_page_rank(spark):
    def links(*hosts):
        return "".join(f'<a href="https://{h}/x">x</a>' for h in hosts)

    pages = [
        ("http://good.org/a", links("near.net", "near.net", "both.net")),
        ("https://Example.ORG/es/1?q", links("bad.net")),
        ("http://example.org/en/12#f", None),
        ("http://sub.example.org/en/2", links("far.net", "sub.example.org")),
        ("http://shop.com/de/x", links("both.net")),
        ("http://shop.com/fr/x", ""),
        ("http://points.net/z", links("shop.com", "example.org")),
        ("http://both.net/", links("shop.com", "good.org")),
        ("http://near.net?p=a/b", "<a href='/local'>" + links("NEAR.net")),
        ("http://alone.net", "no link"),
        ("http://org", ""),
        ("no scheme", links("shop.com")),
        ("", None),
        (None, links("shop.com")),
        ("http://notexample.org.net/es/", links("points.net")),
        ("http://a://b/c", None),
    ]
    pages += pages[:2]
    rows = spark.createDataFrame([(i, u, h, "x", 1.0) for i, (u, h) in enumerate(pages)], "page_id long, url string, html string, rule string, trust double")
    found = {r.page_id: r for r in url_filter.judge(rows).collect()}
    edges, good, bad = collections.Counter(), collections.Counter(), collections.Counter()
    for url, html in pages:
        host, path = split_url(url)
        fit = rule_for(host, path)
        if fit:
            (good if fit[1] == "allow" else bad)[host] += 1
        for target in re.findall(r'href="https://([^/]+)/', html or ""):
            if host and target.lower() != host:
                edges[host, target.lower()] += 1
    trust, distrust = page_rank(edges, good), page_rank({(b, a): n for (a, b), n in edges.items()}, bad)
    assert len(found) == len(pages)
    for i, (url, _) in enumerate(pages):
        host, path = split_url(url)
        fit = rule_for(host, path)
        by_links = "block" if distrust.get(host, 0.0) > trust.get(host, 0.0) else "allow"
        assert (found[i].host, found[i].path, found[i].rule) == (host, path, fit and fit[0])
        assert found[i].verdict == (fit[1] if fit else by_links)
        assert found[i].trust == pytest.approx(trust.get(host, 0.0))
        assert found[i].distrust == pytest.approx(distrust.get(host, 0.0))
    assert {found[i].verdict for i in (6, 8)} == {"allow", "block"}
    assert url_filter.judge(rows.where("page_id < 0")).count() == 0


def test_a_kept_text_is_sent_to_the_language_model_once(spark):
    docs = spark.createDataFrame([(i, text, lang) for i, (text, lang) in enumerate([("the cat sat", "en"), ("le chat dort", "fr")] * 5)], "doc_id long, text string, lang string")
    model = langid.fit(docs)
    kept = langid.predict(docs, model, keep=("doc_id", "text"))
    assert "_text" not in kept._jdf.queryExecution().toString()
    plain = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(docs, model).collect()}
    assert {r.doc_id: (r.lang_pred, r.score) for r in kept.collect()} == plain
    assert {r.doc_id: r.text for r in kept.collect()} == {r.doc_id: r.text for r in docs.collect()}
    assert {lang for lang, _ in plain.values()} == {"en", "fr"}
