"""The pipeline against plain Python, stage by stage, on a table where every stage acts."""

import collections
import math
import random
import zlib

import pytest
import xxhash
from test_joins import brute_components, within
from tokenizers import Tokenizer

import corpus_pipeline
from evgraph.llm import langid, line_dedup, mixing, token_counts

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _source string, _copy int"


def made_rows():
    rng = random.Random(11)
    words = {
        lang: ["".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(150)]
        for lang, letters in (("xx", "abcdefgh"), ("yy", "mnopqrst"))
    }

    def line(lang, n):
        return " ".join(rng.choice(words[lang]) for _ in range(n))

    texts = [("\n".join(line(lang, rng.randint(6, 25)) for _ in range(rng.randint(1, 4))), lang) for lang in ("xx", "yy") for _ in range(22)]
    shared = line("xx", 12)
    near = shared[:20] + "h" + shared[21:]
    texts += [(f"{line('xx', 9)}\n{x}\n{line('xx', 8)}", "xx") for x in (shared, shared, near, shared + "a", shared + "abcde")]
    texts += [(f"{line('yy', 30)}\nmno\n\n  \n{line('yy', 9)}\nmno", "yy"), ("mno", "yy")]  # the second keeps no word
    base = [line("yy", 120) for _ in range(3)]
    for i in range(4):  # near copies line by line further apart than two edits, near as documents
        texts.append(("\n".join(f"nnnnn{'opqr'[i] * 4} {x} sssss{'tqro'[i] * 4}" for x in base), "yy"))
    texts += [("\n".join(" ".join(w for pair in zip(line("xx", 8).split(), line("yy", 8).split()) for w in pair) for _ in range(2)), None) for _ in range(4)]
    texts += [(None, "xx"), ("", "yy"), ("12 34 ² ½ Ⅷ", None), (" \t\n ", None), ("unheard words qz", None), (line("xx", 3000), "xx")]
    order = list(range(len(texts)))
    rng.shuffle(order)
    return [
        (i, texts[j][0], texts[j][1], ["a", "b", None, "a"][rng.randrange(4)], len(texts[j][0] or ""), "kept", 7)
        for i, j in enumerate(order)
    ]


def language(rows):
    """Word-first scores from counts of all labelled texts."""
    counts = {kind: collections.defaultdict(collections.Counter) for kind in (0, *langid.ORDERS)}
    for _, text, lang, *_ in rows:
        if lang is not None and text is not None:
            start = max(1, (len(text) - 3000) // 2) - 1
            for word in langid.words_of(text[start : start + 3000].lower()):
                counts[0][lang][word] += 1
                for k in langid.ORDERS:
                    for i in range(len(word) + 3 - k):
                        counts[k][lang][f"_{word}_"[i : i + k]] += 1
    languages = sorted({lang for _, text, lang, *_ in rows if lang is not None and text is not None})
    seen = {k: set().union(*counts[k].values()) for k in counts}
    total = {k: {lang: sum(counts[k][lang].values()) + 0.5 * (len(seen[k]) + 1) for lang in languages} for k in counts}

    def log(kind, gram, lang):
        return math.log((counts[kind][lang][gram] + 0.5) / total[kind][lang])

    def word_log(word, lang):
        if word in seen[0]:
            return log(0, word, lang)
        for k in langid.ORDERS:
            grams = [f"_{word}_"[i : i + k] for i in range(len(word) + 3 - k)]
            if any(g in seen[k] for g in grams):
                return sum(log(k, g, lang) for g in grams) / len(grams)
        return 0.0

    kept = []
    for row in rows:
        words = langid.words_of((row[1] or "").lower())
        if words:
            sums = [sum(word_log(w, lang) for w in words) for lang in languages]
            score = 1 / sum(math.exp((s - max(sums)) / math.sqrt(len(words))) for s in sums)
            if score >= 0.6:
                kept.append(row)
    return kept


def lines(rows):
    """A line goes when an earlier one equals it, or is within two edits and both are long."""
    before, kept = [], []
    for row in sorted(rows):
        stay = []
        for line in row[1].split("\n"):
            if not line.strip(" "):
                stay.append(line)
                continue
            near = len(line) >= line_dedup.NEAR
            if not any(line == x or near and len(x) >= line_dedup.NEAR and within(line, x) for x in before):
                stay.append(line)
            before.append(line)
        text = "\n".join(stay)
        if text == row[1] or text.strip():
            kept.append((row[0], text, *row[2:4], len(text), *row[5:]))
    return kept


def one_of_each(rows):
    rows = sorted(rows)
    least = brute_components([r[1] for r in rows], 5, 80)[1]
    return [r for i, r in enumerate(rows) if least[i] == i]


def mix(rows):
    def key(row):
        seed = xxhash.xxh64_intdigest(str(row[0]).encode(), 42)
        return xxhash.xxh64_intdigest(row[1].encode(), seed) >> 8

    sizes = collections.Counter()
    for row in rows:
        sizes[row[3]] += len(row[1].split())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[i % len(mixing.WEIGHTS)] for i, s in enumerate(order)}
    total, held = sum(sizes.values()), {}
    while True:  # sources above their most are held there, the rest shared anew
        free = [s for s in order if s not in held]
        level = (total - sum(held.values())) / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * level >= 3 * sizes[s]]
        if not over:
            break
        held.update((s, 3.0 * sizes[s]) for s in over)
    out = []
    for s in order:
        target = held.get(s, weight[s] * level)
        whole = int(target / sizes[s] + 1e-9)
        left, open_, taken = target - whole * sizes[s], True, collections.Counter()
        for row in sorted((r for r in rows if r[3] == s), key=key):
            n = len(row[1].split())
            more = open_ and n > 0 and (n <= left or n <= 2 * left)
            open_ = open_ and n <= left
            left -= n
            taken[row] = whole + more if n else 1
        out += [row for row, n in taken.items() for _ in range(n)]
    return out


def test_every_stage_equals_plain_python(spark, tmp_path):
    rows = made_rows()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns = docs.columns
    for i, ((name, stage), plain) in enumerate(zip(corpus_pipeline.STAGES, (language, lines, one_of_each, mix))):
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        before, rows = rows, plain(rows)
        assert docs.columns == columns, name
        assert collections.Counter(map(tuple, docs.collect())) == collections.Counter(rows), name
        assert collections.Counter(rows) != collections.Counter(before), f"{name} does nothing here"

    tokenizer = Tokenizer.from_file(token_counts.vocabulary("word_bpe_49k.json"))
    want = collections.Counter()
    for row in rows:
        ids = [*tokenizer.encode(row[1], add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            want[row[0], piece, start, len(part), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part))] += 1
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == want
    sequences = collections.defaultdict(list)
    for r in packed:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 4096
    least = -(-sum(k[3] * n for k, n in want.items()) // 4096)
    assert least <= len(sequences) <= least + 1


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None, None, None)] * 3])
def test_tables_without_text(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_python_gets_whole_texts_in_small_batches(spark):
    """Both sides of a step hold a batch of texts outside the heap."""
    import pyarrow as pa

    from evgraph.llm.steps import prepared

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    found = [r.n for r in prepared(spark).range(5000, numPartitions=1).mapInArrow(sizes, "n long").collect()]
    assert sum(found) == 5000 and max(found) <= 1000
