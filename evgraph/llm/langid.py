"""Language of a text: known words first, shorter and shorter character n-grams for the rest.

A word that was learned scores its smoothed log frequency in each language. An unseen word
backs off to its character n-grams of the longest order of which one was learned, at a fixed
penalty for each order that it falls back. A text's score of a language is the sum over its words.

The model is fitted on a bounded, documented sample: of every language the ``per_language``
labelled rows with the smallest hash of id and text (``sample_chars`` code points of a row's middle
at most), so its size does not grow with the input and reruns agree. Everything that is
predicted, is predicted from whole texts.

Edge cases: a null text, or one without a letter, is ``und`` with score 0; rows with null
labels teach nothing; without any labelled row every text is ``und``; repeated rows get the
same answer; ties between languages go to the smallest label; the empty table gives the
empty table; further columns are kept by ``reject_unknown`` and left out of predictions.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

RUNS = re.compile(r"[^\W\d_]+")
ORDERS = (5, 4, 3, 2, 1)
UND = "und"


def words_of(text: str) -> list[str]:
    """Runs of letters, Unicode category L. Runs that ``re`` finds may hold numbers that are no digits, such as
    superscripts, fractions and Roman numerals; those are rare and cut there."""
    runs = RUNS.findall(text)
    if "".join(runs).isalpha():
        return runs
    return [word for run in runs for word in "".join(c if c.isalpha() else " " for c in run).split()]


def held_out(key: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """Whether a row is kept from training: its id's CRC decides."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % folds == fold, F.lit(False))


def labelled_sample(labelled: DataFrame, per_language: int, sample_chars: int) -> DataFrame:
    """(lang, text): the rows of each language with the smallest hashes."""
    order = Window.partitionBy("lang").orderBy("_h", "text")
    size = F.length("text")
    start = F.greatest(F.lit(1), ((size - sample_chars) / 2).cast("int"))
    return (
        labelled.where("lang is not null and text is not null")
        .select("lang", "doc_id", "text", F.xxhash64(F.col("doc_id").cast("string"), "text").alias("_h"))
        .select("lang", F.substr("text", start, F.lit(sample_chars)).alias("text"), "_h")
        .withColumn("_n", F.row_number().over(order))
        .where(F.col("_n") <= per_language)
        .select("lang", "text")
    )


def _counted(batches):
    """(lang, kind, gram, n) of sampled texts: kind 0 words, else the order of an n-gram."""
    from collections import Counter

    counts: dict[tuple[str, int], Counter] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = Counter(words_of(text.lower()))
            counts.setdefault((lang, 0), Counter()).update(words)
            for order in ORDERS:
                grams = counts.setdefault((lang, order), Counter())
                for word, n in words.items():
                    padded = f"_{word}_"
                    for i in range(len(padded) - order + 1):
                        grams[padded[i : i + order]] += n
    for (lang, kind), grams in counts.items():
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * len(grams), pa.string()),
                pa.array([kind] * len(grams), pa.int32()),
                pa.array(list(grams), pa.string()),
                pa.array(list(grams.values()), pa.int64()),
            ],
            names=["lang", "kind", "gram", "n"],
        )


class Model:
    """Log frequencies of words and n-grams by language, under fixed languages in order."""

    def __init__(self, languages: list[str], places: dict[int, dict[str, int]], logs: dict[int, np.ndarray], penalty: float):
        """``places`` gives a gram's row in ``logs``; the last row is that of unseen grams."""
        self.languages, self.places, self.logs, self.penalty = languages, places, logs, penalty

    def word(self, word: str) -> np.ndarray:
        known = self.places[0].get(word)
        if known is not None:
            return self.logs[0][known]
        padded = f"_{word}_"
        for step, order in enumerate(ORDERS):
            at = [self.places[order].get(padded[i : i + order], -1) for i in range(len(padded) - order + 1)]
            if any(i >= 0 for i in at):
                return self.logs[order][at].mean(axis=0) - np.float32((step + 1) * self.penalty)
        return np.zeros(len(self.languages), np.float32)


def fit(labelled: DataFrame, per_language: int = 500, sample_chars: int = 3000, penalty: float = 0.5) -> Model:
    """A model of at most ``per_language`` texts of ``sample_chars`` characters a language."""
    sample = labelled_sample(labelled, per_language, sample_chars)
    rows = (
        sample.mapInArrow(_counted, "lang string, kind int, gram string, n long")
        .groupBy("lang", "kind", "gram")
        .agg(F.sum("n").alias("n"))
        .toArrow()
        .to_pydict()
    )
    languages = sorted(set(rows["lang"]))
    place = {lang: i for i, lang in enumerate(languages)}
    kinds = (0, *ORDERS)
    places: dict[int, dict[str, int]] = {k: {} for k in kinds}
    at = [places[kind].setdefault(gram, len(places[kind])) for kind, gram in zip(rows["kind"], rows["gram"])]
    counts = {k: np.full((len(places[k]) + 1, len(languages)), 0.5) for k in kinds}  # half a count for the unseen
    for lang, kind, i, n in zip(rows["lang"], rows["kind"], at, rows["n"]):
        counts[kind][i, place[lang]] += n
    logs = {k: np.log(c / c.sum(axis=0)).astype(np.float32) for k, c in counts.items()}
    return Model(languages, places, logs, penalty)


def predict(
    docs: DataFrame, model: Model, key: str = "doc_id", keep: tuple[str, ...] = (), names: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """``keep`` columns, lang_pred and score (the winner's share of the probability, with the
    evidence of a text tempered to its square root) for every row; ``names`` are the two columns' names."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # bounded by the sample's size
    columns = list(keep) or [key]
    own = "text" in columns and docs.schema["text"].dataType.typeName() == "string"  # a kept text is sent once
    at = columns.index("text") if own else len(columns)

    def run(batches):
        model = shared.value
        known: dict[str, int] = {}
        rows = np.zeros((1024, len(model.languages)), np.float32)
        for batch in batches:
            languages, scores = [], []
            if len(known) > 300_000:
                known.clear()
            for value in batch.column(at):
                text = value.as_py()
                words = words_of(text.lower()) if text and model.languages else []
                if not words:
                    languages.append(UND)
                    scores.append(0.0)
                    continue
                for word in set(words).difference(known):
                    if len(known) == len(rows):
                        rows = np.concatenate([rows, np.zeros_like(rows)])
                    rows[len(known)] = model.word(word)
                    known[word] = len(known)
                seen, times = np.unique(np.fromiter(map(known.__getitem__, words), np.int64, len(words)), return_counts=True)
                total = np.add.reduce(rows[seen] * times.astype(np.float32)[:, None], axis=0, dtype=np.float64)
                best = int(np.argmax(total))
                share = np.exp((total - total[best]) / np.sqrt(len(words)))
                languages.append(model.languages[best])
                scores.append(float(1.0 / share.sum()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(columns)], pa.array(languages, pa.string()), pa.array(scores, pa.float64())],
                names=[*columns, *names],
            )

    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns]
    sent = [] if own else [F.col("text").cast("string").alias("_text")]
    return docs.select(*[F.col(f"`{c}`") for c in columns], *sent).mapInArrow(
        run, ", ".join([*kinds, f"`{names[0]}` string", f"`{names[1]}` double"])
    )


def identify(docs: DataFrame, **settings) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from the labelled rows that are not held out."""
    model = fit(docs.select("doc_id", "text", "lang").where(~held_out()), **settings)
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def reject_unknown(docs: DataFrame, least: float = 0.6, **settings) -> DataFrame:
    """The rows, with all their columns, whose language is known with a score of ``least``."""
    model = fit(docs.select("doc_id", "text", "lang"), **settings)
    columns = docs.columns
    names = tuple("_" * (1 + max(map(len, columns))) + c for c in ("lang_pred", "score"))  # longer than any given name
    return (
        predict(docs, model, keep=tuple(columns), names=names)
        .where((F.col(names[0]) != UND) & (F.col(names[1]) >= least))
        .select(*[F.col(f"`{c}`") for c in columns])
    )
