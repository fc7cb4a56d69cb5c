"""The registered queries of this package: each applies one operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from evgraph.llm import collocations, fingerprints, jaccard_join, langid, line_dedup, mixing, packing, pivot_index, quality, repeat_index, token_counts, url_filter, whitening
from evgraph.llm.steps import prepared

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(table: str):
    """Register ``fn(table) -> DataFrame`` under its own name."""

    def keep(fn: Callable[[DataFrame], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(prepared(spark).read.parquet(f"{folder.rstrip('/')}/{table}.parquet"))

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[fn.__name__] = run
        return fn

    return keep


@query("documents")
def op1_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    return fingerprints.edited_pairs(docs)


@query("documents")
def op2_jaccard_join(docs: DataFrame) -> DataFrame:
    """Component of every document under links of 0.9 by sets of three words."""
    return jaccard_join.classes(docs)


@query("documents")
def op3_line_dedup(docs: DataFrame) -> DataFrame:
    """Lines of every document, those that repeat an earlier one, and what stays."""
    return line_dedup.report(docs)


@query("documents")
def op4_best_fit_packing(docs: DataFrame) -> DataFrame:
    """Every piece of every document with its place in a sequence of 4096 tokens."""
    return packing.pack(docs, token_counts.vocabulary("word_bpe_49k.json"), 4096)


@query("documents")
def op5_quality_rules(docs: DataFrame) -> DataFrame:
    """Base counts and the verdict on every document."""
    return quality.judge(docs)


@query("documents")
def op6_repeat_index(docs: DataFrame) -> DataFrame:
    """Bytes of every document that repeat passages of earlier ones, and the hash of what stays."""
    return repeat_index.report(docs)


@query("documents")
def op7_mixing(docs: DataFrame) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mix(docs)


@query("documents")
def op8_token_counts(docs: DataFrame) -> DataFrame:
    """Tokens of every whole text."""
    return token_counts.token_counts(docs, token_counts.vocabulary("byte_bpe_50k.json"))


@query("documents")
def op9_language_id(docs: DataFrame) -> DataFrame:
    """Predicted language of every document."""
    return langid.identify(docs)


@query("pages")
def op10_url_filters(pages: DataFrame) -> DataFrame:
    """Verdict on every page."""
    return url_filter.judge(pages)


@query("documents")
def op11_collocations(docs: DataFrame) -> DataFrame:
    """The first 2000 phrases of every language."""
    return collocations.mine(docs)


@query("embeddings")
def op12_whitening(vectors: DataFrame) -> DataFrame:
    """Every vector in the first eight components, with unit covariance."""
    return whitening.whitened(vectors)


@query("embeddings")
def op13_pivot_index(vectors: DataFrame) -> DataFrame:
    """Links and component of every vector."""
    return pivot_index.near_classes(vectors)


# The digest of op11 in plain SQL: n-grams of every piece, counted, cut and ranked.
ORACLES["op11_collocations"] = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
grams AS (
  SELECT lang, 1 AS k, unnest(w) AS phrase FROM words
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words
  UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM words),
f AS (SELECT lang, k, phrase, count(*)::HUGEINT AS a FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(a) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND a >= 10),
inside AS (
  SELECT lang, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase, a AS longer FROM c WHERE k = 3),
kept AS (
  SELECT c.* FROM c LEFT JOIN (SELECT lang, phrase, max(longer) AS longer FROM inside GROUP BY ALL) i USING (lang, phrase)
  WHERE longer IS NULL OR 100 * longer < 50 * a),
cuts AS (
  SELECT lang, phrase, a, w, 1 AS cut, w[1] AS head, array_to_string(w[2:], ' ') AS tail FROM kept
  UNION ALL SELECT lang, phrase, a, w, 2, w[1] || ' ' || w[2], w[3] FROM kept WHERE k = 3),
scored AS (
  SELECT cuts.lang, cuts.phrase, cuts.a, x.a AS l, y.a AS r, (1000000::HUGEINT * cuts.a * cuts.a) // (x.a * y.a) AS score, cut
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = head JOIN f y ON y.lang = cuts.lang AND y.phrase = tail),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM best)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
