"""From a claim back to the document page that supports it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def guard(citations: DataFrame, manifest: DataFrame) -> DataFrame:
    """Only citations of documents that were retrieved."""
    usable = manifest.where(F.col("status") == "retrieved").select("doc_id").distinct()
    return citations.join(usable, "doc_id", "left_semi")


def coverage(claims: DataFrame, documents: DataFrame) -> DataFrame:
    """Per claim kind, how many claims cite an existing document. Claims are counted
    per (kind, document) before the join."""
    cited = claims.groupBy("kind", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    known = documents.select("doc_id").distinct().withColumn("_known", F.lit(1))
    n, covered = F.sum("n"), F.coalesce(F.sum(F.when(F.col("_known") == 1, F.col("n"))), F.lit(0))
    return cited.join(known, "doc_id", "left").groupBy("kind").agg(
        n.alias("n_claims"), covered.alias("n_covered"), (n - covered).alias("n_uncovered"),
        (covered / n).alias("coverage"),
    )


def uncovered(claims: DataFrame, documents: DataFrame) -> DataFrame:
    """The claims without a path to a document."""
    return claims.join(documents.select("doc_id").distinct(), "doc_id", "left_anti")


SPAN = 4096  # characters of a bucket


def bucketed(spans: DataFrame, width: int, *columns: str) -> DataFrame:
    """doc_id, bucket, start and end of every bucket of ``width`` characters that a span (start_char, end_char) meets."""
    start = F.floor(F.col("start_char") / width)
    last = F.floor(F.greatest(F.col("end_char") - 1, F.col("start_char")) / width)
    return spans.select(
        "doc_id", F.explode(F.sequence(start, last)).alias("bucket"), F.col("start_char").alias("_start"),
        F.col("end_char").alias("_end"), *columns,
    )


def trace(assertions: DataFrame, facts: DataFrame, chunks: DataFrame, pages: DataFrame, width: int = SPAN) -> DataFrame:
    """One row per assertion and fact, with the chunk and the page its first character lies in.

    Characters lie in one chunk and on one page, so a fact has one of each, also where a line is shared by two.
    Facts meet spans by document and bucket of ``width`` characters, so a long document spreads over many keys
    and a fact is compared with the few spans of its bucket."""
    f = facts.select("fact_id", "doc_id", "line_no", "start_char").withColumn("bucket", F.floor(F.col("start_char") / width))
    inside = (F.col("start_char") >= F.col("_start")) & (F.col("start_char") < F.col("_end"))
    met = assertions.select("assertion_id", "fact_id").join(f, "fact_id")
    for spans in (bucketed(chunks, width, "chunk_no", "content_hash"), bucketed(pages, width, "page_no")):
        met = met.join(spans, ["doc_id", "bucket"]).where(inside).drop("_start", "_end")
    return met.select("assertion_id", "fact_id", "doc_id", "line_no", "start_char", "chunk_no", "content_hash", "page_no")
