"""Candidate offices for a need, by text or by given vectors. Never proof of ownership."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from evgraph.functions.text import term_counts
from evgraph.operators import vector_index
from evgraph.session import held, written

TERM_SCALE = 6
LEVELS = 2  # lists per halving of a posting's impact
MOST_LEVEL = 62
GIVEN = 0.6  # of a threshold: what closed lists may hold of a passage's score
SLACK = 2 * 10.0**-TERM_SCALE  # scores are compared rounded
MOST_NEEDS = 20_000  # whose weights each task may hold
FREQUENT = 200_000  # terms whose weights come to the passages; the postings of all others go to their weights


def inverse_frequency(terms: DataFrame, total: int) -> DataFrame:
    """term, idf of (passage, term, tf) rows; a term of every passage weighs nothing and is left out."""
    counted = terms.groupBy("term").agg(F.count(F.lit(1)).alias("_df"))
    return counted.select("term", F.log(total / F.col("_df")).alias("idf")).where("idf > 0")


def asked_terms(needs: DataFrame, idf: DataFrame) -> DataFrame:
    """need, term, qw: the terms of each need with weights of length one."""
    asked = needs.select("need", F.inline(term_counts(F.col("text")))).join(idf, "term")
    asked = asked.select("need", "term", (F.col("tf") * F.col("idf")).alias("qw"))
    length = asked.groupBy("need").agg(F.sqrt(F.sum(F.col("qw") * F.col("qw"))).alias("_qlen"))
    return asked.join(length, "need").select("need", "term", (F.col("qw") / F.col("_qlen")).alias("qw"))


def forward_index(counted: DataFrame, idf: DataFrame, asked: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """passage_id, office, plen and the weighted terms some need asks for, one row per passage that has any.

    Most postings are of a few terms. The weights of the most frequent ones are a table of bounded size, which the
    passages' tasks hold, so their postings are summed up before they move; only rare terms move as postings."""
    key = ["office", "passage_id"]
    wanted = asked.select("term").distinct().withColumn("_asked", F.lit(True))
    idf = written(idf.join(wanted, "term", "left"), "weighted-terms")
    n = idf.count()
    cut = idf.agg(F.percentile_approx("idf", frequent / n, 10_000)).first()[0] if n > frequent else float("inf")
    known = held(written(idf.where(F.col("idf") < cut), "frequent-terms"))
    terms = counted.select(*key, F.inline("_terms"))
    moved = terms.join(known.select("term"), "term", "left_anti").join(idf.where(F.col("idf") >= cut), "term")
    weighted = terms.join(known, "term").unionByName(moved).withColumn("w", F.col("tf") * F.col("idf"))
    return weighted.groupBy(*key).agg(
        F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("plen"),
        F.collect_list(F.when(F.col("_asked"), F.struct("term", "w"))).alias("met"),
    ).where(F.size("met") > 0)


def posting_lists(forward: DataFrame) -> DataFrame:
    """term, level, impact, passage_id: a list per term and level of impact, the best level first. A
    posting's impact is the term's weight in the passage over the passage's length."""
    rows = forward.select("passage_id", "plen", F.inline("met")).withColumn("impact", F.col("w") / F.col("plen"))
    level = F.least(F.floor(-F.log2("impact") * LEVELS), F.lit(MOST_LEVEL))
    return rows.select("term", F.greatest(level, F.lit(0)).cast("int").alias("level"), "impact", "passage_id")


def scored_pairs(pairs: DataFrame, forward: DataFrame, weights: DataFrame) -> DataFrame:
    """need, office, passage_id, score of the candidate (need, passage_id) pairs, by all terms they share."""
    dot = F.aggregate(
        "met", F.lit(0.0), lambda s, x: s + x["w"] * F.coalesce(F.try_element_at(F.col("_weights"), x["term"]), F.lit(0.0))
    )
    joined = pairs.join(forward, "passage_id").join(weights, "need")
    return joined.select("need", "office", "passage_id", F.round(dot / F.col("plen"), TERM_SCALE).alias("score"))


def best_passages(scored: DataFrame) -> DataFrame:
    """need, office, score, passage_id: each office's best passage, the smallest of equals."""
    best = F.min(F.struct((-F.col("score")).alias("neg"), "passage_id")).alias("_best")
    return scored.groupBy("need", "office").agg(best).select(
        "need", "office", (-F.col("_best.neg")).alias("score"), F.col("_best.passage_id").alias("passage_id")
    )


def open_lists(lists: DataFrame, thresholds: DataFrame) -> DataFrame:
    """need, term, level, qw, cut, cuts, t of the lists a need has to open to find every passage that scores ``t`` or more.

    Lists are closed from their low ends, those first that save most postings for the gain given away, while
    the gains given away by all terms stay below ``GIVEN`` of the threshold. ``cut`` is what a posting of the term can
    give at most outside the open lists, ``cuts`` the sum over the need's terms. A passage on no open list scores ``cuts`` at
    most, so it can't reach the threshold."""
    low_first = Window.partitionBy("need", "term").orderBy(F.desc("level"))
    saved = F.sum("n").over(low_first.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = lists.withColumn("_worth", saved / F.col("gain"))
    in_term = Window.partitionBy("need", "term").orderBy(F.desc("_worth"), F.desc("level"))
    in_need = Window.partitionBy("need").orderBy(F.desc("_worth"), "term", F.desc("level"))
    before = F.coalesce(F.max("gain").over(in_term.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    given = F.sum("_more").over(in_need.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = ranked.withColumn("_more", F.greatest(F.lit(0.0), F.col("gain") - before)).withColumn("_given", given)
    ranked = ranked.join(thresholds, "need").withColumn("_closed", F.col("_given") < GIVEN * F.col("t"))
    ranked = ranked.withColumn("cut", F.coalesce(F.max(F.when(F.col("_closed"), F.col("gain"))).over(Window.partitionBy("need", "term")), F.lit(0.0)))
    ranked = ranked.withColumn("cuts", F.coalesce(F.max(F.when(F.col("_closed"), F.col("_given"))).over(Window.partitionBy("need")), F.lit(0.0)))
    return ranked.where(F.col("gain") > F.col("cut")).select("need", "term", "level", "qw", "cut", "cuts", "t")


def candidate_pairs(asked: DataFrame, postings: DataFrame, forward: DataFrame, weights: DataFrame, k: int) -> DataFrame:
    """(need, passage_id) pairs that hold the best passages of the k best offices of every need.

    A need first opens the lists of its largest gains until they hold a few times k postings; the k-th office found
    there is its threshold. Then it opens the lists that the threshold calls for, and a passage met on them is kept if
    its gains there, with all that closed lists could add, reach the threshold."""
    lists = postings.groupBy("term", "level").agg(F.max("impact").alias("most"), F.count(F.lit(1)).alias("n"))
    lists = asked.join(lists, "term").select("need", "term", "level", "n", "qw", (F.col("qw") * F.col("most")).alias("gain"))
    order = Window.partitionBy("need").orderBy(F.desc("gain"), "term", "level")
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    lists = written(lists.withColumn("_first", before < 4 * k), "lists")
    first = held(written(lists.where("_first").select("need", "term", "level"), "first"))
    first = first.join(postings, ["term", "level"]).select("need", "passage_id").distinct()
    first = held(written(first, "pairs"))  # so that a few pairs don't make the passages move
    rank = F.row_number().over(Window.partitionBy("need").orderBy(F.desc("score"), "office"))
    found = best_passages(scored_pairs(first, forward, weights)).withColumn("_r", rank).where(F.col("_r") <= k)
    kth = found.groupBy("need").agg(F.when(F.count(F.lit(1)) >= k, F.min("score") - SLACK).otherwise(0.0).alias("t"))
    thresholds = asked.select("need").distinct().join(kth, "need", "left").select("need", F.coalesce("t", F.lit(0.0)).alias("t"))
    opened = held(written(open_lists(lists.drop("_first"), thresholds), "opened"))  # so that the postings don't move
    met = opened.join(posting_lists(forward.repartition("passage_id")), ["term", "level"])  # gains then meet where their passage is
    gains = met.groupBy("need", "passage_id").agg(
        F.sum(F.col("qw") * F.col("impact") - F.col("cut")).alias("_over"), F.first("cuts").alias("cuts"), F.first("t").alias("t")
    )
    return written(gains.where(F.col("_over") + F.col("cuts") >= F.col("t")).select("need", "passage_id"), "pairs")


def match_need(needs: DataFrame, passages: DataFrame, k: int = 3) -> DataFrame:
    """The k offices whose best passage is closest to each need by TF-IDF cosine.

    ``needs``: need, text. ``passages``: office, passage_id (of any type with an order), text. Words are counted inside
    the passage's row, once, into a written table that keeps the text for the answers. A need meets
    a passage only through a list it opened; see ``candidate_pairs``. The best passage of an office is an aggregate and
    the rank limit runs before the last shuffle.
    """
    counted = written(passages.select("office", "passage_id", "text", term_counts(F.col("text")).alias("_terms")), "passages", "zstd")
    idf = written(inverse_frequency(counted.select(F.inline("_terms")), counted.count()), "term-weights")
    asked = written(asked_terms(needs, idf), "asked-terms")
    forward = written(forward_index(counted, idf, asked), "forward", "zstd")
    weights = asked.groupBy("need").agg(F.map_from_entries(F.collect_list(F.struct("term", "qw"))).alias("_weights"))
    weights = held(written(weights, "weights"), MOST_NEEDS)
    scored = scored_pairs(candidate_pairs(asked, posting_lists(forward), forward, weights, k), forward, weights)
    order = Window.partitionBy("need").orderBy(F.desc("score"), "office")
    top = best_passages(scored).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    texts = counted.select("passage_id", F.col("text").alias("passage"))
    return top.join(texts, "passage_id").withColumn("label", F.lit("candidate"))


def office_profiles(vectors: DataFrame, dim: int) -> DataFrame:
    """One mean vector per office, averaged component by component without exploding."""
    means = [F.avg(F.col("embedding")[i].cast("double")) for i in range(dim)]
    return vectors.groupBy("office").agg(F.array(*means).alias("profile"))


def match_vectors(needs: DataFrame, profiles: DataFrame, k: int = 3, block: int = 1_000) -> DataFrame:
    """The k offices closest to each need by cosine: need, embedding against office, profile.

    Equal scores go to the smaller office. Vectors without a direction match nothing."""
    found = vector_index.nearest(needs, profiles, k, block)
    return found.select("need", F.posexplode("top").alias("_i", "c")).select(
        "need", F.col("c.office").alias("office"), (-F.col("c.neg")).alias("score"), (F.col("_i") + 1).alias("rank"),
        F.lit("candidate").alias("label"),
    )
