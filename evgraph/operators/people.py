"""Contacts: categories, role history, ranking, potential champions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from evgraph.operators.temporal import asof
from evgraph.schema import ROLE_RULES


def role_category(raw_title: Column, rules=ROLE_RULES) -> Column:
    """The category of the first rule whose pattern occurs in the title."""
    title, category = F.lower(raw_title), None
    for pattern, name in rules:
        category = F.when(title.rlike(pattern), name) if category is None else category.when(title.rlike(pattern), name)
    return category.otherwise(F.lit("uncategorised"))


def categorise(contacts: DataFrame) -> DataFrame:
    """Add ``category``; the raw title stays."""
    return contacts.withColumn("category", role_category(F.col("raw_title")))


def rank_contacts(contacts: DataFrame, k: int = 3) -> DataFrame:
    """The k best contacts per office and category, never one merged list: last seen,
    then most often seen. Observations are aggregated per person before ranking."""
    per_person = contacts.groupBy("office", "category", "person").agg(
        F.max("observed_at").alias("last_seen"), F.count(F.lit(1)).alias("n_seen"), F.max("raw_title").alias("raw_title")
    )
    order = Window.partitionBy("office", "category").orderBy(F.desc("last_seen"), F.desc("n_seen"), "person")
    return per_person.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def role_history(observations: DataFrame, max_gap: int = 365) -> DataFrame:
    """Continuous intervals per person, office and title; a gap longer than ``max_gap``
    days opens a new one. Observations collapse to days first, so a window holds at
    most one row per calendar day however often someone was seen."""
    who = ["person", "office", "raw_title"]
    days = observations.groupBy(*who, "observed_at").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy(*who).orderBy("observed_at")
    gap = F.date_diff("observed_at", F.lag("observed_at").over(order))
    opened = days.withColumn("_new", F.when(gap <= max_gap, 0).otherwise(1))
    numbered = opened.withColumn(
        "interval_no", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0))
    )
    return numbered.groupBy(*who, "interval_no").agg(
        F.min("observed_at").alias("valid_from"), F.max("observed_at").alias("last_seen"), F.sum("n").alias("n_seen")
    )


# What one kind of observed signal adds to a champion score.
CHAMPION_WEIGHTS = {"owns_program": 3, "technical_contact": 2, "industry_engagement": 2, "signs_contracts": 1}


def champions(signals: DataFrame, as_of, stale_days: int = 10) -> DataFrame:
    """Potential champions: a prediction with the reasons for and against.

    Each kind of signal counts once. A title alone, however senior, recommends nobody.
    """
    kinds = asof(signals, "observed_at", as_of).groupBy("person", "office", "signal").agg(
        F.max("observed_at").alias("last_seen"), F.count(F.lit(1)).alias("n")
    )
    table = F.create_map(*[F.lit(x) for pair in CHAMPION_WEIGHTS.items() for x in pair])
    weight = F.coalesce(F.try_element_at(table, F.col("signal")), F.lit(0))
    scored = kinds.groupBy("person", "office").agg(
        F.sum(weight).alias("_support"),
        F.array_sort(F.collect_set("signal")).alias("supporting"),
        F.max(F.when(F.col("signal").isNotNull(), F.col("last_seen"))).alias("last_signal"),
        F.coalesce(F.sum(F.when(F.col("signal").isNull(), F.col("n"))), F.lit(0)).alias("n_title_only"),
        F.coalesce(F.sum(F.when(F.col("signal").isNotNull(), F.col("n"))), F.lit(0)).alias("n_signals"),
    ).where("n_signals > 0")
    stale = F.date_diff(F.lit(as_of).cast("date"), "last_signal") > stale_days
    against = F.array_compact(F.array(
        F.when(stale, "stale_signal"),
        F.when(F.col("n_title_only") > F.col("n_signals"), "mostly_title"),
        F.when(F.size("supporting") == 1, "single_kind"),
    ))
    return scored.withColumn("weakening", against).select(
        "person", "office", (F.col("_support") - F.size("weakening")).alias("score"), "supporting", "weakening",
        "last_signal", F.lit("prediction").alias("label"),
    )
