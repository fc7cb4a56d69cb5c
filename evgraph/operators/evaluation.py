"""Gold metrics, gates and coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from evgraph.schema import GATES, GOLD_MINIMA


def gold_metrics(predictions: DataFrame, gold: DataFrame) -> DataFrame:
    """One row per metric with numerator, denominator and value.

    ``predictions``: opp, resolution, office. ``gold``: opp, gold_class, gold_office.
    Every gold case counts; one without a prediction is an abstention.
    """
    p = predictions.select("opp", "resolution", "office")
    return case_metrics(gold.join(p, "opp", "left"))


def case_metrics(cases: DataFrame) -> DataFrame:
    """``gold_metrics`` of cases that hold gold_class, gold_office, resolution and office in one row."""
    cases = cases.withColumn("resolution", F.coalesce("resolution", F.lit("abstain")))
    of = F.col("gold_class")
    named = F.col("resolution").isin("single", "multi_program")
    single = F.col("resolution") == "single"
    positive, multi = of == "positive_single_program", of == "multi_program_support"
    right = positive & single & F.coalesce(F.col("office") == F.col("gold_office"), F.lit(False))
    abstained = F.col("resolution") == "abstain"
    measures = {
        "exact_accuracy": (right, positive),
        "target_precision": (right, single),
        "hard_negative_fpr": ((of == "negative_non_target") & named, of == "negative_non_target"),
        "correct_abstention": ((of == "abstain_insufficient_owner") & abstained, of == "abstain_insufficient_owner"),
        "multi_collapsed": (multi & single, None),
        "legacy_force_mapped": ((of == "legacy_mapping_review") & named, None),
        "recall": (right | (multi & (F.col("resolution") == "multi_program")), positive | multi),
    }
    counts = cases.agg(*[
        c for name, (hit, base) in measures.items()
        for c in (F.count_if(hit).alias(f"{name}_n"), (F.count_if(base) if base is not None else F.lit(None).cast("long")).alias(f"{name}_d"))
    ])
    rows = F.array(*[
        F.struct(F.lit(name).alias("metric"), F.col(f"{name}_n").alias("numerator"), F.col(f"{name}_d").alias("denominator"))
        for name in measures
    ])
    value = F.when(F.col("denominator").isNull(), F.col("numerator").cast("double")).otherwise(
        F.try_divide(F.col("numerator").cast("double"), F.col("denominator"))
    )
    return counts.select(F.inline(rows)).withColumn("value", value)


def gate_report(metrics: DataFrame) -> DataFrame:
    """Each blocking gate with its threshold and whether it passes, and one overall row.
    A metric without cases passes nothing."""
    limits = metrics.sparkSession.createDataFrame(
        [(m, c, float(t)) for m, c, t in GATES], "metric string, comparison string, threshold double"
    )
    value, limit = F.col("value"), F.col("threshold")
    ok = F.when(F.col("comparison") == ">=", value >= limit).otherwise(value <= limit)
    gates = limits.join(metrics.select("metric", "value"), "metric", "left").select(
        "metric", "value", "comparison", "threshold", F.coalesce(ok, F.lit(False)).alias("passed")
    )
    # the gates are a fixed handful, so one small array holds them and the overall row
    row = F.struct(*gates.columns)
    overall = F.struct(
        F.lit("overall").alias("metric"), F.lit(None).cast("double").alias("value"),
        F.lit(None).cast("string").alias("comparison"), F.lit(None).cast("double").alias("threshold"),
        F.bool_and("passed").alias("passed"),
    )
    return gates.agg(F.array_append(F.collect_list(row), overall).alias("_rows")).select(F.inline("_rows"))


def gold_class_coverage(gold: DataFrame) -> DataFrame:
    """Cases and distinct offices per class against the least needed; absent classes stay."""
    minima = gold.sparkSession.createDataFrame(
        [(c, n, o) for c, (n, o) in GOLD_MINIMA.items()], "gold_class string, min_cases int, min_offices int"
    )
    counted = gold.groupBy("gold_class").agg(
        F.count(F.lit(1)).alias("n_cases"), F.countDistinct("gold_office").alias("n_offices")
    )
    n, offices = F.coalesce("n_cases", F.lit(0)), F.coalesce("n_offices", F.lit(0))
    return minima.join(counted, "gold_class", "left").select(
        "gold_class", n.alias("n_cases"), offices.alias("n_offices"), "min_cases", "min_offices",
        ((n >= F.col("min_cases")) & (offices >= F.col("min_offices"))).alias("enough"),
    )
