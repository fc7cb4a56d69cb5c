"""From past procurements and budgets to likely needs and predicted notices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from evgraph.operators.temporal import asof
from evgraph.schema import NEED_CLASSES

STAGES = ("forecast", "notice", "award", "modification")


def procurement_chain(records: DataFrame) -> DataFrame:
    """One row per identifier with the date of each stage, and which are missing. The
    stages are stacked and grouped once instead of joined three times."""
    stage = F.col("stage")
    dated = records.groupBy("identifier").agg(
        *[F.min(F.when(stage == s, F.col("at"))).alias(f"{s}_at") for s in STAGES]
    )
    reached = [F.when(F.col(f"{s}_at").isNotNull(), s) for s in STAGES]
    absent = [F.when(F.col(f"{s}_at").isNull(), s) for s in STAGES]
    return dated.withColumn("n_stages", F.size(F.array_compact(F.array(*reached)))).withColumn(
        "furthest", F.coalesce(*reversed(reached))
    ).withColumn("missing", F.array_compact(F.array(*absent))).withColumn(
        "notice_to_award_days", F.date_diff("award_at", "notice_at")
    )


def procurement_profile(events: DataFrame) -> DataFrame:
    """Counts and values by office, year and method with subtotals."""
    return events.withColumn("year", F.year("event_at")).rollup("office", "year", "method").agg(
        F.grouping_id().alias("level"), F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("total_value")
    )


def _most_frequent(counted: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    per_value = counted.groupBy(*keys, column).agg(F.sum("_n").alias("_n"))
    first = F.min(F.struct((-F.col("_n")).alias("neg"), F.col(column).alias("v")))
    return per_value.groupBy(*keys).agg(first.alias("_f"), F.sum("_n").alias("n_events")).select(
        *keys, F.col("_f.v").alias(column), (-F.col("_f.neg")).alias(f"n_{column}"), "n_events"
    )


def likely_pathway(events: DataFrame, keys: Sequence[str] = ("office",)) -> DataFrame:
    """The most frequent method and contracting office; ties go to the smaller value.
    Both come from one count per (method, contracting)."""
    counted = events.groupBy(*keys, "method", "contracting").agg(F.count(F.lit(1)).alias("_n"))
    method = _most_frequent(counted, keys, "method")
    contracting = _most_frequent(counted, keys, "contracting").drop("n_events")
    return method.join(contracting, list(keys))


MIN_GAPS = 3


def recurrence(events: DataFrame, min_gaps: int = MIN_GAPS) -> DataFrame:
    """Gap statistics between the days an office bought for a program, and the next
    expected window. Events collapse to days, which bounds the window by the calendar."""
    key = ["office", "program"]
    days = events.select(*key, "event_at").distinct()
    gap = F.date_diff("event_at", F.lag("event_at").over(Window.partitionBy(*key).orderBy("event_at")))
    n, total, squares = F.count("_gap"), F.sum("_gap"), F.sum(F.col("_gap") * F.col("_gap"))
    stats = days.withColumn("_gap", gap).groupBy(*key).agg(
        n.alias("n_gaps"), total.alias("_sum"), squares.alias("_sq"), F.max("event_at").alias("last_at")
    ).where(F.col("n_gaps") >= min_gaps)
    mean = F.col("_sum") / F.col("n_gaps")
    spread = F.sqrt((F.col("_sq") - F.col("_sum") * F.col("_sum") / F.col("n_gaps")) / (F.col("n_gaps") - 1))
    stats = stats.withColumn("mean_days", mean).withColumn("stddev_days", spread)

    def day(offset):
        return F.date_add("last_at", F.floor(offset + 0.5).cast("int"))

    return stats.withColumn("window_start", day(F.col("mean_days") - F.col("stddev_days"))).withColumn(
        "window_end", day(F.col("mean_days") + F.col("stddev_days"))
    ).drop("_sum", "_sq")


BUDGET_KEY = ["office", "appropriation", "element", "project", "unit"]


def budget_long(wide: DataFrame, years: Sequence[int]) -> DataFrame:
    """Exhibit columns to rows, keeping context; amounts in units and in dollars."""
    long = wide.unpivot(BUDGET_KEY, [f"fy{y}" for y in years], "_column", "amount").where("amount is not null")
    scale = F.when(F.col("unit") == "K", 1_000).when(F.col("unit") == "M", 1_000_000).when(F.col("unit") == "B", 1_000_000_000).otherwise(1)
    return long.select(
        *BUDGET_KEY, F.substring("_column", 3, 4).cast("int").alias("fiscal_year"), "amount",
        (F.col("amount") * scale).cast("decimal(38,2)").alias("dollars"),
    )


def budget_change(long: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """Year on year change per line over a full grid of years, so that an absent year
    counts as zero. A line has one row per year, which bounds the window."""
    key = [c for c in BUDGET_KEY if c != "unit"]
    lines = long.groupBy(*key).agg(
        *[F.coalesce(F.sum(F.when(F.col("fiscal_year") == y, F.col("dollars"))), F.lit(0)).alias(f"y{y}")
          for y in range(first_year, last_year + 1)]
    )
    pairs = F.array(*[
        F.struct(F.lit(y).alias("fiscal_year"), F.col(f"y{y - 1}").alias("prior"), F.col(f"y{y}").alias("current"))
        for y in range(first_year + 1, last_year + 1)
    ])
    prior, current = F.col("prior"), F.col("current")
    change = (
        F.when((prior == 0) & (current > 0), "new_start")
        .when((prior > 0) & (current == 0), "termination")
        .when((prior == 0) & (current == 0), "none")
        .when(current * 10 > prior * 11, "growth")
        .when(current * 10 < prior * 9, "cut")
        .otherwise("steady")
    )
    return lines.select(*key, F.inline(pairs)).withColumn("change", change)


def need_signals(events: DataFrame, cutoff) -> DataFrame:
    """What speaks for and against each (office, program) as a future need, from events
    up to the cutoff only. Signals are flags, so a busy office weighs no more."""
    known = asof(events, "event_at", cutoff)
    at = F.lit(cutoff).cast("date")
    age = F.date_diff(at, "event_at")
    recent, before = age < 365, (age >= 365) & (age < 730)
    key = ["office", "program"]
    zero = F.lit(0).cast("decimal(18,2)")
    # days first: the gap between them then needs a window of calendar length only
    daily = known.groupBy(*key, "event_at").agg(
        F.sum("value").alias("value"),
        F.count_if(F.col("status") == "O").alias("open"),
        F.count_if(F.col("flag") == "R").alias("returned"),
        F.count(F.lit(1)).alias("n"),
    )
    earlier = F.lag("event_at").over(Window.partitionBy(*key).orderBy("event_at"))
    joined = daily.withColumn("_gap", earlier.isNotNull()).groupBy(*key).agg(
        F.coalesce(F.sum(F.when(recent, F.col("value"))), zero).alias("_now"),
        F.coalesce(F.sum(F.when(before, F.col("value"))), zero).alias("_then"),
        F.sum("open").alias("_open"),
        F.sum("returned").alias("_returned"),
        F.sum("n").alias("n_events"),
        F.min("event_at").alias("first_at"),
        F.max("event_at").alias("last_at"),
        F.sum("value").alias("total_value"),
        F.count_if("_gap").alias("_gaps"),
    )
    flags = {
        "funded": (F.col("_then") > 0) & (F.col("_now") > F.col("_then")),
        "forecast": F.col("_open") > 0,
        "recurring": F.col("_gaps") >= MIN_GAPS,
        "emerging": F.date_diff(at, "first_at") < 365,
    }
    against = {
        "spending_cut": F.col("_now") < F.col("_then"),
        "returns": F.col("_returned") * 2 > F.col("n_events"),
        "dormant": F.date_diff(at, "last_at") > 730,
    }
    return joined.select(
        "office", "program", "n_events", "total_value", "last_at",
        F.array_compact(F.array(*[F.when(c, n) for n, c in flags.items()])).alias("supporting"),
        F.array_compact(F.array(*[F.when(c, n) for n, c in against.items()])).alias("weakening"),
    )


def rank_needs(signals: DataFrame, k: int = 5) -> DataFrame:
    """The k likeliest needs per office, each with its strongest class and its score:
    class weights of the supporting signals less two per weakening one."""
    names = list(NEED_CLASSES)
    held = [F.array_contains("supporting", n) for n in names[:-1]]
    need_class = F.coalesce(*[F.when(h, n) for h, n in zip(held, names)], F.lit(names[-1]))
    weights = [F.when(h, NEED_CLASSES[n]).otherwise(0) for h, n in zip(held, names)]
    support = weights[0]
    for w in weights[1:]:
        support = support + w
    floor = F.when(F.size("supporting") == 0, NEED_CLASSES[names[-1]]).otherwise(0)
    scored = signals.withColumn("need_class", need_class).withColumn(
        "score", support + floor - 2 * F.size("weakening")
    )
    order = Window.partitionBy("office").orderBy(F.desc("score"), F.desc("total_value"), "program")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def engagement_plan(needs: DataFrame, contacts: DataFrame) -> DataFrame:
    """Next actions: an office's top needs against its top contact per category. Both
    sides are already cut to a few rows per office."""
    top = contacts.where("rank = 1").select(
        F.col("office").alias("_office"), "category", "person", "raw_title", "last_seen"
    )
    verb = F.when(F.col("need_class").isin("funded", "forecast"), "discuss").otherwise("explore")
    return needs.join(top, F.col("office") == F.col("_office")).select(
        "office", F.col("rank").alias("need_rank"), "program", "need_class", "category", "person", "raw_title",
        "last_seen", F.concat_ws(" ", verb, "program", F.lit("with"), "raw_title").alias("action"),
    )


def next_window(stats: DataFrame, cutoff) -> DataFrame:
    """``recurrence`` rows with the first expected window that does not end before the cutoff: whole mean
    gaps after the last event, so nothing is predicted for a time already past. ``n_steps`` counts the gaps."""
    past = F.date_diff(F.lit(cutoff).cast("date"), "last_at") - 0.5 - F.col("stddev_days")
    rolled = stats.withColumn("n_steps", F.greatest(F.lit(1), F.ceil(past / F.col("mean_days"))).cast("int"))
    center = F.col("mean_days") * F.col("n_steps")

    def day(offset):
        return F.date_add("last_at", F.floor(offset + 0.5).cast("int"))

    return rolled.withColumn("window_start", day(center - F.col("stddev_days"))).withColumn("window_end", day(center + F.col("stddev_days")))


def predicted_notices(events: DataFrame, cutoff, n_terms: int = 3, version: str = "v1") -> DataFrame:
    """A versioned, time-bounded prediction per recurring (office, program), made from
    events up to the cutoff: window, pathway, contracting office and scope terms."""
    key = ["office", "program"]
    known = asof(events, "event_at", cutoff)
    terms = (
        known.select(*key, F.explode(F.split("scope", " ")).alias("term"))
        .groupBy(*key, "term")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    order = Window.partitionBy(*key).orderBy(F.desc("_n"), "term")
    scope = (
        terms.withColumn("_r", F.row_number().over(order))
        .where(F.col("_r") <= n_terms)
        .groupBy(*key)
        .agg(F.array_sort(F.collect_list(F.struct("_r", "term"))).alias("_t"))
        .select(*key, F.transform("_t", lambda x: x["term"]).alias("scope_terms"))
    )
    return (
        next_window(recurrence(known), cutoff)
        .join(likely_pathway(known, key), key)
        .join(scope, key)
        .select(
            *key, F.lit(version).alias("version"), F.lit(cutoff).cast("date").alias("cutoff"), "window_start",
            "window_end", "method", "contracting", "scope_terms", "n_gaps",
        )
    )


HORIZON = 365


def _count_so_far(column: str) -> Column:
    """A value met on a day with its count up to that day. A value's count is highest when it last occurs, so the best of
    the counts reached so far, ties to the smaller value, is the mode so far."""
    up_to_day = Window.partitionBy("office", "program", column).orderBy("event_at").rangeBetween(Window.unboundedPreceding, 0)
    return F.struct((-F.sum("_n").over(up_to_day)).alias("neg"), F.col(column).alias("v"))


def rolling_predictions(events: DataFrame, horizon: int = HORIZON, min_gaps: int = MIN_GAPS) -> DataFrame:
    """What would have been predicted on each day an office bought for a program: office, program, cutoff (that
    day), the pathway most frequent so far, the windows of all purchases expected within the horizon, and the purchases
    that followed within it.

    Windows, pathway and statistics are running states of the days up to the cutoff; later days are
    labels alone. Purchases of a day by one path are counted first, then move once more to their office and program,
    where counts, days and windows all stay. Purchases without an office, program or day are left out."""
    key = ["office", "program"]
    events = events.dropna(subset=[*key, "event_at"])
    bought = events.groupBy(*key, "event_at", "contracting", "method").agg(F.count(F.lit(1)).alias("_n")).repartition(*key)
    bought = bought.select(
        *key, "event_at", F.struct("contracting", "method").alias("_first"),
        *[_count_so_far(column).alias(f"_{column}") for column in ("method", "contracting")],
    )
    days = bought.groupBy(*key, "event_at").agg(*[F.min(c).alias(c) for c in ("_first", "_method", "_contracting")])
    in_order = Window.partitionBy(*key).orderBy("event_at")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    number = F.unix_date("event_at")
    later = Window.partitionBy(*key).orderBy("_day").rangeBetween(1, horizon)
    gap = F.date_diff("event_at", F.lag("event_at").over(in_order))
    rows = days.withColumn("_day", number).withColumn("_gap", gap)
    rows = rows.withColumns({
        "n_gaps": F.count("_gap").over(so_far), "_sum": F.sum("_gap").over(so_far), "_sq": F.sum(F.col("_gap") * F.col("_gap")).over(so_far),
        "actual": F.collect_list(F.struct(F.col("event_at").alias("at"), "_first.contracting", "_first.method")).over(later),
        **{f"likely_{c}": F.min(f"_{c}").over(so_far)["v"] for c in ("method", "contracting")},
    }).where(F.col("n_gaps") >= min_gaps)
    mean = F.col("_sum") / F.col("n_gaps")
    spread = F.sqrt((F.col("_sq") - F.col("_sum") * F.col("_sum") / F.col("n_gaps")) / (F.col("n_gaps") - 1))
    rows = rows.withColumn("_mean", mean).withColumn("_spread", spread)
    expected = F.floor(F.lit(float(horizon)) / F.col("_mean")).cast("int")

    def day(offset):
        return F.date_add("event_at", F.floor(offset + 0.5).cast("int"))

    windows = F.transform(F.sequence(F.lit(1), expected), lambda m: F.struct(
        day(F.col("_mean") * m - F.col("_spread")).alias("start"), day(F.col("_mean") * m + F.col("_spread")).alias("end")
    ))
    none = F.array().cast("array<struct<start:date,end:date>>")
    rows = rows.withColumn("expected", F.when(expected >= 1, windows).otherwise(none))
    return rows.select(
        *key, F.col("event_at").alias("cutoff"), "n_gaps", "likely_method", "likely_contracting", "expected", "actual"
    )


def backtest(events: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """Predictions from a rolling origin against what followed: every day an office bought for a program is a cutoff, if
    the whole horizon after it has been observed.

    Expected windows and later purchases are both in order of time, and the n-th of one is assigned to the n-th of
    the other, so each stands for one: ``correct`` inside the window, ``mistimed`` outside it with the
    days it missed by; windows left over are false positives, purchases left over missed."""
    last = events.agg(F.max("event_at")).first()[0]
    judged = rolling_predictions(events.where("event_at is not null"), horizon).where(F.date_add("cutoff", horizon) <= F.lit(last))
    both = judged.select(
        "office", "program", "cutoff", "likely_method", "likely_contracting", F.posexplode(F.arrays_zip("expected", "actual")).alias("_i", "p")
    )
    both = both.select(
        "office", "program", "cutoff", (F.col("_i") + 1).alias("seq"), F.col("p.expected.start").alias("window_start"),
        F.col("p.expected.end").alias("window_end"), F.col("p.actual.at").alias("actual_at"), "likely_method", "likely_contracting",
        F.col("p.actual.contracting").alias("_contracting"), F.col("p.actual.method").alias("_method"),
    )
    predicted, happened = F.col("window_start").isNotNull(), F.col("actual_at").isNotNull()
    inside = F.col("actual_at").between(F.col("window_start"), F.col("window_end"))
    outcome = (
        F.when(~predicted, "missed").when(~happened, "false_positive").when(inside, "correct").otherwise("mistimed")
    )
    error = (
        F.when(F.col("actual_at") < F.col("window_start"), F.date_diff("actual_at", "window_start"))
        .when(F.col("actual_at") > F.col("window_end"), F.date_diff("actual_at", "window_end"))
        .when(inside, 0)
    )
    return both.select(
        "office", "program", "cutoff", "seq", outcome.alias("outcome"), "window_start", "window_end", "actual_at",
        error.alias("timing_error_days"), F.when(predicted, F.col("likely_contracting") == F.col("_contracting")).alias("contracting_correct"),
        F.when(predicted, F.col("likely_method") == F.col("_method")).alias("method_correct"),
    )
