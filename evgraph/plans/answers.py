"""Assembled answers: an opportunity's owner, and an office's outlook.

Every part is cut to its few best rows per answer before it is joined, so an answer
stays small however much evidence stands behind it. The evidence or events every part
reads are written to the shared folder once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from evgraph.operators import forecast, identity, lineage, ownership, people
from evgraph.operators.temporal import asof
from evgraph.session import written


def unknowns(**slots: Column) -> Column:
    """Names of the slots that hold nothing, in the given order."""
    return F.array_compact(F.array(*[F.when(c.isNull(), name) for name, c in slots.items()]))


def _first_k(df: DataFrame, by: str, order: list, k: int | None, item: Column, name: str) -> DataFrame:
    """Per ``by``, its k first items, all where k is None, as an ordered array."""
    ranked = df.withColumn("_r", F.row_number().over(Window.partitionBy(by).orderBy(*order)))
    ranked = ranked if k is None else ranked.where(F.col("_r") <= k)
    return ranked.groupBy(by).agg(F.array_sort(F.collect_list(F.struct("_r", item.alias("item")))).alias("_items")).select(
        by, F.transform("_items", lambda x: x["item"]).alias(name)
    )


def answer_opportunity(
    opps: DataFrame, evidence: DataFrame, versions: DataFrame, parents: DataFrame, contacts: DataFrame,
    manifest: DataFrame, as_of, n_alternatives: int = 3, n_cited: int | None = None, n_contacts: int = 6,
) -> DataFrame:
    """One row per opportunity: owner or abstention, every owning office, path, contracting
    office apart, contacts, alternatives, confidence, cited documents, counterevidence, unknowns.

    ``owners`` is never cut, and ``cited`` only where a number is asked for. The other lists show the first few;
    ``ownership.candidates`` and ``people.rank_contacts`` give them in full.

    Only evidence available at ``as_of`` counts, and only retrieved documents are cited.
    """
    evidence = written(asof(evidence, "available_at", as_of), "evidence")
    base = ownership.resolve(opps, evidence, versions, as_of)
    paths = identity.ancestry(parents).where(F.col("entity").startswith("office:")).select(
        F.regexp_replace("entity", "^office:", "").cast("long").alias("office"), "path"
    )
    weighed = evidence.groupBy("opp").agg(
        F.max(F.when(F.col("kind").isin(*ownership.DECISIVE_KINDS) & ~F.col("refutes"), F.col("confidence"))).alias("confidence"),
        F.count_if("refutes").alias("n_counterevidence"),
    )
    owners = ownership.owner_offices(evidence).groupBy("opp").agg(F.array_sort(F.collect_list("office")).alias("owners"))
    ranked = ownership.candidates(evidence, n_alternatives)
    alternatives = _first_k(ranked, "opp", ["rank"], n_alternatives, F.col("office"), "candidates")
    support = ownership.decisive(evidence).where(~F.col("refutes")).groupBy("opp", "office", "kind", "doc_id").agg(
        F.max("confidence").alias("confidence")
    )
    cited = _first_k(
        lineage.guard(support, manifest), "opp", [F.desc("confidence"), "doc_id", "kind", "office"], n_cited, F.concat_ws(":", "kind", "doc_id"), "cited"
    )
    reachable = _first_k(
        people.rank_contacts(contacts, 1), "office", ["category"], n_contacts, F.concat_ws(":", "category", "person"), "contacts"
    )
    joined = (
        base.join(weighed, "opp", "left").join(owners, "opp", "left").join(alternatives, "opp", "left").join(cited, "opp", "left")
        .join(paths, "office", "left").join(reachable, "office", "left")
    )
    return joined.select(
        "opp", "resolution", "office", "n_offices", "owners", "path", "contracting", "contacts",
        F.when(F.col("office").isNull(), F.col("candidates")).otherwise(
            F.array_remove("candidates", F.col("office"))
        ).alias("alternatives"),
        "confidence", "cited", F.coalesce("n_counterevidence", F.lit(0)).alias("n_counterevidence"),
        unknowns(
            owner=F.col("office"), path=F.col("path"), contracting=F.col("contracting"), contacts=F.col("contacts"),
            evidence=F.col("cited"),
        ).alias("unknowns"),
    )


def answer_evidence(evidence: DataFrame, manifest: DataFrame, marks: DataFrame, chunks: DataFrame, pages: DataFrame, as_of) -> DataFrame:
    """What an answer rests on, a row per opportunity, office, kind, document and stance: decisive claims that support an
    office, and every claim that refutes one, with the page, chunk and line of the document that names an office.

    Only evidence available at ``as_of`` counts and only retrieved documents are cited. ``marks`` (``documents.facts``
    with lines, of the kind looked for) give each document's first one; documents without one keep null places."""
    known = asof(evidence, "available_at", as_of)
    held = known.where(F.col("refutes") | F.col("kind").isin(*ownership.DECISIVE_KINDS))
    stance = F.when(F.col("refutes"), "refutes").otherwise("supports").alias("stance")
    claims = held.groupBy("opp", "office", "kind", "doc_id", stance).agg(F.max("confidence").alias("confidence"))
    first = F.min_by(F.struct("fact_id", "line_no", "start_char", "line"), "start_char").alias("_first")
    firsts = written(marks.groupBy("doc_id").agg(first).select("doc_id", "_first.*"), "marks")
    traced = lineage.trace(firsts.select(F.col("fact_id").alias("assertion_id"), "fact_id"), firsts, chunks, pages)
    places = firsts.join(traced.select("fact_id", "page_no", "chunk_no"), "fact_id").select(
        "doc_id", "page_no", "chunk_no", "line_no", F.col("line").alias("passage")
    )
    return lineage.guard(claims, manifest).join(places, "doc_id", "left")


def office_details(
    events: DataFrame, budget: DataFrame, observations: DataFrame, cutoff, as_of, years, n_needs: int = 5
) -> DataFrame:
    """What ``answer_office`` counts, as rows: office, part, item, detail, starts, ends. Parts: every prediction with its
    window and pathway, every budget line that grew, began, shrank or ended, every champion with the signals that speak
    for the person, and every action of the engagement plan."""
    events = written(events, "procurements")
    none = F.lit(None).cast("date")

    def rows(df: DataFrame, part: str, item, detail, starts, ends=none) -> DataFrame:
        return df.select(
            "office", F.lit(part).alias("part"), item.cast("string").alias("item"), detail.alias("detail"),
            starts.cast("date").alias("starts"), ends.cast("date").alias("ends"),
        )

    predicted = forecast.predicted_notices(events, cutoff)
    last_year = F.year(F.lit(cutoff).cast("date")) - 1
    change = forecast.budget_change(budget, years[0], years[-1]).where(F.col("fiscal_year") <= last_year)
    change = change.where(~F.col("change").isin("none", "steady"))
    backers = people.champions(observations, as_of)
    ranked = forecast.rank_needs(forecast.need_signals(events, cutoff), n_needs)
    plan = forecast.engagement_plan(ranked, people.rank_contacts(people.categorise(observations), 1))
    return (
        rows(predicted, "prediction", F.col("program"), F.col("method"), F.col("window_start"), F.col("window_end"))
        .unionByName(rows(change, "budget", F.concat_ws("/", "appropriation", "element", "project"), F.col("change"), F.make_date("fiscal_year", F.lit(1), F.lit(1))))
        .unionByName(rows(backers, "champion", F.col("person"), F.array_join("supporting", ","), F.col("last_signal")))
        .unionByName(rows(plan, "action", F.col("program"), F.col("action"), F.col("last_seen")))
    )


def answer_office(
    offices: DataFrame, events: DataFrame, budget: DataFrame, observations: DataFrame, cutoff, as_of, years,
    n_needs: int = 5, n_champions: int = 3,
) -> DataFrame:
    """One row per office: history, budget signals, ranked needs, predictions,
    champions, size of the engagement plan, unknowns."""
    events = written(events, "procurements")
    history = asof(events, "event_at", cutoff).groupBy("office").agg(
        F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("total_value"), F.max("event_at").alias("last_event_at")
    )
    last_year = F.year(F.lit(cutoff).cast("date")) - 1
    change = forecast.budget_change(budget, years[0], years[-1]).where(F.col("fiscal_year") <= last_year)
    signals = change.groupBy("office").agg(
        F.count_if(F.col("change").isin("growth", "new_start")).alias("n_budget_up"),
        F.count_if(F.col("change").isin("cut", "termination")).alias("n_budget_down"),
    )
    ranked = forecast.rank_needs(forecast.need_signals(events, cutoff), n_needs)
    needs = _first_k(ranked, "office", ["rank"], n_needs, F.concat_ws(":", "program", "need_class"), "needs")
    predicted = forecast.predicted_notices(events, cutoff).groupBy("office").agg(
        F.count(F.lit(1)).alias("n_predictions"), F.min("window_start").alias("next_window_start")
    )
    backers = _first_k(
        people.champions(observations, as_of), "office", [F.desc("score"), "person"], n_champions, F.col("person"), "champions"
    )
    contacts = people.rank_contacts(people.categorise(observations), 1)
    plan = forecast.engagement_plan(ranked, contacts).groupBy("office").agg(F.count(F.lit(1)).alias("n_actions"))
    out = offices.select("office")
    for part in (history, signals, needs, predicted, backers, plan):
        out = out.join(part, "office", "left")
    counts = ["n_events", "n_budget_up", "n_budget_down", "n_predictions", "n_actions"]
    return out.select(
        "office", *[F.coalesce(c, F.lit(0)).alias(c) for c in counts], "total_value", "last_event_at", "needs",
        "next_window_start", "champions",
        unknowns(
            history=F.col("last_event_at"), needs=F.col("needs"), prediction=F.col("next_window_start"),
            champions=F.col("champions"),
        ).alias("unknowns"),
    )
