"""Queries over procurements, budgets, contacts and evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from evgraph.catalog.base import query
from evgraph.catalog.ownership import AS_OF
from evgraph.catalog.sql import fragment
from evgraph.operators import evaluation, forecast, ownership, people
from evgraph.session import written
from evgraph.sources import derived
from evgraph.sources.tables import Tables

CUTOFF = "2000-01-01"
SEEN_AS_OF = "2024-01-31"
ROLE_GAP = 2


def procurements(t: Tables) -> DataFrame:
    """For queries that read the events several times: the three-way join runs once."""
    return written(derived.procurements(t), "procurements")


@query(
    "procurement_chain",
    sql="""WITH s AS (SELECT o_orderkey AS identifier,
        CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderdate AS DATE) - 90 END AS f, CAST(o_orderdate AS DATE) AS n,
        CASE WHEN o_orderstatus IN ('F','P') THEN CAST(o_orderdate AS DATE) + 60 END AS a,
        CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + 200 END AS m FROM orders)
      SELECT identifier, strftime(f, '%Y-%m-%d') AS forecast_at, strftime(n, '%Y-%m-%d') AS notice_at,
        strftime(a, '%Y-%m-%d') AS award_at, strftime(m, '%Y-%m-%d') AS modification_at,
        CAST(f IS NOT NULL AS INTEGER) + 1 + CAST(a IS NOT NULL AS INTEGER) + CAST(m IS NOT NULL AS INTEGER) AS n_stages,
        CASE WHEN m IS NOT NULL THEN 'modification' WHEN a IS NOT NULL THEN 'award' ELSE 'notice' END AS furthest,
        concat_ws(',', CASE WHEN f IS NULL THEN 'forecast' END, CASE WHEN a IS NULL THEN 'award' END,
          CASE WHEN m IS NULL THEN 'modification' END) AS missing, a - n AS notice_to_award_days FROM s""",
)
def procurement_chain(t: Tables) -> DataFrame:
    return forecast.procurement_chain(derived.stage_records(t))


@query(
    "procurement_profile", "procurement",
    sql="""SELECT office, year, method, CAST(grouping(office, year, method) AS BIGINT) AS level, count(*) AS n_events,
      CAST(sum(value) AS DOUBLE) AS total_value
      FROM (SELECT *, year(event_at) AS year FROM procurement) GROUP BY ROLLUP (office, year, method)""",
)
def procurement_profile(t: Tables) -> DataFrame:
    return forecast.procurement_profile(derived.procurements(t))


fragment("known_procurement", f"SELECT * FROM procurement WHERE event_at <= DATE '{CUTOFF}'", "procurement")


def pathway_sql(source: str, keys: str) -> str:
    return f"""
  SELECT * FROM (
    SELECT {keys}, method, count(*) AS n_method, sum(count(*)) OVER (PARTITION BY {keys}) AS n_events,
      row_number() OVER (PARTITION BY {keys} ORDER BY count(*) DESC, method) AS rm FROM {source} GROUP BY {keys}, method)
  JOIN (SELECT {keys}, contracting, count(*) AS n_contracting,
      row_number() OVER (PARTITION BY {keys} ORDER BY count(*) DESC, contracting) AS rc
    FROM {source} GROUP BY {keys}, contracting) USING ({keys}) WHERE rm = 1 AND rc = 1"""


def recurrence_sql(source: str) -> str:
    return f"""
  SELECT *, last_at + CAST(floor(mean_days - stddev_days + 0.5) AS INTEGER) AS window_start,
    last_at + CAST(floor(mean_days + stddev_days + 0.5) AS INTEGER) AS window_end
  FROM (SELECT office, program, count(gap) AS n_gaps, max(event_at) AS last_at, sum(gap) / count(gap) AS mean_days,
      sqrt((CAST(sum(gap * gap) AS DOUBLE) - CAST(sum(gap) * sum(gap) AS DOUBLE) / count(gap)) / (count(gap) - 1)) AS stddev_days
    FROM (SELECT *, event_at - lag(event_at) OVER (PARTITION BY office, program ORDER BY event_at) AS gap
      FROM (SELECT DISTINCT office, program, event_at FROM {source}))
    GROUP BY office, program HAVING count(gap) >= 3)"""


fragment("pathway_all", pathway_sql("procurement", "office"), "procurement")
fragment("pathway_known", pathway_sql("known_procurement", "office, program"), "known_procurement")
fragment("recurrence_all", recurrence_sql("procurement"), "procurement")
fragment("recurrence_known", recurrence_sql("known_procurement"), "known_procurement")


@query(
    "likely_pathway", "pathway_all",
    sql="SELECT office, method, n_method, CAST(n_events AS BIGINT) AS n_events, contracting, n_contracting FROM pathway_all",
)
def likely_pathway(t: Tables) -> DataFrame:
    return forecast.likely_pathway(derived.procurements(t))


@query(
    "recurrence", "recurrence_all",
    sql="""SELECT office, program, n_gaps, strftime(last_at, '%Y-%m-%d') AS last_at, mean_days,
      round(stddev_days, 6) AS stddev_days, strftime(window_start, '%Y-%m-%d') AS window_start,
      strftime(window_end, '%Y-%m-%d') AS window_end FROM recurrence_all""",
)
def recurrence(t: Tables) -> DataFrame:
    return forecast.recurrence(derived.procurements(t)).withColumn("stddev_days", F.round("stddev_days", 6))


@query(
    "budget_unpivot", "budget_long",
    sql="""SELECT office, appropriation, element, project, unit, fiscal_year, CAST(amount AS DOUBLE) AS amount,
      CAST(amount * CASE unit WHEN 'K' THEN 1000 ELSE 1000000 END AS DOUBLE) AS dollars FROM budget_long""",
)
def budget_unpivot(t: Tables) -> DataFrame:
    years = derived.fiscal_years(t)
    return forecast.budget_long(derived.budget_wide(t, years), years)


@query(
    "budget_change", "budget_long", "budget_year",
    sql="""SELECT *, CASE WHEN prior = 0 AND current > 0 THEN 'new_start' WHEN prior > 0 AND current = 0 THEN 'termination'
        WHEN prior = 0 AND current = 0 THEN 'none' WHEN current * 10 > prior * 11 THEN 'growth'
        WHEN current * 10 < prior * 9 THEN 'cut' ELSE 'steady' END AS change
      FROM (SELECT office, appropriation, element, project, y AS fiscal_year,
          CAST(coalesce(sum(dollars) FILTER (fiscal_year = y - 1), 0) AS DOUBLE) AS prior,
          CAST(coalesce(sum(dollars) FILTER (fiscal_year = y), 0) AS DOUBLE) AS current
        FROM (SELECT *, amount * CASE unit WHEN 'K' THEN 1000 ELSE 1000000 END AS dollars FROM budget_long),
          budget_year GROUP BY ALL)""",
)
def budget_change(t: Tables) -> DataFrame:
    years = derived.fiscal_years(t)
    return forecast.budget_change(forecast.budget_long(derived.budget_wide(t, years), years), years[0], years[-1])


fragment("need_signal", f"""
  SELECT p.*,
    concat_ws(',', CASE WHEN then_value > 0 AND now_value > then_value THEN 'funded' END,
      CASE WHEN open_n > 0 THEN 'forecast' END, CASE WHEN r.hit = 1 THEN 'recurring' END,
      CASE WHEN DATE '{CUTOFF}' - first_at < 365 THEN 'emerging' END) AS supporting,
    concat_ws(',', CASE WHEN now_value < then_value THEN 'spending_cut' END,
      CASE WHEN returned_n * 2 > n_events THEN 'returns' END,
      CASE WHEN DATE '{CUTOFF}' - last_at > 730 THEN 'dormant' END) AS weakening
  FROM (SELECT office, program,
      coalesce(sum(value) FILTER (DATE '{CUTOFF}' - event_at < 365), 0) AS now_value,
      coalesce(sum(value) FILTER (DATE '{CUTOFF}' - event_at >= 365 AND DATE '{CUTOFF}' - event_at < 730), 0) AS then_value,
      count(*) FILTER (status = 'O') AS open_n, count(*) FILTER (flag = 'R') AS returned_n, count(*) AS n_events,
      min(event_at) AS first_at, max(event_at) AS last_at, sum(value) AS total_value
    FROM known_procurement GROUP BY office, program) p
  LEFT JOIN (SELECT office, program, 1 AS hit FROM recurrence_known) r USING (office, program)""", "known_procurement", "recurrence_known")
fragment("need", """
  SELECT *, row_number() OVER (PARTITION BY office ORDER BY score DESC, total_value DESC, program) AS rank
  FROM (SELECT *, CASE WHEN contains(supporting, 'funded') THEN 'funded' WHEN contains(supporting, 'forecast') THEN 'forecast'
      WHEN contains(supporting, 'recurring') THEN 'recurring' WHEN contains(supporting, 'emerging') THEN 'emerging'
      ELSE 'inferred' END AS need_class,
    CASE WHEN supporting = '' THEN 1 ELSE 0 END + CASE WHEN contains(supporting, 'funded') THEN 5 ELSE 0 END
      + CASE WHEN contains(supporting, 'forecast') THEN 4 ELSE 0 END
      + CASE WHEN contains(supporting, 'recurring') THEN 3 ELSE 0 END
      + CASE WHEN contains(supporting, 'emerging') THEN 2 ELSE 0 END
      - 2 * CASE WHEN weakening = '' THEN 0 ELSE len(string_split(weakening, ',')) END AS score
    FROM need_signal)""", "need_signal")


@query(
    "need_ranking", "need",
    sql="""SELECT office, program, need_class, score, rank, supporting, weakening, n_events,
      CAST(total_value AS DOUBLE) AS total_value, strftime(last_at, '%Y-%m-%d') AS last_at FROM need WHERE rank <= 5""",
)
def need_ranking(t: Tables) -> DataFrame:
    return forecast.rank_needs(forecast.need_signals(derived.procurements(t), CUTOFF), 5)


fragment("contact_rank", """
  SELECT office, category, person, strftime(max(observed_at), '%Y-%m-%d') AS last_seen, count(*) AS n_seen,
    max(raw_title) AS raw_title,
    row_number() OVER (PARTITION BY office, category ORDER BY max(observed_at) DESC, count(*) DESC, person) AS rank
  FROM contact_obs GROUP BY office, category, person""", "contact_obs")


@query(
    "engagement_plan", "need", "contact_rank",
    sql="""SELECT n.office, n.rank AS need_rank, program, need_class, category, person, raw_title, last_seen,
      CASE WHEN need_class IN ('funded','forecast') THEN 'discuss ' ELSE 'explore ' END || program || ' with ' || raw_title
        AS action
      FROM need n JOIN contact_rank c ON c.office = n.office AND c.rank = 1 WHERE n.rank <= 5""",
)
def engagement_plan(t: Tables) -> DataFrame:
    needs = forecast.rank_needs(forecast.need_signals(derived.procurements(t), CUTOFF), 5)
    contacts = people.rank_contacts(people.categorise(derived.contact_observations(t)), 1)
    return forecast.engagement_plan(needs, contacts)


fragment("scope_term", """
  SELECT office, program, string_agg(term, ',' ORDER BY r) AS scope_terms FROM (
    SELECT office, program, term, row_number() OVER (PARTITION BY office, program ORDER BY count(*) DESC, term) AS r
    FROM (SELECT office, program, unnest(string_split(scope, ' ')) AS term FROM known_procurement)
    GROUP BY office, program, term) WHERE r <= 3 GROUP BY office, program""", "known_procurement")
fragment("predicted", f"""
  SELECT office, program, 'v1' AS version, '{CUTOFF}' AS cutoff,
    last_at + CAST(floor(mean_days * n_steps - stddev_days + 0.5) AS INTEGER) AS window_start,
    last_at + CAST(floor(mean_days * n_steps + stddev_days + 0.5) AS INTEGER) AS window_end, method, contracting,
    scope_terms, n_gaps
  FROM (SELECT *, greatest(1, CAST(ceil((DATE '{CUTOFF}' - last_at - 0.5::DOUBLE - stddev_days) / mean_days) AS INTEGER)) AS n_steps
    FROM recurrence_known) JOIN pathway_known USING (office, program) JOIN scope_term USING (office, program)""",
  "recurrence_known", "pathway_known", "scope_term")


@query(
    "predicted_notice", "predicted",
    sql="SELECT * REPLACE (strftime(window_start, '%Y-%m-%d') AS window_start, "
        "strftime(window_end, '%Y-%m-%d') AS window_end) FROM predicted",
)
def predicted_notice(t: Tables) -> DataFrame:
    return forecast.predicted_notices(procurements(t), CUTOFF)


fragment("purchase_day", """
  SELECT *, event_at - lag(event_at) OVER (PARTITION BY office, program ORDER BY event_at) AS gap FROM (
    SELECT office, program, event_at, contracting, method FROM procurement
    QUALIFY row_number() OVER (PARTITION BY office, program, event_at ORDER BY contracting, method) = 1)""", "procurement")
fragment("origin", """
  SELECT *, s / n_gaps AS mean, sqrt((CAST(sq AS DOUBLE) - CAST(s * s AS DOUBLE) / n_gaps) / (n_gaps - 1)) AS spread FROM (
    SELECT office, program, event_at AS cutoff, count(gap) OVER so_far AS n_gaps, sum(gap) OVER so_far AS s,
      sum(gap * gap) OVER so_far AS sq FROM purchase_day
    WINDOW so_far AS (PARTITION BY office, program ORDER BY event_at))
  WHERE n_gaps >= 3 AND cutoff + 365 <= (SELECT max(event_at) FROM procurement)""", "purchase_day", "procurement")


def likely_sql(column: str) -> str:
    return f"""SELECT office, program, cutoff, {column} AS likely_{column} FROM (
        SELECT o.office, o.program, o.cutoff, p.{column}, count(*) AS n
        FROM origin o JOIN procurement p ON p.office = o.office AND p.program = o.program AND p.event_at <= o.cutoff GROUP BY ALL)
      QUALIFY row_number() OVER (PARTITION BY office, program, cutoff ORDER BY n DESC, {column}) = 1"""


@query(
    "backtest", "origin", "purchase_day", "procurement",
    sql=f""", likely AS (SELECT * FROM ({likely_sql('method')}) JOIN ({likely_sql('contracting')}) USING (office, program, cutoff)),
      expected AS (SELECT office, program, cutoff, seq, cutoff + CAST(floor(mean * seq - spread + 0.5) AS INTEGER) AS window_start,
          cutoff + CAST(floor(mean * seq + spread + 0.5) AS INTEGER) AS window_end
        FROM (SELECT *, unnest(range(1, CAST(floor(365.0::DOUBLE / mean) AS BIGINT) + 1)) AS seq FROM origin)),
      actual AS (SELECT o.office, o.program, o.cutoff, d.event_at AS actual_at, d.contracting, d.method,
          row_number() OVER (PARTITION BY o.office, o.program, o.cutoff ORDER BY d.event_at) AS seq
        FROM origin o JOIN purchase_day d ON d.office = o.office AND d.program = o.program AND d.event_at > o.cutoff
          AND d.event_at <= o.cutoff + 365)
      SELECT office, program, strftime(cutoff, '%Y-%m-%d') AS cutoff, seq,
        CASE WHEN window_start IS NULL THEN 'missed' WHEN actual_at IS NULL THEN 'false_positive'
          WHEN actual_at BETWEEN window_start AND window_end THEN 'correct' ELSE 'mistimed' END AS outcome,
        strftime(window_start, '%Y-%m-%d') AS window_start, strftime(window_end, '%Y-%m-%d') AS window_end,
        strftime(actual_at, '%Y-%m-%d') AS actual_at,
        CASE WHEN actual_at < window_start THEN actual_at - window_start WHEN actual_at > window_end THEN actual_at - window_end
          WHEN window_start IS NOT NULL AND actual_at IS NOT NULL THEN 0 END AS timing_error_days,
        CASE WHEN window_start IS NOT NULL THEN likely_contracting = a.contracting END AS contracting_correct,
        CASE WHEN window_start IS NOT NULL THEN likely_method = a.method END AS method_correct
      FROM (expected FULL JOIN actual a USING (office, program, cutoff, seq)) JOIN likely USING (office, program, cutoff)""",
)
def backtest(t: Tables) -> DataFrame:
    return forecast.backtest(procurements(t))


@query(
    "role_category", "contact_obs",
    sql="SELECT person, office, raw_title, category, count(*) AS n_seen FROM contact_obs GROUP BY ALL",
)
def role_category(t: Tables) -> DataFrame:
    rated = people.categorise(derived.contact_observations(t))
    return rated.groupBy("person", "office", "raw_title", "category").agg(F.count(F.lit(1)).alias("n_seen"))


@query(
    "contact_ranking", "contact_rank",
    sql="SELECT office, category, person, last_seen, n_seen, raw_title, rank FROM contact_rank WHERE rank <= 3",
)
def contact_ranking(t: Tables) -> DataFrame:
    return people.rank_contacts(people.categorise(derived.contact_observations(t)), 3)


@query(
    "role_history", "contact_obs",
    sql=f"""SELECT person, office, raw_title, CAST(interval_no AS BIGINT) AS interval_no,
      strftime(min(observed_at), '%Y-%m-%d') AS valid_from, strftime(max(observed_at), '%Y-%m-%d') AS last_seen,
      count(*) AS n_seen
      FROM (SELECT *, sum(opened) OVER (PARTITION BY person, office, raw_title ORDER BY seen_at, obs) AS interval_no
        FROM (SELECT *, CASE WHEN observed_at - lag(observed_at) OVER (PARTITION BY person, office, raw_title
          ORDER BY seen_at, obs) <= {ROLE_GAP} THEN 0 ELSE 1 END AS opened FROM contact_obs))
      GROUP BY person, office, raw_title, interval_no""",
)
def role_history(t: Tables) -> DataFrame:
    return people.role_history(derived.contact_observations(t), ROLE_GAP)


fragment("champion", f"""
  SELECT person, office, support - CASE WHEN weakening = '' THEN 0 ELSE len(string_split(weakening, ',')) END AS score,
    supporting, weakening, strftime(last_signal, '%Y-%m-%d') AS last_signal, 'prediction' AS label
  FROM (SELECT *, concat_ws(',', CASE WHEN DATE '{SEEN_AS_OF}' - last_signal > 10 THEN 'stale_signal' END,
      CASE WHEN title_n > signal_n THEN 'mostly_title' END, CASE WHEN kinds = 1 THEN 'single_kind' END) AS weakening
    FROM (SELECT person, office, array_to_string(list_sort(list(DISTINCT signal) FILTER (signal IS NOT NULL)), ',') AS supporting,
        max(observed_at) FILTER (signal IS NOT NULL) AS last_signal, count(DISTINCT signal) AS kinds,
        count(*) FILTER (signal IS NULL) AS title_n, count(signal) AS signal_n,
        3 * max(CAST(signal = 'owns_program' AS INTEGER)) + 2 * max(CAST(signal = 'technical_contact' AS INTEGER))
          + 2 * max(CAST(signal = 'industry_engagement' AS INTEGER)) + max(CAST(signal = 'signs_contracts' AS INTEGER)) AS support
      FROM contact_obs GROUP BY person, office) WHERE signal_n > 0)""", "contact_obs")


@query("champion_score", "champion", sql="SELECT * FROM champion")
def champion_score(t: Tables) -> DataFrame:
    return people.champions(derived.contact_observations(t), SEEN_AS_OF)


fragment("gold", """
  SELECT a.opp, CASE WHEN n.opp IS NOT NULL AND a.resolution = 'abstain' THEN 'negative_non_target'
      WHEN a.resolution = 'abstain' THEN 'abstain_insufficient_owner' WHEN a.resolution = 'single' THEN 'positive_single_program'
      WHEN a.resolution = 'legacy_review' THEN 'legacy_mapping_review' ELSE 'multi_program_support' END AS gold_class,
    a.office AS gold_office
  FROM resolved_all a LEFT JOIN (SELECT DISTINCT opp FROM evidence
    WHERE kind IN ('explicit_owner','office_code','poc_context')) n ON n.opp = a.opp""", "resolved_all", "evidence")
fragment("gold_case", """
  SELECT g.gold_class, p.resolution, g.gold_class = 'positive_single_program' AS pos,
    g.gold_class = 'multi_program_support' AS multi, p.resolution IN ('single','multi_program') AS named,
    p.resolution = 'single' AND g.gold_class = 'positive_single_program' AND p.office = g.gold_office AS hit
  FROM gold g JOIN resolved_asof p USING (opp)""", "gold", "resolved_asof")
fragment("metric", """
  SELECT metric, numerator, denominator, CASE WHEN denominator IS NULL THEN numerator ELSE numerator / denominator END AS value
  FROM (
    SELECT 'exact_accuracy' AS metric, count(*) FILTER (hit) AS numerator, count(*) FILTER (pos) AS denominator FROM gold_case
    UNION ALL SELECT 'target_precision', count(*) FILTER (hit), count(*) FILTER (resolution = 'single') FROM gold_case
    UNION ALL SELECT 'hard_negative_fpr', count(*) FILTER (named), count(*) FROM gold_case WHERE gold_class = 'negative_non_target'
    UNION ALL SELECT 'correct_abstention', count(*) FILTER (resolution = 'abstain'), count(*) FROM gold_case
      WHERE gold_class = 'abstain_insufficient_owner'
    UNION ALL SELECT 'multi_collapsed', count(*) FILTER (resolution = 'single'), NULL FROM gold_case WHERE multi
    UNION ALL SELECT 'legacy_force_mapped', count(*) FILTER (named), NULL FROM gold_case WHERE gold_class = 'legacy_mapping_review'
    UNION ALL SELECT 'recall', count(*) FILTER (hit OR (multi AND resolution = 'multi_program')), count(*) FILTER (pos OR multi)
      FROM gold_case)""", "gold_case")


def gold_cases(t: Tables) -> DataFrame:
    """Gold classes from all evidence beside the answer at each opportunity's cutoff, in one pass; an opportunity
    whose decisive evidence is all refuted is a hard negative."""
    views = {"known": F.col("available_at") <= F.col("published_at"), "full": F.lit(True)}
    opps = derived.opportunities(t).select("opp", "published_at")
    answers = ownership.resolve_views(opps, derived.evidence(t), derived.org_versions(t), AS_OF, views)
    status = F.col("full.resolution")
    gold_class = (
        F.when((status == "abstain") & F.col("accused"), "negative_non_target")
        .when(status == "abstain", "abstain_insufficient_owner")
        .when(status == "single", "positive_single_program")
        .when(status == "legacy_review", "legacy_mapping_review")
        .otherwise("multi_program_support")
    )
    return answers.select(
        "opp", "known.resolution", "known.office", gold_class.alias("gold_class"), F.col("full.office").alias("gold_office")
    )


@query("gold_metrics", "metric", sql="SELECT metric, numerator, denominator, value FROM metric")
def gold_metrics(t: Tables) -> DataFrame:
    """Answers at each opportunity's cutoff against classes from all evidence. This
    exercises the metrics; it does not measure the resolver's accuracy."""
    return evaluation.case_metrics(gold_cases(t))


fragment("gate", """
  SELECT l.metric, m.value, l.comparison, l.threshold,
    CASE WHEN l.comparison = '>=' THEN m.value >= l.threshold ELSE m.value <= l.threshold END AS passed
  FROM (VALUES ('exact_accuracy', '>=', 1.0::DOUBLE), ('target_precision', '>=', 1.0), ('hard_negative_fpr', '<=', 0.0),
    ('correct_abstention', '>=', 1.0), ('multi_collapsed', '<=', 0.0), ('legacy_force_mapped', '<=', 0.0))
    AS l(metric, comparison, threshold) JOIN metric m USING (metric)""", "metric")


@query(
    "gate_report", "gate",
    sql="SELECT * FROM gate UNION ALL SELECT 'overall', NULL, NULL, NULL, bool_and(passed) FROM gate",
)
def gate_report(t: Tables) -> DataFrame:
    return evaluation.gate_report(evaluation.case_metrics(gold_cases(t)))


@query(
    "gold_class_coverage", "gold",
    sql="""SELECT gold_class, count(opp) AS n_cases, count(DISTINCT gold_office) AS n_offices, min_cases, min_offices,
      count(opp) >= min_cases AND count(DISTINCT gold_office) >= min_offices AS enough
      FROM (VALUES ('positive_single_program', 3, 3), ('negative_non_target', 3, 0), ('abstain_insufficient_owner', 2, 0),
        ('multi_program_support', 2, 0), ('legacy_mapping_review', 2, 0)) AS m(gold_class, min_cases, min_offices)
      LEFT JOIN gold USING (gold_class) GROUP BY gold_class, min_cases, min_offices""",
)
def gold_class_coverage(t: Tables) -> DataFrame:
    return evaluation.gold_class_coverage(gold_cases(t))
