"""Queries over evidence and assertions: owners, roles, versions, leakage."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from evgraph.catalog.base import query
from evgraph.catalog.sql import fragment
from evgraph.operators import lineage, ownership, temporal
from evgraph.session import written
from evgraph.sources import derived
from evgraph.sources.tables import Tables

AS_OF = "2001-08-01"

fragment("live_office", f"""
  SELECT DISTINCT office FROM org_version
  WHERE valid_from <= DATE '{AS_OF}' AND (valid_to IS NULL OR valid_to > DATE '{AS_OF}')""", "org_version")


def resolution_sql(source: str) -> str:
    return f"""
  SELECT o_orderkey AS opp, CAST(o_orderdate AS DATE) AS published_at, coalesce(n, 0) AS n_offices,
    coalesce(c, 0) AS n_current,
    CASE WHEN coalesce(n, 0) = 0 THEN 'abstain' WHEN c = 0 THEN 'legacy_review' WHEN n = 1 THEN 'single'
      ELSE 'multi_program' END AS resolution,
    CASE WHEN n = 1 AND c = 1 THEN one END AS office
  FROM orders LEFT JOIN (
    SELECT opp, count(DISTINCT office) AS n, min(office) AS one,
      count(DISTINCT CASE WHEN office IN (SELECT office FROM live_office) THEN office END) AS c
    FROM {source} WHERE kind IN ('explicit_owner','office_code','poc_context') AND NOT refutes GROUP BY opp
  ) r ON r.opp = o_orderkey"""


fragment("known_evidence", "SELECT * FROM evidence WHERE available_at <= published_at", "evidence")
fragment("resolved_all", resolution_sql("evidence"), "evidence", "live_office")
fragment("resolved_asof", resolution_sql("known_evidence"), "known_evidence", "live_office")
fragment("dated_evidence", f"SELECT * FROM evidence WHERE available_at <= DATE '{AS_OF}'", "evidence")
fragment("resolved_dated", resolution_sql("dated_evidence"), "dated_evidence", "live_office")


def candidate_sql(source: str) -> str:
    return f"""
  SELECT opp, office, count(*) FILTER (kind IN ('explicit_owner','office_code','poc_context')) AS n_decisive,
    max(confidence) AS best_confidence, count(*) AS n_evidence,
    array_to_string(list_sort(list(DISTINCT kind)), ',') AS kinds,
    row_number() OVER (PARTITION BY opp ORDER BY
      count(*) FILTER (kind IN ('explicit_owner','office_code','poc_context')) DESC, max(confidence) DESC,
      count(*) DESC, office) AS rank
  FROM {source} WHERE NOT refutes GROUP BY opp, office"""


fragment("candidate", candidate_sql("evidence"), "evidence")
fragment("candidate_dated", candidate_sql("dated_evidence"), "dated_evidence")


def resolved(t: Tables, known_only: bool) -> DataFrame:
    evidence = derived.evidence(t)
    if known_only:
        evidence = temporal.asof(derived.dated_evidence(t), "available_at", F.col("published_at"))
    opps = derived.opportunities(t).select("opp", "published_at")
    return ownership.resolve(opps, evidence, derived.org_versions(t), AS_OF)


@query(
    "asof_snapshot", "known_evidence",
    sql="SELECT opp, office, kind, strftime(available_at, '%Y-%m-%d') AS available_at, "
        "strftime(published_at, '%Y-%m-%d') AS published_at FROM known_evidence",
)
def asof_snapshot(t: Tables) -> DataFrame:
    known = temporal.asof(derived.dated_evidence(t), "available_at", F.col("published_at"))
    return known.select("opp", "office", "kind", "available_at", "published_at")


@query(
    "decisive_evidence", "evidence",
    sql="SELECT opp, office, kind, CAST(confidence AS DOUBLE) AS confidence, refutes, doc_id FROM evidence "
        "WHERE kind IN ('explicit_owner','office_code','poc_context')",
)
def decisive_evidence(t: Tables) -> DataFrame:
    return ownership.decisive(derived.evidence(t)).select("opp", "office", "kind", "confidence", "refutes", "doc_id")


@query(
    "org_version_asof", "org_version",
    sql="""SELECT l_orderkey AS opp, l_linenumber AS line, l_suppkey AS office,
      strftime(l_shipdate, '%Y-%m-%d') AS at, v.name AS org_name
      FROM lineitem LEFT JOIN org_version v ON v.office = l_suppkey AND l_shipdate >= v.valid_from
        AND (v.valid_to IS NULL OR l_shipdate < v.valid_to)""",
)
def org_version_asof(t: Tables) -> DataFrame:
    records = t.lineitem.select(
        F.col("l_orderkey").alias("opp"), F.col("l_linenumber").alias("line"), F.col("l_suppkey").alias("office"),
        F.to_date("l_shipdate").alias("at"),
    )
    found = temporal.org_asof(records, derived.org_versions(t), "at")
    return found.select("opp", "line", "office", "at", "org_name")


@query(
    "latest_observation_asof",
    sql="""SELECT e.event_id, e.user_id AS person, strftime(e.ts, '%Y-%m-%d %H:%M:%S') AS at, o.value AS last_value,
      strftime(o.ts, '%Y-%m-%d %H:%M:%S') AS last_at
    FROM events e LEFT JOIN LATERAL (
      SELECT value, ts FROM events v WHERE v.event_type = 'view' AND v.user_id = e.user_id AND v.ts <= e.ts
      ORDER BY ts DESC, event_id DESC LIMIT 1) o ON true
    WHERE e.event_type = 'purchase'""",
)
def latest_observation_asof(t: Tables) -> DataFrame:
    """For each purchase, the same person's latest view at or before it."""
    rows = t.events.select("event_id", F.col("user_id").alias("person"), F.col("ts").alias("at"), "value", "event_type")
    return temporal.last_before(
        rows.where("event_type = 'purchase'"), rows.where("event_type = 'view'"), ["person"], "at", "event_id",
        "value",
    )


@query(
    "owner_guard", "evidence",
    sql="""SELECT opp, office, kind FROM (
        SELECT *, row_number() OVER (PARTITION BY opp ORDER BY confidence DESC, kind, office) AS r FROM evidence) a
      WHERE r = 1 AND NOT EXISTS (SELECT 1 FROM evidence e WHERE e.opp = a.opp AND e.office = a.office
        AND e.kind IN ('explicit_owner','office_code','poc_context') AND NOT e.refutes)""",
)
def owner_guard(t: Tables) -> DataFrame:
    """Naive answers (the most confident evidence of any kind) that the guard rejects."""
    evidence = derived.evidence(t)
    best = F.min(F.struct((-F.col("confidence")).alias("c"), "kind", "office")).alias("b")
    naive = evidence.groupBy("opp").agg(best).select("opp", "b.office", "b.kind")
    return ownership.owner_guard(naive, evidence).select("opp", "office", "kind")


@query(
    "leakage_audit", "evidence",
    sql="SELECT 'unfiltered' AS inputs, kind, count(*) AS n_rows, count(DISTINCT opp) AS n_opps FROM evidence "
        "WHERE available_at > published_at GROUP BY kind",
)
def leakage_audit(t: Tables) -> DataFrame:
    """Late inputs by kind, before and after the as-of filter; after it there are none."""
    evidence = derived.dated_evidence(t)
    known = temporal.asof(evidence, "available_at", F.col("published_at"))
    parts = [
        temporal.leaked(df, "available_at", F.col("published_at")).select(F.lit(name).alias("inputs"), "kind", "opp")
        for name, df in (("unfiltered", evidence), ("as_of", known))
    ]
    return parts[0].unionByName(parts[1]).groupBy("inputs", "kind").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("opp").alias("n_opps")
    )


@query(
    "assertion_rollup", "assertion",
    sql="""SELECT subject, predicate, object, count(*) AS n_evidence, CAST(max(confidence) AS DOUBLE) AS best_confidence,
      CAST(sum(confidence) AS DOUBLE) / count(*) AS mean_confidence,
      strftime(min(valid_from), '%Y-%m-%d') AS first_observed, strftime(max(valid_from), '%Y-%m-%d') AS last_observed,
      CASE WHEN max(confidence) >= 0.95 AND count(*) >= 2 THEN 'accepted' WHEN max(confidence) < 0.92 THEN 'needs_review'
        ELSE 'provisional' END AS review_status
      FROM assertion GROUP BY ALL""",
)
def assertion_rollup(t: Tables) -> DataFrame:
    return ownership.rollup_assertions(derived.assertions(t))


@query(
    "owner_resolution", "resolved_all",
    sql="SELECT opp, strftime(published_at, '%Y-%m-%d') AS published_at, resolution, n_offices, n_current, office "
        "FROM resolved_all",
)
def owner_resolution(t: Tables) -> DataFrame:
    return resolved(t, known_only=False)


@query(
    "resolved_owners", "resolved_all", "evidence", "live_office",
    sql="""SELECT e.opp, e.office, e.office IN (SELECT office FROM live_office) AS is_current, count(*) AS n_claims,
      CAST(max(confidence) AS DOUBLE) AS best_confidence, any_value(r.n_offices) AS n_offices, any_value(r.resolution) AS resolution
      FROM evidence e JOIN resolved_all r ON r.opp = e.opp
      WHERE kind IN ('explicit_owner','office_code','poc_context') AND NOT refutes GROUP BY e.opp, e.office""",
)
def resolved_owners(t: Tables) -> DataFrame:
    return ownership.resolved_owners(derived.evidence(t), derived.org_versions(t), AS_OF)


ROLE_SQL = ", ".join(
    f"count(DISTINCT office) FILTER (role = '{r}') AS {r}_n, CASE WHEN count(DISTINCT office) FILTER (role = '{r}') = 1 "
    f"THEN min(office) FILTER (role = '{r}') END AS {r}_office, "
    f"coalesce(array_to_string(list_sort(list(DISTINCT office) FILTER (role = '{r}')), ','), '') AS {r}_offices"
    for r in ("owner", "program_management", "funding", "technical", "contracting", "award")
)


@query("role_separation", "role_assertion", sql=f"SELECT opp, {ROLE_SQL} FROM role_assertion GROUP BY opp")
def role_separation(t: Tables) -> DataFrame:
    return ownership.roles(derived.role_assertions(t))


@query(
    "role_holders", "role_assertion",
    sql="""SELECT opp, role, office, count(*) AS n_claims, any_value(n) AS n_holders FROM role_assertion a
      JOIN (SELECT opp, role, count(DISTINCT office) AS n FROM role_assertion GROUP BY ALL) h USING (opp, role)
      WHERE role IN ('owner', 'program_management', 'funding', 'technical', 'contracting', 'award') GROUP BY opp, role, office""",
)
def role_holders(t: Tables) -> DataFrame:
    return ownership.role_holders(derived.role_assertions(t))


@query(
    "candidate_owners", "candidate",
    sql="SELECT opp, office, n_decisive, CAST(best_confidence AS DOUBLE) AS best_confidence, n_evidence, kinds, rank "
        "FROM candidate WHERE rank <= 3",
)
def candidate_owners(t: Tables) -> DataFrame:
    return ownership.candidates(derived.evidence(t), 3)


@query(
    "superseding_evidence", "assertion",
    sql="""SELECT id, subject, object, strftime(valid_from, '%Y-%m-%d') AS valid_from,
      NOT EXISTS (SELECT 1 FROM assertion b WHERE b.subject = a.subject AND b.predicate = a.predicate
        AND (b.valid_from, b.confidence, b.object, b.id) > (a.valid_from, a.confidence, a.object, a.id)) AS is_current,
      strftime((SELECT min(b.valid_from) FROM assertion b WHERE b.subject = a.subject AND b.predicate = a.predicate
        AND (b.valid_from, b.confidence, b.object, b.id) > (a.valid_from, a.confidence, a.object, a.id)), '%Y-%m-%d')
        AS superseded_at
      FROM assertion a""",
)
def superseding_evidence(t: Tables) -> DataFrame:
    flagged = ownership.supersede(derived.assertions(t))
    return flagged.select("id", "subject", "object", "valid_from", "is_current", "superseded_at")


@query(
    "candidate_union", "evidence", "platform", "platform_mention",
    sql="""SELECT opp, office, array_to_string(list_sort(list(DISTINCT kind)), ',') AS signals, count(*) AS n_signals,
      CAST(max(confidence) AS DOUBLE) AS best_confidence, false AS decisive
      FROM (SELECT opp, office, kind, confidence FROM evidence WHERE kind NOT IN ('explicit_owner','office_code','poc_context')
        UNION ALL SELECT opp, office, 'incumbent', NULL FROM evidence WHERE refutes
        UNION ALL SELECT opp, office, 'awarding_office', NULL FROM evidence WHERE line_status = 'F'
        UNION ALL SELECT DISTINCT e.opp, p.office, 'platform_name', NULL FROM evidence e JOIN platform_mention m ON m.doc_id = e.doc_id
          JOIN platform p ON array_to_string(regexp_extract_all(lower(p.name), '[a-z0-9]+'), ' ') = m.gram)
      GROUP BY opp, office""",
)
def candidate_union(t: Tables) -> DataFrame:
    evidence = derived.evidence(t)
    cited, holders = ownership.cited_platforms(
        evidence.select("opp", "doc_id"), derived.platform_documents(t), written(derived.platforms(t), "platforms")
    )
    signals = ownership.generate_candidates(evidence, evidence.where("refutes"), evidence.where("line_status = 'F'"))
    return ownership.with_named(signals, cited, holders)


fragment("merged_span", """
  SELECT subject, predicate, object, min(valid_from) AS valid_from, max(valid_to) AS valid_to FROM (
    SELECT *, sum(opened) OVER (PARTITION BY subject, predicate, object ORDER BY valid_from, valid_to, id) AS island FROM (
      SELECT *, CASE WHEN valid_from <= max(valid_to) OVER (PARTITION BY subject, predicate, object
        ORDER BY valid_from, valid_to, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS opened
      FROM assertion))
  GROUP BY subject, predicate, object, island""", "assertion")


@query(
    "contradictions", "merged_span",
    sql="""SELECT a.subject, a.predicate, a.object, strftime(a.valid_from, '%Y-%m-%d') AS valid_from,
      strftime(a.valid_to, '%Y-%m-%d') AS valid_to, count(*) AS n_conflicts
      FROM merged_span a JOIN merged_span b ON a.subject = b.subject AND a.predicate = b.predicate
        AND a.object <> b.object AND a.valid_from < b.valid_to AND b.valid_from < a.valid_to
      GROUP BY ALL""",
)
def contradictions(t: Tables) -> DataFrame:
    return ownership.contradictions(derived.assertions(t))


@query(
    "legacy_review", "evidence", "org_version",
    sql=f"""SELECT DISTINCT e.opp, e.office, v.name AS last_version, strftime(v.valid_to, '%Y-%m-%d') AS closed_on
      FROM evidence e JOIN org_version v ON v.office = e.office AND v.version = 1 AND v.valid_to <= DATE '{AS_OF}'
      WHERE e.kind IN ('explicit_owner','office_code','poc_context') AND NOT e.refutes
        AND NOT EXISTS (SELECT 1 FROM org_version w WHERE w.office = e.office AND w.version = 2)""",
)
def legacy_review(t: Tables) -> DataFrame:
    owners = ownership.owner_offices(derived.evidence(t))
    return temporal.legacy(owners, derived.org_versions(t), AS_OF).select("opp", "office", "last_version", "closed_on")


@query(
    "staleness", "edges",
    sql=f"""SELECT type, CASE WHEN observed_at IS NULL THEN 'undated'
        WHEN DATE '{AS_OF}' - CAST(observed_at AS DATE) <= 180 THEN 'fresh' ELSE 'stale' END AS freshness,
      count(*) AS n_edges, max(DATE '{AS_OF}' - CAST(observed_at AS DATE)) AS oldest_days
      FROM edges GROUP BY ALL""",
)
def staleness(t: Tables) -> DataFrame:
    rated = temporal.staleness(derived.edges(t), F.col("evidence.observed_at"), AS_OF)
    return rated.groupBy("type", "freshness").agg(
        F.count(F.lit(1)).alias("n_edges"), F.max("age_days").alias("oldest_days")
    )


@query(
    "evidence_coverage", "evidence",
    sql="""SELECT kind, count(*) AS n_claims, count(d.doc_id) AS n_covered, count(*) - count(d.doc_id) AS n_uncovered,
      count(d.doc_id) / count(*) AS coverage
      FROM evidence e LEFT JOIN documents d ON e.doc_id = d.doc_id GROUP BY kind""",
)
def evidence_coverage(t: Tables) -> DataFrame:
    return lineage.coverage(derived.evidence(t), t.documents.select("doc_id"))


@query(
    "citation_guard", "evidence",
    sql="SELECT opp, office, kind, doc_id FROM evidence e "
        "WHERE EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = e.doc_id AND d.doc_id % 11 <= 5)",
)
def citation_guard(t: Tables) -> DataFrame:
    return lineage.guard(derived.evidence(t), derived.retrievals(t)).select("opp", "office", "kind", "doc_id")
