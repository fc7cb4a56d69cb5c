"""Assembled answers and need matching."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

import evgraph.catalog.documents  # noqa: F401  its SQL fragments are used below
from evgraph.catalog.base import query
from evgraph.catalog.forecast import CUTOFF, SEEN_AS_OF
from evgraph.catalog.ownership import AS_OF
from evgraph.catalog.sql import fragment
from evgraph.operators import documents as docs, forecast, matching, people
from evgraph.plans import answers
from evgraph.sources import derived
from evgraph.sources.tables import Tables

fragment("answer", """
  SELECT r.opp, r.resolution, r.office, r.n_offices, own.owners,
    CASE WHEN r.office IS NOT NULL THEN 'office:' || r.office || ',subagency:' || s.s_nationkey || ',agency:' || n.n_regionkey
      END AS path, o.o_custkey AS contracting, c.contacts, k.alternatives, CAST(w.confidence AS DOUBLE) AS confidence,
    d.cited, coalesce(w.n_counter, 0) AS n_counterevidence
  FROM resolved_dated r JOIN orders o ON o.o_orderkey = r.opp
  LEFT JOIN (SELECT opp, string_agg(office, ',' ORDER BY office) AS owners FROM (SELECT DISTINCT opp, office
      FROM dated_evidence WHERE kind IN ('explicit_owner','office_code','poc_context') AND NOT refutes) GROUP BY opp) own
    ON own.opp = r.opp
  LEFT JOIN supplier s ON s.s_suppkey = r.office LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey
  LEFT JOIN (SELECT opp, max(confidence) FILTER (kind IN ('explicit_owner','office_code','poc_context') AND NOT refutes)
      AS confidence, count(*) FILTER (refutes) AS n_counter FROM dated_evidence GROUP BY opp) w ON w.opp = r.opp
  LEFT JOIN (SELECT c.opp, coalesce(string_agg(c.office, ',' ORDER BY rank) FILTER (r2.office IS NULL OR c.office <> r2.office),
      '') AS alternatives FROM candidate_dated c JOIN resolved_dated r2 ON r2.opp = c.opp WHERE rank <= 3 GROUP BY c.opp) k ON k.opp = r.opp
  LEFT JOIN (SELECT opp, string_agg(kind || ':' || doc_id, ',' ORDER BY q) AS cited FROM (
      SELECT opp, kind, doc_id, row_number() OVER (PARTITION BY opp ORDER BY max(confidence) DESC, doc_id, kind, office) AS q
      FROM dated_evidence WHERE kind IN ('explicit_owner','office_code','poc_context') AND NOT refutes
        AND doc_id IN (SELECT doc_id FROM documents WHERE doc_id % 11 <= 5)
      GROUP BY opp, office, kind, doc_id) GROUP BY opp) d ON d.opp = r.opp
  LEFT JOIN (SELECT office, string_agg(category || ':' || person, ',' ORDER BY category) AS contacts FROM contact_rank
      WHERE rank = 1 GROUP BY office) c ON c.office = r.office""",
  "resolved_dated", "dated_evidence", "candidate_dated", "contact_rank")
UNKNOWNS = """concat_ws(',', CASE WHEN office IS NULL THEN 'owner' END, CASE WHEN path IS NULL THEN 'path' END,
  CASE WHEN contracting IS NULL THEN 'contracting' END, CASE WHEN contacts IS NULL THEN 'contacts' END,
  CASE WHEN cited IS NULL THEN 'evidence' END)"""


def answered(t: Tables) -> DataFrame:
    hierarchy = derived.org_parents(t).where(~F.col("child").startswith("award:"))
    contacts = people.categorise(derived.contact_observations(t))
    return answers.answer_opportunity(
        derived.opportunities(t), derived.evidence(t), derived.org_versions(t), hierarchy, contacts,
        derived.retrievals(t), AS_OF,
    )


@query("explicit_unknowns", "answer", sql=f"SELECT opp, resolution, {UNKNOWNS} AS unknowns FROM answer")
def explicit_unknowns(t: Tables) -> DataFrame:
    return answered(t).select("opp", "resolution", "unknowns")


@query("opportunity_answer", "answer", sql=f"SELECT *, {UNKNOWNS} AS unknowns FROM answer")
def opportunity_answer(t: Tables) -> DataFrame:
    return answered(t)


@query(
    "answer_evidence", "dated_evidence", "fact", "chunk_span", "page", "lines", "retrieval",
    sql=""", mark AS (SELECT doc_id, min(start_char) AS start_char, arg_min(line_no, start_char) AS line_no FROM fact
        WHERE kind = 'office_code' GROUP BY doc_id),
      place AS (SELECT m.doc_id, p.page_no, c.chunk_no, m.line_no, l.line AS passage FROM mark m
        JOIN lines l ON l.doc_id = m.doc_id AND l.line_no = m.line_no
        JOIN chunk_span c ON c.doc_id = m.doc_id AND m.start_char >= c.start_char AND m.start_char < c.end_char
        JOIN page p ON p.doc_id = m.doc_id AND m.start_char >= p.start_char AND m.start_char < p.end_char)
      SELECT opp, office, kind, e.doc_id, CASE WHEN refutes THEN 'refutes' ELSE 'supports' END AS stance,
        CAST(max(confidence) AS DOUBLE) AS confidence, any_value(page_no) AS page_no, any_value(chunk_no) AS chunk_no,
        any_value(line_no) AS line_no, any_value(passage) AS passage
      FROM dated_evidence e LEFT JOIN place USING (doc_id)
      WHERE (refutes OR kind IN ('explicit_owner','office_code','poc_context'))
        AND e.doc_id IN (SELECT doc_id FROM retrieval WHERE status = 'retrieved')
      GROUP BY opp, office, kind, e.doc_id, refutes""",
)
def answer_evidence(t: Tables) -> DataFrame:
    marked = derived.marked_documents(t)
    marks = docs.facts(marked, with_line=True, kinds=["office_code"])
    return answers.answer_evidence(
        derived.evidence(t), derived.retrievals(t), marks, docs.chunk(marked), docs.pages(marked), AS_OF
    )


@query(
    "office_details", "predicted", "champion", "budget_long", "budget_year", "need", "contact_rank",
    sql="""SELECT office, 'prediction' AS part, CAST(program AS VARCHAR) AS item, method AS detail,
        strftime(window_start, '%Y-%m-%d') AS starts, strftime(window_end, '%Y-%m-%d') AS ends FROM predicted
      UNION ALL SELECT office, 'champion', CAST(person AS VARCHAR), supporting, last_signal, NULL FROM champion
      UNION ALL SELECT n.office, 'action', CAST(program AS VARCHAR), CASE WHEN need_class IN ('funded','forecast')
          THEN 'discuss ' ELSE 'explore ' END || program || ' with ' || raw_title, last_seen, NULL
        FROM need n JOIN contact_rank c ON c.office = n.office AND c.rank = 1 WHERE n.rank <= 5
      UNION ALL SELECT office, 'budget', item, CASE WHEN pr = 0 THEN 'new_start' WHEN cu = 0 THEN 'termination'
          WHEN cu > pr THEN 'growth' ELSE 'cut' END, y || '-01-01', NULL
        FROM (SELECT office, concat_ws('/', appropriation, element, project) AS item, y,
            coalesce(sum(amount) FILTER (fiscal_year = y - 1), 0) AS pr, coalesce(sum(amount) FILTER (fiscal_year = y), 0) AS cu
          FROM budget_long, budget_year WHERE y <= 1999 GROUP BY ALL)
        WHERE (pr = 0 AND cu > 0) OR (pr > 0 AND (cu * 10 > pr * 11 OR cu * 10 < pr * 9))""",
)
def office_details(t: Tables) -> DataFrame:
    years = derived.fiscal_years(t)
    return answers.office_details(
        derived.procurements(t), forecast.budget_long(derived.budget_wide(t, years), years), derived.contact_observations(t),
        CUTOFF, SEEN_AS_OF, years,
    )


@query(
    "office_answer", "known_procurement", "budget_long", "budget_year", "need", "predicted", "champion", "contact_rank",
    sql=f"""SELECT s_suppkey AS office, coalesce(h.n_events, 0) AS n_events, CAST(h.total_value AS DOUBLE) AS total_value,
      strftime(h.last_at, '%Y-%m-%d') AS last_event_at, coalesce(b.up, 0) AS n_budget_up, coalesce(b.down, 0) AS n_budget_down,
      n.needs, coalesce(p.n, 0) AS n_predictions, strftime(p.w, '%Y-%m-%d') AS next_window_start, c.champions,
      coalesce(a.n, 0) AS n_actions,
      concat_ws(',', CASE WHEN h.last_at IS NULL THEN 'history' END, CASE WHEN n.needs IS NULL THEN 'needs' END,
        CASE WHEN p.w IS NULL THEN 'prediction' END, CASE WHEN c.champions IS NULL THEN 'champions' END) AS unknowns
      FROM supplier
      LEFT JOIN (SELECT office, count(*) AS n_events, sum(value) AS total_value, max(event_at) AS last_at
        FROM known_procurement GROUP BY office) h ON h.office = s_suppkey
      LEFT JOIN (SELECT office, count(*) FILTER ((pr = 0 AND cu > 0) OR (pr > 0 AND cu > 0 AND cu * 10 > pr * 11)) AS up,
          count(*) FILTER ((pr > 0 AND cu = 0) OR (pr > 0 AND cu > 0 AND cu * 10 < pr * 9)) AS down
        FROM (SELECT office, element, y, coalesce(sum(amount) FILTER (fiscal_year = y - 1), 0) AS pr,
            coalesce(sum(amount) FILTER (fiscal_year = y), 0) AS cu
          FROM budget_long, budget_year WHERE y <= 1999 GROUP BY ALL) GROUP BY office) b ON b.office = s_suppkey
      LEFT JOIN (SELECT office, string_agg(program || ':' || need_class, ',' ORDER BY rank) AS needs FROM need
        WHERE rank <= 5 GROUP BY office) n ON n.office = s_suppkey
      LEFT JOIN (SELECT office, count(*) AS n, min(window_start) AS w FROM predicted GROUP BY office) p ON p.office = s_suppkey
      LEFT JOIN (SELECT office, string_agg(person, ',' ORDER BY q) AS champions FROM (
          SELECT office, person, row_number() OVER (PARTITION BY office ORDER BY score DESC, person) AS q FROM champion)
        WHERE q <= 3 GROUP BY office) c ON c.office = s_suppkey
      LEFT JOIN (SELECT n.office, count(*) AS n FROM need n JOIN contact_rank k ON k.office = n.office AND k.rank = 1
        WHERE n.rank <= 5 GROUP BY n.office) a ON a.office = s_suppkey""",
)
def office_answer(t: Tables) -> DataFrame:
    years = derived.fiscal_years(t)
    return answers.answer_office(
        t.supplier.select(F.col("s_suppkey").alias("office")), derived.procurements(t),
        forecast.budget_long(derived.budget_wide(t, years), years), derived.contact_observations(t), CUTOFF, SEEN_AS_OF, years,
    )


@query(
    "need_match_text", "chunk_text",
    sql=""", passage AS (SELECT d.source AS office, {'doc_id': c.doc_id, 'chunk_no': c.chunk_no} AS passage_id, c.text
        FROM chunk_text c JOIN documents d USING (doc_id)),
      tf AS (SELECT office, passage_id, term, count(*) AS tf FROM (SELECT office, passage_id,
        unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS term FROM passage) GROUP BY ALL),
      idf AS (SELECT term, ln((SELECT count(*) FROM passage) / count(*)) AS idf FROM tf GROUP BY term
        HAVING ln((SELECT count(*) FROM passage) / count(*)) > 0),
      w AS (SELECT office, passage_id, term, tf * idf AS w FROM tf JOIN idf USING (term)),
      plen AS (SELECT passage_id, sqrt(sum(w * w)) AS plen FROM w GROUP BY passage_id),
      q AS (SELECT item_id AS need, term, count(*) * any_value(idf) AS qw FROM (SELECT item_id,
        unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS term FROM benchmark) JOIN idf USING (term) GROUP BY ALL),
      qlen AS (SELECT need, sqrt(sum(qw * qw)) AS qlen FROM q GROUP BY need),
      scored AS (SELECT need, office, passage_id, round(sum(w * qw) / (any_value(plen) * any_value(qlen)), 6) AS score
        FROM w JOIN q USING (term) JOIN plen USING (passage_id) JOIN qlen USING (need) GROUP BY need, office, passage_id),
      best AS (SELECT need, office, score, passage_id FROM scored
        QUALIFY row_number() OVER (PARTITION BY need, office ORDER BY score DESC, passage_id) = 1),
      top AS (SELECT *, row_number() OVER (PARTITION BY need ORDER BY score DESC, office) AS rank FROM best)
      SELECT need, t.office, score, rank, passage_id.doc_id AS doc_id, passage_id.chunk_no AS chunk_no, p.text AS passage,
        'candidate' AS label
      FROM top t JOIN passage p USING (passage_id) WHERE rank <= 3""",
)
def need_match_text(t: Tables) -> DataFrame:
    """Each benchmark text as a need against every chunk; a source stands for an office."""
    chunks = docs.chunk(derived.marked_documents(t, "source"), also=("source",))
    passages = chunks.select(F.col("source").alias("office"), F.struct("doc_id", "chunk_no").alias("passage_id"), "text")
    found = matching.match_need(t.benchmark.select(F.col("item_id").alias("need"), "text"), passages, 3)
    return found.select("need", "office", "score", "rank", "passage_id.doc_id", "passage_id.chunk_no", "passage", "label")


@query(
    "need_match_vector",
    sql="""WITH part AS (SELECT vec_id, label, unnest(range(64)) AS i, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
      profile AS (SELECT label AS office, i, avg(x) AS y FROM part GROUP BY ALL),
      scored AS (SELECT vec_id AS need, office, round(sum(x * y) / (sqrt(sum(x * x)) * sqrt(sum(y * y))), 6) AS score
        FROM part JOIN profile USING (i) GROUP BY vec_id, office)
      SELECT * FROM (SELECT need, office, score, row_number() OVER (PARTITION BY need ORDER BY score DESC, office) AS rank,
        'candidate' AS label FROM scored) WHERE rank <= 3""",
)
def need_match_vector(t: Tables) -> DataFrame:
    """Each embedding as a need against the mean vector of every label."""
    profiles = matching.office_profiles(t.embeddings.select(F.col("label").alias("office"), "embedding"), 64)
    return matching.match_vectors(t.embeddings.select(F.col("vec_id").alias("need"), "embedding"), profiles, 3)
