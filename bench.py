"""Time the headline queries; print one JSON line.

Every query runs to a sink that keeps nothing, so the whole result is computed and none
of it reaches the driver. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores,
``BENCH_QUERIES`` (comma separated, or ``all``) the queries.
"""

from __future__ import annotations

import json
import os
import time

from evgraph.catalog import QUERIES
from evgraph.session import build_session

HEADLINE = (
    "rank_edges validate_graph graph_report dangling_edges stable_sort_desc unnest_edges candidate_owners"
    " owner_resolution role_separation owner_guard superseding_evidence contradictions org_version_asof"
    " latest_observation_asof identifier_crosswalk ancestry_path buyer_paths entity_clusters document_revisions"
    " chunking section_path identifier_extraction chunk_reconstruction evidence_lineage passage_search"
    " procurement_profile recurrence need_ranking predicted_notice backtest gold_metrics need_match_text"
    " need_match_vector opportunity_answer office_answer"
).split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = sorted(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = build_session(
        f"local[{cpus}]", "evgraph-bench", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["staleness"](spark, folder).write.format("noop").mode("overwrite").save()  # start the JVM's work
    seconds = {}
    for name in names:
        began = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - began, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
