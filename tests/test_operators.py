"""Operators on small inputs: hot keys, brute force, invariants, hand-made cases."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import Window, functions as F

from evgraph.catalog.ownership import AS_OF
from evgraph.operators import (
    documents as docs, evaluation, forecast, identity, lineage, matching, ordered, ownership, people, temporal,
    validation, vector_index,
)
from evgraph.sources import derived


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


@pytest.fixture(scope="module")
def hot(spark):
    """One key holds a third of the rows, with nulls in the value."""
    rng = random.Random(7)
    data = [("hot" if i % 3 == 0 else f"k{i % 50}", i, rng.choice([None, "a", "b", "c"]), rng.randint(0, 9)) for i in range(3000)]
    rng.shuffle(data)
    return spark.createDataFrame(data, "key string, at long, label string, n long")


def same(one, other):
    return one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()


def test_previous_equals_plain_window(hot):
    w = Window.partitionBy("key").orderBy("at")
    got = ordered.with_previous(hot, ["key"], ["at"], "label", F.floor(F.col("at") / 37), "prev")
    assert same(got.select("key", "at", "prev"), hot.select("key", "at", F.lag("label").over(w).alias("prev")))


def test_running_sum_equals_plain_window(hot):
    w = Window.partitionBy("key").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    got = ordered.with_running_sum(hot, ["key"], ["at"], "n", F.floor(F.col("at") / 37), "run")
    assert same(got.select("key", "at", "run"), hot.select("key", "at", F.sum("n").over(w).alias("run")))


def test_last_known_equals_plain_window(hot):
    w = Window.partitionBy("key").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    got = ordered.with_last_known(hot, ["key"], ["at"], "label", F.floor(F.col("at") / 37), "last")
    assert same(got.select("key", "at", "last"), hot.select("key", "at", F.last("label", True).over(w).alias("last")))


def test_a_hot_key_of_one_moment_is_cut_evenly(spark):
    """All rows of the hot key lie in one second, so only the second order column tells them apart; a null key
    is hot too, and the others are not cut."""
    data = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 50)).alias("key"),
        F.lit(dt.datetime(2024, 1, 1)).alias("at"), F.pmod(F.xxhash64("id"), F.lit(10**9)).alias("id"),
    )
    cut = ordered.with_buckets(data, ["key"], ["at", "id"], "part", 1000).cache()
    assert cut.columns == ["key", "at", "id", "part"] and cut.count() == 30_000
    sizes = {(r.key, r.part): r["count"] for r in cut.groupBy("key", "part").count().collect()}
    for key in ("hot", None):
        mine = [n for (k, _), n in sizes.items() if k == key]
        assert len(mine) == 10 and max(mine) < 2500
    assert all(part == 0 for key, part in sizes if key not in ("hot", None))
    # bucket numbers never fall along the order
    w = Window.partitionBy("key").orderBy("at", "id")
    assert cut.withColumn("before", F.lag("part").over(w)).where("before > part").isEmpty()
    one = spark.createDataFrame([("a", 1)] * 50, "key string, at long")  # rows that no order tells apart
    assert {r.part for r in ordered.with_buckets(one, ["key"], ["at"], "part", 10).collect()} <= {0, 1}
    assert ordered.with_buckets(one.limit(0), ["key"], ["at"], "part", 10).isEmpty()


def test_cut_histories_answer_like_whole_ones(spark):
    rng = random.Random(5)
    day = dt.datetime(2024, 1, 1)
    seen = [("u" if i % 3 else f"v{i % 7}", i, day + dt.timedelta(seconds=rng.randint(0, 40)), rng.choice("ab")) for i in range(900)]
    df = spark.createDataFrame(seen, "url string, doc_id long, retrieved_at timestamp_ntz, text string")
    assert same(docs.revisions(df, 20), docs.revisions(df))
    schema = "event_id long, person string, at timestamp_ntz, value double"
    obs = spark.createDataFrame([(i, u, at, float(i)) for u, i, at, _ in seen if i % 2], schema)
    ev = spark.createDataFrame([(i, u, at, 0.0) for u, i, at, _ in seen if not i % 2], schema)
    got = {r.event_id: r.last_value for r in temporal.last_before(ev, obs, ["person"], "at", "event_id", "value", 20).collect()}
    for u, i, at, _ in seen:
        if not i % 2:
            known = [(a, j) for v, j, a, _ in seen if v == u and j % 2 and a <= at]
            assert got[i] == (float(max(known)[1]) if known else None)


def test_ancestry_with_cycle_and_depth(spark):
    links = [("a", "b"), ("b", "c"), ("leaf", "a"), ("x", "y"), ("y", "x"), ("under", "x"), ("two", "a"), ("two", "c")]
    found = identity.ancestry(spark.createDataFrame(links, "child string, parent string"))
    got = {(r.entity, ">".join(r.path) if r.path else None) for r in found.collect()}
    assert got == {
        ("c", "c"), ("b", "b>c"), ("a", "a>b>c"), ("leaf", "leaf>a>b>c"), ("two", "two>a>b>c"), ("two", "two>c"),
        ("x", None), ("y", None), ("under", None),
    }
    chain = [(f"n{i:02d}", f"n{i + 1:02d}") for i in range(12)]
    deep = identity.ancestry(spark.createDataFrame(chain, "child string, parent string")).collect()
    assert {r.entity: r.path for r in deep} == {f"n{i:02d}": [f"n{j:02d}" for j in range(i, 13)] for i in range(13)}


def every_path(weight, kinds, starts, buyers, max_hops):
    """All simple paths by depth-first search, best first: score, hops, path."""
    found = {s: [] for s, kind in kinds.items() if kind in starts}

    def walk(path, score):
        for (src, dst), c in weight.items():
            if src != path[-1] or dst in path or not c:
                continue
            if kinds[dst] in buyers:
                found[path[0]].append((-score * c * 100 ** (max_hops - len(path)), len(path), ">".join([*path, dst])))
            elif len(path) < max_hops:
                walk([*path, dst], score * c)

    for start in found:
        walk([start], 1)
    return {s: sorted(paths) for s, paths in found.items()}


@pytest.mark.parametrize("seed,max_hops,k", [(3, 3, 4), (4, 4, 2), (5, 5, 3), (6, 1, 3)])
def test_buyer_paths_equal_a_search_of_all_simple_paths(spark, seed, max_hops, k):
    """Any order of layers, skipped ones, cycles, a hub, equal scores, edges without support."""
    rng = random.Random(seed)
    kinds = {**{f"s{i}": "solicitation" for i in range(5)}, **{f"o{i}": "office" for i in range(4)}, **{f"p{i}": "program" for i in range(6)}, "b0": "buyer", "b1": "buyer", "b2": "buyer"}
    edges = []
    for src in kinds:
        for dst in kinds:
            chance = 0.9 if "o0" in (src, dst) else 0.35
            if src != dst and kinds[src] != "buyer" and kinds[dst] != "solicitation" and rng.random() < chance:
                edges.append((kinds[src], src, kinds[dst], dst, f"0.{rng.choice([0, 50, 80, 90, 90, 99]):02d}"))
    edges += [(*e[:4], "0.01") for e in edges[:5]]  # a weaker copy changes nothing
    df = spark.createDataFrame(edges, "src_type string, src string, dst_type string, dst string, c string")
    df = df.withColumn("confidence", F.col("c").cast("decimal(4,2)"))
    got = rows(identity.buyer_paths(df, ["solicitation"], ["buyer"], k, max_hops), "start", "rank", "n_hops", "path")
    weight = {}
    for _, src, _, dst, c in edges:
        weight[src, dst] = max(weight.get((src, dst), 0), int(c[2:]))
    expected = []
    for start, paths in every_path(weight, kinds, {"solicitation"}, {"buyer"}, max_hops).items():
        expected += [(start, i + 1, hops, path) for i, (_, hops, path) in enumerate(paths[:k])]
    assert got == sorted(expected)


def test_a_long_chain_takes_few_rounds(spark):
    from evgraph.operators.components import components

    order = list(range(65))
    random.Random(1).shuffle(order)
    pairs = [(f"n{a:02d}", f"n{b:02d}") for a, b in zip(order, order[1:])] + [("x", "y"), ("y", "z"), ("z", "x"), ("w", "w"), ("x", "y")]
    found, n = components(spark.createDataFrame(pairs, "a string, b string"))
    labels = {r.id: r.label for r in found.collect()}
    assert {labels[f"n{i:02d}"] for i in range(65)} == {"n00"} and {labels[c] for c in "xyz"} == {"x"} and labels["w"] == "w"
    in_order, m = components(spark.createDataFrame([(i, i + 1) for i in range(64)], "a long, b long"))
    assert in_order.where("label = 0").count() == 65
    assert n <= 8 and m <= 8
    none, _ = components(spark.createDataFrame([], "a long, b long"))
    assert none.count() == 0


def edit_distance(a, b):
    previous = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        current = [i]
        for j, y in enumerate(b, 1):
            current.append(min(previous[j] + 1, current[-1] + 1, previous[j - 1] + (x != y)))
        previous = current
    return previous[-1]


def test_name_pairs_equal_all_pairs(spark):
    rng = random.Random(5)
    names = list({"".join(rng.choice("ab1") for _ in range(rng.randint(0, 5))) for _ in range(120)})
    records = spark.createDataFrame([(str(i), "s", n, i % 2) for i, n in enumerate(names)], "record string, source string, name string, block int")
    got = rows(identity.matching_names(records), "block", "name_a", "name_b", "distance")
    expected = sorted(
        (block, a, b, edit_distance(a, b))
        for block in (0, 1)
        for a, b in itertools.combinations(sorted(n for i, n in enumerate(names) if i % 2 == block), 2)
        if edit_distance(a, b) <= 1
    )
    assert got == expected


def test_clusters_follow_chains_and_copies(spark):
    data = [("1", "abcd"), ("2", "abcde"), ("3", "abcdef"), ("4", "ABCDEF"), ("5", "abc-def"), ("6", "zzz"), ("7", "abcd9")]
    records = spark.createDataFrame([(r, "s", n, 0) for r, n in data], "record string, source string, name string, block int")
    found = identity.resolve_entities(records).collect()
    got = {r.record: r.cluster for r in found}
    assert got == {"1": "abcd", "2": "abcd", "3": "abcd", "4": "abcd", "5": "abcd", "6": "zzz", "7": "abcd9"}
    # the cluster of 7 is a digit away from the others, so all wait for one decision; 6 waits for none
    assert {r.record: r.review_group for r in found} == {**{str(i): "abcd" for i in (1, 2, 3, 4, 5, 7)}, "6": None}


def test_names_that_match_wait_for_no_decision(spark):
    data = [("1", "alpha 1"), ("2", "Alpha-1"), ("3", "alpha 1x"), ("4", "beta 2"), ("5", "beta 3"), ("6", "beta 33"), ("7", None)]
    records = spark.createDataFrame([(r, "s", n, 0) for r, n in data], "record string, source string, name string, block int")
    got = {r.record: (r.cluster, r.review_group) for r in identity.resolve_entities(records.where("name is not null")).collect()}
    assert got == {
        "1": ("alpha1", None), "2": ("alpha1", None), "3": ("alpha1", None),
        "4": ("beta2", "beta2"), "5": ("beta3", "beta2"), "6": ("beta33", "beta2"),
    }


def assertions(spark, items):
    data = [(str(i), s, "p", o, dt.date(2020, 1, 1) + dt.timedelta(a), dt.date(2020, 1, 1) + dt.timedelta(b), c) for i, (s, o, a, b, c) in enumerate(items)]
    df = spark.createDataFrame(data, "id string, subject string, predicate string, object string, valid_from date, valid_to date, c double")
    return df.withColumn("confidence", F.col("c").cast("decimal(4,2)"))


def test_contradictions_equal_all_pairs(spark):
    rng = random.Random(11)
    items = []
    for _ in range(150):
        a = rng.randint(0, 60)
        items.append((rng.choice(["hot", "hot", "cold"]), rng.choice("xyz"), a, a + rng.randint(1, 12), 0.9))
    df = assertions(spark, items)
    spans = [tuple(r) for r in ownership.merged_validity(df).select("subject", "object", "valid_from", "valid_to").collect()]
    expected = sorted(
        (*one, n) for one in spans
        if (n := sum(o[0] == one[0] and o[1] != one[1] and one[2] < o[3] and o[2] < one[3] for o in spans))
    )
    assert rows(ownership.contradictions(df), "subject", "object", "valid_from", "valid_to", "n_conflicts") == expected
    assert expected


def test_superseded_same_day_and_later(spark):
    df = ownership.supersede(assertions(spark, [("s", "x", 0, 9, 0.5), ("s", "y", 0, 9, 0.9), ("s", "x", 5, 9, 0.1), ("t", "x", 1, 9, 0.1)]))
    day = dt.date(2020, 1, 1)
    assert rows(df, "id", "is_current", "superseded_at") == [
        ("0", False, day), ("1", False, day + dt.timedelta(5)), ("2", True, None), ("3", True, None)
    ]


def hand_made(spark):
    """Opportunities whose right answer is known by construction."""
    kinds = "opp long, office long, kind string, c double, refutes boolean"
    evidence = spark.createDataFrame([
        (1, 10, "explicit_owner", 0.9, False), (1, 11, "contracting_office", 0.99, False),
        (2, 10, "office_code", 0.8, False), (2, 12, "explicit_owner", 0.8, False),
        (3, 10, "semantic", 0.99, False), (3, 11, "industry_code", 0.99, False),
        (4, 13, "poc_context", 0.9, False),
        (5, 12, "explicit_owner", 0.9, True), (5, 12, "notice_prefix", 0.9, False),
        (6, 12, "explicit_owner", 0.9, False), (6, 12, "explicit_owner", 0.4, True),
    ], kinds).withColumn("confidence", F.col("c").cast("decimal(4,2)"))
    opps = spark.createDataFrame([(i,) for i in range(1, 8)], "opp long")
    d = dt.date
    versions = spark.createDataFrame([
        (10, 1, "a", d(2000, 1, 1), None), (11, 1, "b", d(2000, 1, 1), None), (12, 1, "c", d(2000, 1, 1), d(2010, 1, 1)),
        (12, 2, "c2", d(2010, 1, 1), None), (13, 1, "old", d(2000, 1, 1), d(2005, 1, 1)),
    ], "office long, version int, name string, valid_from date, valid_to date")
    return opps, evidence, versions


def test_resolution_by_hand(spark):
    opps, evidence, versions = hand_made(spark)
    got = {r.opp: (r.resolution, r.office) for r in ownership.resolve(opps, evidence, versions, "2020-01-01").collect()}
    assert got == {
        1: ("single", 10), 2: ("multi_program", None), 3: ("abstain", None), 4: ("legacy_review", None),
        5: ("abstain", None), 6: ("single", 12), 7: ("abstain", None),
    }


def test_views_of_the_evidence_resolve_in_one_pass_like_each_alone(spark):
    rows = [
        (1, 10, "explicit_owner", False, 1), (1, 10, "explicit_owner", False, 9), (1, 11, "office_code", False, 9),
        (2, 12, "explicit_owner", True, 1), (2, 13, "semantic", False, 1),  # accused, and nothing decisive left
        (3, 14, "poc_context", False, 5), (3, 15, "explicit_owner", True, 1),  # 14 has no open version
        (4, 10, "notice_prefix", False, 1), (9, 10, "explicit_owner", False, 1),  # 9 is no opportunity
        (6, None, "explicit_owner", False, 2),
    ]
    evidence = spark.createDataFrame(rows, "opp long, office long, kind string, refutes boolean, day int")
    opps = spark.createDataFrame([(i, 5) for i in range(1, 7)], "opp long, cutoff int")  # 5 has no evidence at all
    versions = spark.createDataFrame(
        [(o, 1, "v", dt.date(2000, 1, 1), dt.date(2001, 1, 1) if o == 14 else None) for o in (10, 11, 12, 13, 14, 15)],
        "office long, version int, name string, valid_from date, valid_to date",
    )
    views = {"known": F.col("day") <= F.col("cutoff"), "full": F.lit(True)}
    found = ownership.resolve_views(opps, evidence, versions, "2020-01-01", views)
    got = {r.opp: r for r in found.collect()}
    assert {i for i, r in got.items() if r.accused} == {1, 2, 3, 6}
    for name, seen in (("known", evidence.where("day <= 5")), ("full", evidence)):
        alone = ownership.resolve(opps.select("opp"), seen, versions, "2020-01-01").collect()
        assert len(alone) == len(got) == 6
        for r in alone:
            assert tuple(got[r.opp][name]) == (r.resolution, r.n_offices, r.n_current, r.office), (name, r.opp)
    assert got[1].known.resolution == "single" and got[1].full.resolution == "multi_program"
    assert got[3].full.resolution == "legacy_review" and got[5].full.resolution == "abstain"


def test_key_audit_counts_duplicates_and_orphans_in_one_grouping(spark):
    parents = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), (None,), (None,)], "id string")
    children = spark.createDataFrame([(1, 1, "a"), (1, 1, "x"), (1, 2, "x"), (2, 1, None), (3, 1, "y")], "k int, n int, ref string")
    used = spark.createDataFrame([("b",), ("z",)], "ref string")
    tables = {
        "parents": (parents, ["id"], {}),
        "children": (children, ["k", "n"], {"children.ref": ("ref", "parents")}),
        "used": (used, [], {"used.ref": ("ref", "parents")}),
    }
    report = validation.key_audit(tables, ["parents", "children"])
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    assert sorted(map(tuple, report.collect())) == [
        ("children", "duplicate_key", 1, 1), ("children.ref", "orphan_reference", 3, 2),
        ("parents", "duplicate_key", 3, 2), ("used.ref", "orphan_reference", 1, 1),
    ]
    nothing = {name: (df.where("false"), key, links) for name, (df, key, links) in tables.items()}
    assert {(r.n_rows, r.n_keys) for r in validation.key_audit(nothing, ["parents", "children"]).collect()} == {(0, 0)}


def test_gates_pass_on_the_hand_made_gold_and_fail_on_a_naive_resolver(spark):
    opps, evidence, versions = hand_made(spark)
    gold = spark.createDataFrame([
        (1, "positive_single_program", 10), (2, "multi_program_support", None), (3, "abstain_insufficient_owner", None),
        (4, "legacy_mapping_review", None), (5, "negative_non_target", None), (6, "positive_single_program", 12),
        (7, "abstain_insufficient_owner", None),
    ], "opp long, gold_class string, gold_office long")
    answers = ownership.resolve(opps, evidence, versions, "2020-01-01")
    report = {r.metric: r.passed for r in evaluation.gate_report(evaluation.gold_metrics(answers, gold)).collect()}
    assert all(report.values()) and len(report) == 7
    naive = ownership.candidates(evidence, 1).select("opp", F.lit("single").alias("resolution"), "office")
    report = {r.metric: r.passed for r in evaluation.gate_report(evaluation.gold_metrics(naive, gold)).collect()}
    assert not report["overall"] and not report["hard_negative_fpr"] and not report["legacy_force_mapped"]
    coverage = {r.gold_class: r.enough for r in evaluation.gold_class_coverage(gold).collect()}
    assert coverage["positive_single_program"] is False and coverage["abstain_insufficient_owner"] is True


def test_guards_are_empty_after_filtering_and_not_before(tables):
    evidence = derived.dated_evidence(tables)
    known = temporal.asof(evidence, "available_at", F.col("published_at"))
    late = F.col("published_at")
    assert temporal.leaked(known, "available_at", late).isEmpty()
    assert temporal.leaked(evidence, "available_at", late).count() == 3183
    owners = ownership.owner_offices(evidence)
    assert ownership.owner_guard(owners, evidence).isEmpty()
    assert not ownership.owner_guard(evidence.select("opp", "office").distinct(), evidence).isEmpty()


def test_planted_resolution_counts(tables):
    opps, versions = derived.opportunities(tables), derived.org_versions(tables)
    evidence = derived.dated_evidence(tables)

    def counts(rows_known):
        got = ownership.resolve(opps, rows_known, versions, AS_OF).groupBy(
            F.when(F.col("n_offices") == 0, "abstain").when(F.col("n_offices") == 1, "single").otherwise("multi").alias("r")
        ).count()
        return {r.r: r["count"] for r in got.collect()}

    assert counts(evidence) == {"abstain": 485, "single": 582, "multi": 433}
    known = temporal.asof(evidence, "available_at", F.col("published_at"))
    assert counts(known) == {"abstain": 931, "single": 410, "multi": 159}


def test_version_in_force_is_half_open(spark):
    _, _, versions = hand_made(spark)
    records = spark.createDataFrame(
        [(12, dt.date(2009, 12, 31)), (12, dt.date(2010, 1, 1)), (13, dt.date(2005, 1, 1)), (12, dt.date(1999, 1, 1))],
        "office long, at date",
    )
    got = rows(temporal.org_asof(records, versions, "at").fillna("-", ["org_name"]), "office", "at", "org_name")
    assert [g[2] for g in got] == ["-", "c", "c2", "-"]


def test_predictions_ignore_everything_after_the_cutoff(tables):
    events = derived.procurements(tables)
    cutoff = "2000-01-01"
    before = forecast.predicted_notices(events, cutoff)
    cut = forecast.predicted_notices(events.where(F.col("event_at") <= F.lit(cutoff).cast("date")), cutoff)
    assert same(before, cut) and before.count() > 0


def test_no_window_has_passed_at_the_cutoff(tables):
    events = derived.procurements(tables)
    for cutoff in ("1999-06-01", "2001-11-30"):
        windows = forecast.predicted_notices(events, cutoff)
        assert windows.count() > 0 and windows.where(F.col("window_end") < F.lit(cutoff).cast("date")).isEmpty()


def plain_backtest(events, horizon, last):
    """(key, cutoff, seq, outcome, error, contracting, method) by walking through each key's days."""
    import math

    rows = []
    for key in {e[:2] for e in events}:
        own = [e for e in events if e[:2] == key]
        days = sorted({e[2] for e in own})
        for i in range(3, len(days)):
            cutoff = days[i]
            if (last - cutoff).days < horizon:
                continue
            gaps = [(b - a).days for a, b in zip(days[:i], days[1 : i + 1])]
            n, total, squares = len(gaps), sum(gaps), sum(g * g for g in gaps)
            mean, spread = total / n, math.sqrt((squares - total * total / n) / (n - 1))
            day = lambda x: cutoff + dt.timedelta(math.floor(x + 0.5))
            windows = [(day(mean * m - spread), day(mean * m + spread)) for m in range(1, math.floor(horizon / mean) + 1)]
            later = [d for d in days if cutoff < d <= cutoff + dt.timedelta(horizon)]
            known = [e for e in own if e[2] <= cutoff]
            mode = lambda j: min((-sum(e[j] == v for e in known), v) for v in {e[j] for e in known})[1]
            for seq in range(max(len(windows), len(later))):
                w = windows[seq] if seq < len(windows) else None
                d = later[seq] if seq < len(later) else None
                first = min(e[3:] for e in own if e[2] == d) if d else None
                inside = w and d and w[0] <= d <= w[1]
                outcome = "missed" if not w else "false_positive" if not d else "correct" if inside else "mistimed"
                error = None if not (w and d) else 0 if inside else (d - (w[0] if d < w[0] else w[1])).days
                right = [None, None] if not (w and d) else [mode(3) == first[0], mode(4) == first[1]]
                rows.append((*key, cutoff, seq + 1, outcome, error, *right))
    return sorted(rows, key=str)


def test_backtest_equals_a_walk_through_the_days_and_leaks_nothing(spark):
    rng = random.Random(8)
    start = dt.date(2020, 1, 1)
    events = []
    for office, gap in ((1, 12), (2, 35), (3, 90), (4, 400)):
        at = start
        for _ in range(60):
            at += dt.timedelta(rng.choice([0, 1, gap // 2, gap, gap, gap + 9, 2 * gap]))
            events.append((office, "p", at, rng.randint(1, 3), rng.choice("xyz")))
    schema = "office long, program string, event_at date, contracting long, method string"
    df = spark.createDataFrame(events, schema)
    columns = ["office", "program", "cutoff", "seq", "outcome", "timing_error_days", "contracting_correct", "method_correct"]
    got = sorted([tuple(r[c] for c in columns) for r in forecast.backtest(df, 120).collect()], key=str)
    assert got == plain_backtest(events, 120, max(e[2] for e in events))
    assert {r[4] for r in got} == {"correct", "mistimed", "missed", "false_positive"}
    # what is predicted on a day stays the same whatever comes after it
    known = dt.date(2021, 3, 1)
    predicted = ["office", "cutoff", "n_gaps", "likely_method", "likely_contracting", "expected"]
    whole = forecast.rolling_predictions(df, 120).where(F.col("cutoff") <= F.lit(known))
    cut = forecast.rolling_predictions(df.where(F.col("event_at") <= F.lit(known)), 120)
    assert rows(whole.withColumn("expected", F.col("expected").cast("string")), *predicted) == rows(cut.withColumn("expected", F.col("expected").cast("string")), *predicted)
    assert forecast.backtest(df.limit(0), 120).count() == 0


def test_rolling_predictions_move_days_once(spark):
    schema = "office long, program string, event_at date, contracting long, method string"
    days = [dt.date(2020, 1, 1) + dt.timedelta(20 * i) for i in range(9)]
    known = [(1, "p", d, 1, "x") for d in days]
    df = spark.createDataFrame(known + [(None, "p", days[0], 1, "x"), (1, None, days[0], 1, "x"), (1, "p", None, 1, "x")], schema)
    found = forecast.rolling_predictions(df, 120)
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.office, r.program) for r in found.collect()} == {(1, "p")}
    assert found.count() == forecast.rolling_predictions(spark.createDataFrame(known, schema), 120).count() > 0


def test_rolling_predictions_shuffle_purchases_twice(spark):
    events = spark.createDataFrame([(1, "p", dt.date(2020, 1, 1), 1, "x")], "office long, program string, event_at date, contracting long, method string")
    plan = forecast.rolling_predictions(events, 120)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Union" not in plan


def test_rolling_predictions_prefer_the_smaller_of_equal_values_and_count_absent_ones(spark):
    days = [dt.date(2020, 1, 1) + dt.timedelta(20 * i) for i in range(6)]
    values = [(None, "x"), (2, None), (2, None), (None, "a"), (None, "a"), (None, "a")]
    schema = "office long, program string, event_at date, contracting long, method string"
    df = spark.createDataFrame([(1, "p", d, c, m) for d, (c, m) in zip(days, values)] + [(1, "p", days[5], 2, "a")], schema)
    found = forecast.rolling_predictions(df, 120)
    assert rows(found, "cutoff", "likely_contracting", "likely_method") == [(days[3], None, None), (days[4], None, None), (days[5], None, "a")]


def test_names_in_texts_longest_first(spark):
    from evgraph.operators import mentions

    texts = [
        (1, "The Red-Widget and the brand 4 RED widget; red widget"), (2, "brand 4 red"), (3, ""), (4, None),
        (5, "a b c d a b"), (6, "no name here"),
    ]
    names = [("red widget",), ("Brand 4 red widget",), ("brand 4",), ("Red  Widget!",), ("a b",), ("b c d",), ("",), (None,), ("a b c d a b c",)]
    found = mentions.mentions(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(names, "name string"))
    assert rows(found, "doc_id", "pos", "gram") == [
        (1, 1, "red widget"), (1, 5, "brand 4 red widget"), (1, 9, "red widget"), (2, 0, "brand 4"), (5, 0, "a b"), (5, 1, "b c d"), (5, 4, "a b"),
    ]
    assert mentions.mentions(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame([("!",)], "name string")).count() == 0


def test_platform_names_propose_offices_and_never_decide(spark, tables):
    citations = spark.createDataFrame([(1, 10), (1, 10), (2, 11), (3, 12)], "opp long, doc_id long")
    texts = spark.createDataFrame([(10, "for the blue bolt"), (11, "Brand 2 Blue Bolt, twice: brand 2 blue bolt"), (12, "nothing")], "doc_id long, text string")
    platforms = spark.createDataFrame([("blue bolt", 7), ("brand 2 blue bolt", 8), ("brand 2 blue bolt", 9)], "name string, office long")
    assert rows(ownership.named_platforms(citations, texts, platforms), "opp", "office") == [(1, 7), (2, 8), (2, 9)]
    evidence = derived.evidence(tables)
    named = ownership.named_platforms(evidence.select("opp", "doc_id"), derived.platform_documents(tables), derived.platforms(tables))
    found = ownership.generate_candidates(evidence, evidence.where("refutes"), evidence.where("line_status = 'F'"), named)
    assert found.where(F.array_contains("signals", "platform_name")).count() == named.count() > 0
    assert found.where("decisive").isEmpty()
    owners = ownership.owner_offices(evidence.unionByName(named.select("opp", "office", F.lit("platform_name").alias("kind"), F.lit(False).alias("refutes")), allowMissingColumns=True))
    assert same(owners, ownership.owner_offices(evidence))


def test_every_fact_of_a_text_with_form_feeds_reaches_its_page(spark):
    text = "zero\none\n\ftwo\nthree\n\f\ffour\nfive"
    df = spark.createDataFrame([(0, text), (1, "a\nb\nc\nd\ne\nf")], "doc_id long, text string")
    got = {(r.doc_id, r.page_no): (r.first_line, r.last_line) for r in docs.pages(df).collect()}
    assert got == {(0, 1): (0, 2), (0, 2): (2, 4), (0, 3): (4, 4), (0, 4): (4, 5), (1, 1): (0, 4), (1, 2): (5, 5)}
    spans = {(r.doc_id, r.page_no): (r.start_char, r.end_char) for r in docs.pages(df).collect()}
    assert all(text[a:b] == p for (d, n), (a, b) in spans.items() for p in [text.split("\f")[n - 1]] if d == 0)
    at = [i for i, c in enumerate(text) if c not in "\f"]
    facts = spark.createDataFrame([(f"f{i}", 0, text[:i].count("\n"), i) for i in at], "fact_id string, doc_id long, line_no int, start_char int")
    claims = facts.selectExpr("concat('a', fact_id) AS assertion_id", "fact_id")
    for width in (4, 4096):
        traced = lineage.trace(claims, facts, docs.chunk(df, 2), docs.pages(df), width).collect()
        assert sorted(r.start_char for r in traced) == at  # one row each, also on lines of two pages
        assert all(r.page_no == text[: r.start_char].count("\f") + 1 for r in traced)
        chunks = {r.chunk_no: r for r in docs.chunk(df, 2).where("doc_id = 0").collect()}
        assert all(chunks[r.chunk_no].start_char <= r.start_char < chunks[r.chunk_no].end_char for r in traced)


def test_a_line_shared_by_two_chunks_and_two_pages_gives_one_row_a_fact(spark):
    text = "intro\nsee PMW 101 and\fPMW-102 then 0101234N, PMW 101 again FY1999"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    facts = docs.facts(df)
    found = {(r.kind, r.value): (r.start_char, r.end_char) for r in facts.collect()}
    assert all(text[a:b] == value and text.index(value) == a for (_, value), (a, b) in found.items()) and len(found) == 4
    claims = facts.select(identity.local_id("assertion", "fact_id").alias("assertion_id"), "fact_id")
    got = {r.start_char: (r.page_no, r.chunk_no) for r in lineage.trace(claims, facts, docs.chunk(df, 3), docs.pages(df)).collect()}
    assert got == {text.index("PMW 101"): (1, 0), text.index("PMW-102"): (2, 1), text.index("0101234N"): (2, 2), text.index("FY1999"): (2, 3)}


def test_chunks_know_the_pages_between_form_feeds(spark):
    text = "a b\fc d\n\n\f\fe f g"
    df = spark.createDataFrame([(1, text), (2, "\n" * 6 + "x\ny"), (3, "")], "doc_id long, text string")
    got = rows(docs.chunk(df, 2), "doc_id", "chunk_no", "start_page", "end_page")
    assert got == [(1, 0, 1, 1), (1, 1, 2, 2), (1, 2, 4, 4), (1, 3, 4, 4), (2, 0, 1, 2), (3, 0, 1, 1)]


def test_pages_and_chunks_give_the_text_back(spark):
    texts = ["", "   \n ", "one", "\n\n lead and trail \n\n", "a\fb\n\n\fc", "\n".join(f"# h{i}\nw {i}  x" for i in range(300)), "é ü\tñ " * 900]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert docs.reconstruct(docs.chunk(df, 7), df).where("not intact").isEmpty()
    paged = docs.pages(df).groupBy("doc_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("page_no", "text"))), lambda p: p["text"]).alias("p")
    )
    got = {r.doc_id: r.p for r in paged.collect()}
    assert all(("\f" if "\f" in t else "\n").join(got[i]) == t for i, t in enumerate(texts))
    assert got[4] == ["a", "b\n\n", "c"] and got[0] == [""]


def test_sections_nest_and_lines_before_the_first_heading_have_none(spark):
    text = "intro\n# A\nx\n## B\ny\n# C\nz"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = [r.section_path for r in docs.section_path(df).orderBy("line_no").collect()]
    assert got == [None, "A", "A", "A > B", "A > B", "C", "C"]


def test_money_scales(spark):
    df = spark.createDataFrame([(1, "$1.5 K, $2 million; $1,234 and $3 in thousands, $7B $9 Kelvin")], "doc_id long, text string")
    got = rows(docs.money(df, "doc_id"), "amount")
    assert [float(a[0]) for a in got] == [9.0, 1234.0, 1500.0, 3000.0, 2000000.0, 7000000000.0]


def test_adjacent_identifiers_are_all_found(spark):
    df = spark.createDataFrame([(1, "PMW 101 PMW-102, PMA103; XPMW 104 PMW 1055 0604567N FY 2024")], "doc_id long, text string")
    assert rows(docs.extract_ids(df, "doc_id"), "kind", "value") == [
        ("fiscal_year", "FY 2024"), ("office_code", "PMA103"), ("office_code", "PMW 101"), ("office_code", "PMW-102"),
        ("program_element", "0604567N"),
    ]


def test_links_resolve(spark):
    html = "".join(f'<a href="{h}">x</a>' for h in (
        "/a", "b.pdf", "./b.pdf", "//cdn.example/x", "http://o.example/y?z=1&amp;w=2", "#top", "mailto:q@example.com", "/a"
    ))
    df = spark.createDataFrame([(1, "https://h.example/d/page?q=1#f", html), (2, "https://h.example", html)], "page_id long, url string, html string")
    got = rows(docs.enumerate_links(df), "link", "n_pages", "is_document")
    assert got == sorted([
        ("https://h.example/a", 2, False), ("https://h.example/d/b.pdf", 1, True), ("https://h.example/b.pdf", 1, True),
        ("https://cdn.example/x", 2, False), ("http://o.example/y?z=1&w=2", 2, False),
    ])


def test_links_resolve_like_the_standard_library(spark):
    """Every way to write a link against every kind of page, compared with urllib."""
    from urllib.parse import urldefrag, urljoin

    bases = ["https://h.example", "https://h.example/", "https://h.example/a/b/c?q=/x/../y#f", "http://h.example:8080/a/b/", "https://h.example/a"]
    refs = [
        "g", "./g", "g/", "/g", "//o.example/g/./h", "?y", "g?y", "g?y/./x", "g?y/../x", "g#s", "..", "../", "../g", "../..", "../../g",
        "../../../g", "../../../../g", "/./g", "/../g", "g.", ".g", "g..", "..g", "./../g", "./g/.", "g/./h", "g/../h", ".", "./",
        "http://o.example/a/../b", "mailto:a@b.example", "JavaScript:void(0)", "#top", "", "a&amp;b=1", "d/./r.PDF?x=1&amp;y=2#z",
    ]
    wraps = ['<a href="{}">', "<a HREF = '{}'>", "<a class=x\thref={}>", "<a href={} id=y>", '<a data-href="never" href=" {} ">']
    rows_in, want = [], {}
    for base in bases:
        for ref in refs:
            for wrap in wraps:
                if not ref and "{}>" in wrap or not ref and "{} " in wrap:
                    continue  # a bare value cannot be empty
                page = len(rows_in)
                rows_in.append((page, base, wrap.format(ref)))
                plain = urldefrag(ref.replace("&amp;", "&")).url
                if plain and not plain.lower().startswith(("mailto:", "javascript:")):
                    root = base + "/" if base.count("/") == 2 else base
                    link = urljoin(root, plain)
                    want.setdefault(link, set()).add(page)
    rows_in += [(10_000, None, '<a href="/lost"><a href="http://o.example/kept">'), (10_001, "https://h.example/", None)]
    want["http://o.example/kept"] = {10_000}
    got = docs.enumerate_links(spark.createDataFrame(rows_in, "page_id long, url string, html string")).collect()
    assert {r.link: (r.discovered_on, r.n_pages) for r in got} == {k: (min(v), len(v)) for k, v in want.items()}
    assert {r.link for r in got if r.is_document} == {k for k in want if ".PDF" in k}


def test_instrument_numbers_by_their_letter(spark):
    text = "N00039-20-C-0012 N00039-21-D-0001 W15678-22-F-0003 N00024-23-R-0104 N00024-23-Z-0104 X00039 RDT&E, MILCON xOPN"
    found = docs.extract_ids(spark.createDataFrame([(1, text)], "doc_id long, text string"), "doc_id")
    assert rows(found, "kind", "value") == [
        ("activity_code", "N00024"), ("activity_code", "N00024"), ("activity_code", "N00039"), ("activity_code", "N00039"),
        ("activity_code", "W15678"), ("activity_code", "X00039"), ("appropriation", "MILCON"), ("appropriation", "RDT&E"),
        ("award", "W15678-22-F-0003"), ("contract", "N00039-20-C-0012"), ("notice", "N00024-23-R-0104"),
        ("vehicle", "N00039-21-D-0001"),
    ]


def test_all_owners_and_all_holders_of_a_role_are_rows(spark):
    evidence = spark.createDataFrame([
        (1, 10, "explicit_owner", 0.9, False), (1, 10, "office_code", 0.95, False), (1, 11, "poc_context", 0.7, False),
        (1, 12, "semantic", 0.99, False), (2, 10, "explicit_owner", 0.8, True), (3, 13, "explicit_owner", 0.6, False),
    ], "opp long, office long, kind string, confidence double, refutes boolean")
    day = dt.date(1995, 1, 1)
    versions = spark.createDataFrame(
        [(10, 1, "a", day, None), (11, 1, "b", day, None), (13, 1, "c", day, dt.date(1998, 1, 1))],
        "office long, version int, name string, valid_from date, valid_to date",
    )
    got = rows(ownership.resolved_owners(evidence, versions, AS_OF), "opp", "office", "is_current", "n_claims", "best_confidence", "n_offices", "resolution")
    assert got == [
        (1, 10, True, 2, 0.95, 2, "multi_program"), (1, 11, True, 1, 0.7, 2, "multi_program"), (3, 13, False, 1, 0.6, 1, "legacy_review"),
    ]
    roles = spark.createDataFrame(
        [(1, "owner", 5), (1, "owner", 6), (1, "owner", 5), (1, "funding", 5), (1, "unheard", 9), (2, "owner", 7)], "opp long, role string, office long"
    )
    held = rows(ownership.role_holders(roles), "opp", "role", "office", "n_claims", "n_holders")
    assert held == [(1, "funding", 5, 1, 1), (1, "owner", 5, 2, 2), (1, "owner", 6, 1, 2), (2, "owner", 7, 1, 1)]


def test_role_separation_names_every_holder_of_a_role(spark):
    roles = spark.createDataFrame(
        [(1, "owner", 7), (1, "owner", 6), (1, "owner", 7), (1, "funding", 5), (1, "award", None), (2, "technical", 7)],
        "opp long, role string, office long",
    )
    wide = ownership.roles(roles)
    assert rows(wide, "opp", "owner_n", "owner_office", "owner_offices") == [(1, 2, None, [6, 7]), (2, 0, None, [])]
    assert rows(wide, "opp", "funding_office", "funding_offices", "award_offices", "technical_offices") == [(1, 5, [5], [], []), (2, None, [], [], [7])]


def test_answer_evidence_cites_pages_and_keeps_what_refutes(spark):
    from evgraph.plans import answers

    day = dt.date(2000, 1, 1)
    evidence = spark.createDataFrame([
        (1, 10, "explicit_owner", 0.9, day, False, 100), (1, 10, "explicit_owner", 0.7, day, False, 100),
        (1, 11, "office_code", 0.8, day, False, 101), (1, 12, "semantic", 0.8, day, False, 100),  # weak kinds support nothing
        (1, 12, "semantic", 0.6, day, True, 100),  # but they may refute
        (1, 10, "poc_context", 0.9, dt.date(2009, 1, 1), False, 100),  # not known yet
        (2, 10, "poc_context", 0.9, day, False, 102),  # document never retrieved
        (3, 10, "poc_context", 0.5, day, False, 103),
    ], "opp long, office long, kind string, confidence double, available_at date, refutes boolean, doc_id long")
    manifest = spark.createDataFrame([(100, "retrieved"), (101, "retrieved"), (102, "blocked"), (103, "retrieved")], "doc_id long, status string")
    texts = spark.createDataFrame([
        (100, "front\fNeeds of\nPMW 150 and PMW 160\nend"), (101, "nothing"), (102, "PMW 101"), (103, "a b c\nOffice PEO 222"),
    ], "doc_id long, text string")
    marks = docs.facts(texts, with_line=True).where("kind = 'office_code'")
    got = answers.answer_evidence(evidence, manifest, marks, docs.chunk(texts, 3), docs.pages(texts), AS_OF)
    keys = ("opp", "office", "kind", "doc_id", "stance", "confidence", "page_no", "chunk_no", "line_no", "passage")
    assert sorted((tuple(r[c] for c in keys) for r in got.collect()), key=str) == [
        (1, 10, "explicit_owner", 100, "supports", 0.9, 2, 1, 1, "PMW 150 and PMW 160"),
        (1, 11, "office_code", 101, "supports", 0.8, None, None, None, None),
        (1, 12, "semantic", 100, "refutes", 0.6, 2, 1, 1, "PMW 150 and PMW 160"),
        (3, 10, "poc_context", 103, "supports", 0.5, 1, 1, 1, "Office PEO 222"),
    ]


def test_each_source_is_held_to_its_own_cadence(spark):
    at = dt.datetime(2024, 3, 1, 12)
    seen = spark.createDataFrame([
        ("a", "retrieved", at), ("a", "blocked", at + dt.timedelta(days=9)), ("b", "retrieved", at), ("c", "missing", at), (None, "retrieved", at),
    ], "source string, status string, retrieved_at timestamp_ntz")
    registry = spark.createDataFrame([("a", 30, "x"), ("a", 30, "y"), ("b", 10, "x"), ("c", 30, "x"), ("d", 30, "x")], "source_id string, cadence_days int, stage string")
    got = temporal.source_staleness(registry, seen, "2024-03-15").fillna(-1, "age_days")
    assert rows(got, "source", "n_documents", "n_retrieved", "age_days", "freshness") == [
        ("a", 2, 1, 14, "fresh"), ("b", 1, 1, 14, "stale"), ("c", 1, 0, -1, "undated"), ("d", 0, 0, -1, "undated"),
    ]


def test_revisions_grow_only_on_change(spark):
    at = dt.datetime(2024, 1, 1)
    texts = ["a", "a", "b", "a", "a"]
    df = spark.createDataFrame([("u", i, at + dt.timedelta(days=i), t) for i, t in enumerate(texts)], "url string, doc_id long, retrieved_at timestamp_ntz, text string")
    assert rows(docs.revisions(df), "doc_id", "changed", "revision") == [
        (0, True, 1), (1, False, 1), (2, True, 2), (3, True, 3), (4, False, 3)
    ]


def test_last_observation_at_the_same_moment_counts(spark):
    t = dt.datetime(2024, 1, 1)
    schema = "event_id long, person long, at timestamp_ntz, value double"
    obs = spark.createDataFrame([(1, 1, t, 1.0), (2, 1, t + dt.timedelta(days=3), 2.0)], schema)
    ev = spark.createDataFrame([(3, 1, t, 0.0), (4, 1, t + dt.timedelta(days=9), 0.0), (5, 2, t, 0.0)], schema)
    got = temporal.last_before(ev, obs, ["person"], "at", "event_id", "value")
    assert rows(got.fillna(-1.0), "event_id", "last_value") == [(3, 1.0), (4, 2.0), (5, -1.0)]


def test_titles_alone_make_no_champion(spark):
    day = dt.date(2024, 1, 30)
    df = spark.createDataFrame(
        [(1, 1, None, day)] * 5 + [(2, 1, "owns_program", day), (2, 1, None, day)],
        "person long, office long, signal string, observed_at date",
    )
    assert [(r.person, r.supporting, r.weakening, r.label) for r in people.champions(df, "2024-01-31").collect()] == [
        (2, ["owns_program"], ["single_kind"], "prediction")
    ]


def test_categories(spark):
    titles = {
        "Deputy Program Manager": "program_leadership", "Contracting Specialist": "contracting", "Lead Engineer": "technical",
        "Requirements Owner": "requirement_ownership", "Acquisition Lead": "acquisition_authority",
        "Small Business Liaison": "small_business", "Barista": "uncategorised",
    }
    df = spark.createDataFrame([(t,) for t in titles], "raw_title string")
    assert {r.raw_title: r.category for r in people.categorise(df).collect()} == titles


def test_role_gap_opens_a_new_interval(spark):
    d = dt.date
    df = spark.createDataFrame(
        [(1, 1, "x", d(2020, 1, 1)), (1, 1, "x", d(2020, 1, 1)), (1, 1, "x", d(2021, 1, 1)), (1, 1, "x", d(2023, 1, 1))],
        "person long, office long, raw_title string, observed_at date",
    )
    assert rows(people.role_history(df, 366), "valid_from", "last_seen", "n_seen") == [
        (d(2020, 1, 1), d(2021, 1, 1), 3), (d(2023, 1, 1), d(2023, 1, 1), 1)
    ]


def plain_nearest(needs, profiles, k):
    """(need, rank, office, score) by comparing every pair."""
    import numpy as np

    rows = []
    for need, v in needs:
        v = np.asarray(v, float)
        if not np.any(v):
            continue
        ranked = sorted((-round(float(v @ p / (np.linalg.norm(v) * np.linalg.norm(p))), 6), o) for o, p in profiles if np.any(p))
        rows += [(need, i + 1, o, -s) for i, (s, o) in enumerate(ranked[:k])]
    return sorted(rows)


def clustered(seed, groups, size, dim, spread):
    import numpy as np

    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim))
    return [(centres[i % groups] + spread * rng.normal(size=dim)).round(3).tolist() for i in range(groups * size)]


@pytest.mark.parametrize("block", [5, 1000])
def test_nearest_vectors_equal_a_comparison_of_all_pairs(spark, block):
    """On clustered vectors, less than half of the pairs are compared."""
    vectors = clustered(2, 12, 25, 8, 0.2)
    profiles = list(enumerate(vectors[:240])) + [(900, [0.0] * 8), (901, vectors[3]), (902, vectors[3])]
    needs = [(1000 + i, v) for i, v in enumerate(vectors[240:])] + [(2000, [0.0] * 8), (2001, vectors[3]), (2002, [-x for x in vectors[3]])]
    given = spark.createDataFrame(profiles, "office long, profile array<double>")
    asked = spark.createDataFrame(needs, "need long, embedding array<float>")
    got = rows(matching.match_vectors(asked, given, 4, block), "need", "rank", "office", "score")
    exact = [(n, [float(x) for x in r.embedding]) for n, r in zip([n for n, _ in needs], asked.collect())]
    assert got == plain_nearest(exact, profiles, 4)
    compared = vector_index.nearest(asked, given, 4, block).agg(F.sum("n_compared")).first()[0]
    assert compared < 0.5 * len(needs) * len(profiles)


def test_nearest_vectors_of_unrelated_and_missing_profiles(spark, tables):
    vectors = tables.embeddings
    profiles = vectors.select(F.col("vec_id").alias("office"), F.transform("embedding", lambda x: x.cast("double")).alias("profile")).where("office % 5 = 0")
    needs = vectors.where("vec_id % 4 = 1").select(F.col("vec_id").alias("need"), "embedding")
    got = rows(matching.match_vectors(needs, profiles, 4, 10), "need", "rank", "office", "score")
    assert got == plain_nearest([(r.need, r.embedding) for r in needs.collect()], [(r.office, r.profile) for r in profiles.collect()], 4)
    assert matching.match_vectors(needs, profiles.limit(0), 4).count() == 0
    assert rows(matching.match_vectors(needs, profiles.where("office = 5"), 4), "office") == [(5,)] * needs.count()


def test_text_match_opens_few_pairs_and_loses_none(spark):
    """Passages of common words with a few rare ones: the lists of the common words stay closed."""
    import random

    rng = random.Random(3)
    common, rare = [f"c{i}" for i in range(30)], [f"r{i}" for i in range(300)]
    texts = [" ".join(rng.choices(common, k=25) + rng.sample(rare, 4)) for _ in range(1200)]
    wanted = [" ".join(rng.choices(common, k=6) + rng.sample(texts[i].split()[25:], 3)) for i in range(0, 1200, 40)]
    passages = spark.createDataFrame([(f"o{i % 9}", i, x) for i, x in enumerate(texts)], "office string, passage_id long, text string")
    needs = spark.createDataFrame(list(enumerate(wanted)), "need long, text string")
    counted = passages.select("office", "passage_id", matching.term_counts(F.col("text")).alias("_terms"))
    idf = matching.inverse_frequency(counted.select(F.inline("_terms")), len(texts))
    asked = matching.asked_terms(needs, idf)
    forward = matching.forward_index(counted, idf, asked)
    weights = asked.groupBy("need").agg(F.map_from_entries(F.collect_list(F.struct("term", "qw"))).alias("_weights"))
    every = needs.select("need").join(forward.select("passage_id"), F.lit(True))
    whole = matching.best_passages(matching.scored_pairs(every, forward, weights))
    best = {}
    for need, score, office, passage in sorted(((r.need, -r.score, r.office, r.passage_id) for r in whole.collect())):
        best.setdefault(need, []).append((need, len(best.get(need, [])) + 1, office, passage, -score))
    got = rows(matching.match_need(needs, passages, 3), "need", "rank", "office", "passage_id", "score")
    assert got == sorted(x for found in best.values() for x in found[:3])
    pairs = matching.candidate_pairs(asked, matching.posting_lists(forward), forward, weights, 3)
    assert pairs.count() < 0.2 * len(texts) * len(wanted)


@pytest.mark.parametrize("frequent", [1, 4, 100])
def test_frequent_and_rare_terms_weigh_alike(spark, frequent):
    """Whichever terms are held by the passages' tasks, the weights are those of one join over all."""
    rng = random.Random(frequent)
    texts = [" ".join(rng.choices("abcdefghij", weights=range(10, 0, -1), k=6)) for _ in range(40)]
    passages = spark.createDataFrame([(f"o{i % 3}", i, x) for i, x in enumerate(texts)], "office string, passage_id long, text string")
    counted = passages.select("office", "passage_id", matching.term_counts(F.col("text")).alias("_terms"))
    idf = matching.inverse_frequency(counted.select(F.inline("_terms")), len(texts))
    asked = matching.asked_terms(spark.createDataFrame([(1, "a b j"), (2, "h")], "need long, text string"), idf)
    weight = {r.term: r.idf for r in idf.collect()}
    want = {}
    for i, x in enumerate(texts):
        w = {t: x.split().count(t) * weight[t] for t in set(x.split()) if t in weight}
        met = {t: round(v, 9) for t, v in w.items() if t in "abjh"}
        if met:
            want[i] = (round(sum(v * v for v in w.values()) ** 0.5, 9), met)
    forward = matching.forward_index(counted, idf, asked, frequent)
    assert {r.passage_id: (round(r.plen, 9), {m.term: round(m.w, 9) for m in r.met}) for r in forward.collect()} == want


def test_short_tables_come_to_joins_whatever_the_session_broadcasts(spark):
    from evgraph.session import held, written

    setting = "spark.sql.autoBroadcastJoinThreshold"
    before, rows_ = spark.conf.get(setting), spark.range(50).withColumn("k", F.col("id") % 3)
    table = written(spark.range(3).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")), "short")
    spark.conf.set(setting, "-1")
    try:
        plans = [rows_.join(side, "k")._jdf.queryExecution().executedPlan().toString() for side in (held(table), held(table, 2))]
        assert "BroadcastHashJoin" in plans[0] and "BroadcastHashJoin" not in plans[1]
        passages = spark.createDataFrame([("o", i, "a b" if i % 2 else "a c") for i in range(9)] + [("o", 9, "d")], "office string, passage_id long, text string")
        counted = passages.select("office", "passage_id", matching.term_counts(F.col("text")).alias("_terms"))
        idf = matching.inverse_frequency(counted.select(F.inline("_terms")), 10)
        asked = matching.asked_terms(spark.createDataFrame([(1, "b")], "need long, text string"), idf)
        forward = matching.forward_index(counted, idf, asked)
        assert forward._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin") == 2
        assert rows(forward, "passage_id") == [(1,), (3,), (5,), (7,)]
    finally:
        spark.conf.set(setting, before)


def test_text_match_equals_brute_force(spark):
    import math
    import re

    passages = [("o1", 1, "alpha beta beta"), ("o1", 2, "gamma delta"), ("o2", 3, "beta gamma"), ("o3", 4, "the the"), ("o2", 5, "alpha the")]
    needs = [(1, "alpha beta"), (2, "gamma"), (3, "unseen")]
    got = matching.match_need(
        spark.createDataFrame(needs, "need long, text string"),
        spark.createDataFrame(passages, "office string, passage_id long, text string"), 2,
    )
    bags = {p: re.findall("[a-z0-9]+", t) for _, p, t in passages}
    idf = {w: math.log(len(passages) / sum(w in b for b in bags.values())) for b in bags.values() for w in b}

    def vector(words):
        return {w: words.count(w) * idf[w] for w in set(words) if w in idf}

    expected = []
    for need, text in needs:
        q, best = vector(text.split()), {}
        for office, p, _ in passages:
            v = vector(bags[p])
            dot = sum(q.get(w, 0) * x for w, x in v.items())
            if dot > 0:
                score = round(dot / math.hypot(*q.values()) / math.hypot(*v.values()), 6)
                best[office] = max(best.get(office, (0, 0)), (score, -p))
        top = sorted((-s, o, -p) for o, (s, p) in best.items())[:2]
        expected += [(need, i + 1, o, p, -s) for i, (s, o, p) in enumerate(top)]
    assert rows(got, "need", "rank", "office", "passage_id", "score") == sorted(expected)


def test_trace_reaches_the_right_page(spark):
    text = "\n".join(["filler words here"] * 12 + ["see PMW 101 now"])
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    facts = docs.facts(df)
    claims = facts.select(identity.local_id("assertion", "fact_id").alias("assertion_id"), "fact_id")
    (row,) = lineage.trace(claims, facts, docs.chunk(df, 10), docs.pages(df)).collect()
    assert (row.line_no, row.page_no, row.chunk_no) == (12, 3, 3)


def test_stage_coverage_keeps_uncovered_stages(tables):
    from evgraph.schema import SOURCE_STAGES

    registry = docs.source_registry(derived.registry_raw(tables))
    table = docs.stage_coverage(registry, SOURCE_STAGES, ["budget", "forecasts"])
    assert rows(table.where("coverage = 'none'"), "stage") == [("congressional",)] or table.count() == 8
    strange = registry.limit(1).select(F.lit(-1).cast(registry.schema["source_id"].dataType).alias("source_id"), F.lit("other").alias("family"), F.lit(SOURCE_STAGES[0]).alias("stage"))
    row = docs.stage_coverage(strange, SOURCE_STAGES, ["budget"]).where(F.col("stage") == SOURCE_STAGES[0]).first()
    assert (row.budget, row.n_sources, row.coverage) == (0, 1, "covered")


def test_different_keys_have_different_ids(spark):
    keys = [("a|b", "c"), ("a", "b|c"), (None, "x"), ("x", None), ("x", "\\N"), ("\\", "|x"), ("\\|", "x"), ("a\\", "x"), ("", "x")]
    df = spark.createDataFrame(keys, "a string, b string").select(identity.local_id("k", "a", "b").alias("id"))
    assert df.distinct().count() == len(keys)


def test_multi_program_answer_names_every_owner(spark):
    from evgraph.operators import ownership

    rows_ = [(1, office, "explicit_owner", False) for office in (9, 3, 5, 1, 7, 8)] + [(1, 2, "explicit_owner", True)]
    evidence = spark.createDataFrame(rows_, "opp long, office long, kind string, refutes boolean")
    assert rows(ownership.owner_offices(evidence), "office") == [(1,), (3,), (5,), (7,), (8,), (9,)]


def test_coverage_and_guard_agree(tables):
    evidence = derived.evidence(tables)
    known = tables.documents.select("doc_id")
    total = lineage.coverage(evidence, known).agg(F.sum("n_uncovered").alias("n")).first().n
    assert total == lineage.uncovered(evidence, known).count()


def test_answer_by_hand(spark):
    from evgraph.plans.answers import answer_opportunity

    opps, evidence, versions = hand_made(spark)
    d = dt.date
    evidence = evidence.withColumn("available_at", F.lit(d(2019, 1, 1))).withColumn("doc_id", F.col("office"))
    late = evidence.where("opp = 7 or opp = 1").limit(1).select(
        F.lit(7).cast("long").alias("opp"), F.lit(10).cast("long").alias("office"), F.lit("explicit_owner").alias("kind"),
        "c", F.lit(False).alias("refutes"), "confidence", F.lit(d(2021, 1, 1)).alias("available_at"),
        F.lit(10).cast("long").alias("doc_id"),
    )
    parents = spark.createDataFrame([("office:10", "pf:1"), ("pf:1", "agency:1"), ("office:12", "pf:1")], "child string, parent string")
    contacts = spark.createDataFrame(
        [(10, "technical", 5, "Engineer", d(2019, 1, 1)), (10, "technical", 6, "Engineer", d(2019, 5, 1)), (10, "contracting", 7, "Officer", d(2018, 1, 1))],
        "office long, category string, person long, raw_title string, observed_at date",
    )
    manifest = spark.createDataFrame([(10, "retrieved"), (12, "blocked")], "doc_id long, status string")
    opps = opps.withColumn("contracting", F.lit(99).cast("long"))
    got = {r.opp: r for r in answer_opportunity(
        opps, evidence.unionByName(late), versions, parents, contacts, manifest, "2020-01-01"
    ).collect()}
    one, six, seven = got[1], got[6], got[7]
    assert (one.office, one.contracting, one.path) == (10, 99, ["office:10", "pf:1", "agency:1"])
    assert one.contacts == ["contracting:7", "technical:6"] and one.alternatives == [11]
    assert one.cited == ["explicit_owner:10"] and one.unknowns == []
    assert (six.office, six.cited, six.n_counterevidence) == (12, None, 1) and six.unknowns == ["contacts", "evidence"]
    assert (seven.resolution, seven.office) == ("abstain", None) and "owner" in seven.unknowns
    assert got[2].resolution == "multi_program" and sorted(got[2].alternatives) == [10, 12]
    assert got[2].owners == [10, 12] and one.owners == [10] and seven.owners is None


def test_clean_graph_joins_do_not_shuffle_edges(tables):
    from evgraph.operators import validation

    plan = validation.dangling_edges(derived.nodes(tables), derived.edges(tables))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("BroadcastHashJoin") == 2 and "Exchange hashpartitioning" not in text


def test_long_texts_keep_lines_and_sections(spark):
    """More chunks and headings than one block holds, against plain Python."""
    rng = random.Random(2)
    lines, marks = [], []
    for i in range(1500):
        level = rng.choice([0, 0, 1, 2])
        lines.append(("#" * level + " " if level else "") + " ".join(f"w{i}" for _ in range(rng.randint(1, 4))))
    text = "\n".join(lines)
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    section, paths = None, []
    current = None
    for line in lines:
        if line.startswith("# "):
            section = current = line[2:]
        elif line.startswith("## "):
            current = f"{section} > {line[3:]}" if section else line[3:]
        paths.append(current)
    got = [(r.line, r.section_path) for r in docs.section_path(df).orderBy("line_no").collect()]
    assert got == list(zip(lines, paths))
    chunks = docs.chunk(df, 7).orderBy("chunk_no").collect()
    assert len(chunks) > 300 and "".join(c.text for c in chunks) == text
    position = 0
    for c in chunks:
        line = text.count("\n", 0, position)
        assert (c.start_line, c.end_line) == (line, line + c.text.rstrip().count("\n"))
        assert c.section_path == paths[line]
        position += len(c.text)


def test_tasks_are_sized_by_data_not_by_the_sessions_partitions(spark):
    """A session with eight shuffle partitions still cuts groupings finer, so a task's share does not grow with its input."""
    grouped = spark.range(1000).groupBy((F.col("id") % 100).alias("k")).count()
    assert "hashpartitioning(k" in grouped._jdf.queryExecution().toString().replace("_groupingexpression", "k")
    assert ", 512)" in grouped._jdf.queryExecution().toString()


@pytest.mark.parametrize("few", [1, 2, 64])
def test_pairs_named_by_platform_equal_the_grouped_ones_and_are_not_shuffled(spark, few):
    rng = random.Random(few)
    kinds = ["contracting_office", "industry_code", "semantic"]
    lines = [(rng.randrange(12), rng.choice([*range(9), None]), rng.choice(kinds), rng.randrange(4)) for _ in range(40)]
    evidence = spark.createDataFrame(lines, "opp long, office long, kind string, c int").select("opp", "office", "kind", F.col("c").cast("decimal(4,2)").alias("confidence"))
    none = evidence.where("false")
    cited = spark.createDataFrame(list({(rng.randrange(15), f"p{rng.randrange(7)}") for _ in range(40)}), "opp long, gram string")
    holders = spark.createDataFrame(list({(f"p{rng.randrange(1, 8)}", rng.randrange(9)) for _ in range(25)}), "gram string, office long")
    named = cited.join(holders, "gram").select("opp", "office").distinct()
    want = ownership.generate_candidates(evidence, none, none, named)
    got = ownership.with_named(ownership.generate_candidates(evidence, none, none), cited, holders, few)
    key = str
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
