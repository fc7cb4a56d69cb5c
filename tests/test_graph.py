"""Graph semantics on literal documents, edge by edge."""

import json
import random

import pytest
from pyspark.sql import functions as F

from evgraph.functions.evidence import to_confidence, with_round3
from evgraph.operators import ranking, validation
from evgraph.plans import report
from evgraph.sources import derived, graph_json

def proof(confidence, day):
    return {"source_url": f"https://records.test/{day}", "observed_at": f"2024-03-{day:02d}", "confidence": confidence}


SAMPLE = {
    "nodes": [
        {"id": "notice-4", "type": "solicitation", "due": "2024-06-01"},
        {"id": "bureau", "type": "subagency"},
        {"id": "lot-7", "type": "award", "parts": [{"n": 1}, {"n": None}]},
        {"id": "maker", "type": "company"},
    ],
    "edges": [
        {"from": "notice-4", "to": "lot-7", "type": "precedes", "evidence": proof(1, 9)},
        {"from": "bureau", "to": "notice-4", "type": "funds", "evidence": proof(0.25, 11)},
        {"from": "lot-7", "to": "maker", "type": "owns_mission", "tags": {"kept": [True, "x"]}, "evidence": proof(0.4, 2)},
        {"from": "maker", "to": "lot-7", "type": "holds", "evidence": proof(0.6, 30)},
    ],
}


@pytest.fixture
def load(spark, tmp_path):
    def read(document, name="graph.json"):
        (tmp_path / name).write_text(json.dumps(document, indent=2))
        documents = graph_json.read_graph(spark, str(tmp_path / name), multi_line=True)
        return graph_json.nodes(documents), graph_json.edges(documents)

    return read


def messages(nodes, edges):
    return [r.message for r in validation.in_report_order(validation.gaps(nodes, edges)).collect()]


def edge(kind="owns_mission", src="a", dst="a", **evidence):
    return {"from": src, "to": dst, "type": kind, "evidence": evidence}


FULL = {"source_url": "u", "observed_at": "d", "confidence": 1.0}


def test_sample_ranks_and_has_no_gaps(load):
    nodes, edges = load(SAMPLE)
    ranked = ranking.rank_edges(edges).select("type", "score").collect()
    assert [tuple(r) for r in ranked] == [
        ("owns_mission", 1.6), ("funds", 0.75), ("holds", 0.6), ("precedes", 0.5)
    ]
    assert messages(nodes, edges) == []


def test_empty_evidence_gives_three_gaps_in_field_order(load):
    nodes, edges = load({"nodes": [{"id": "a", "type": "agency"}], "edges": [edge()]})
    assert messages(nodes, edges) == [
        f"edge missing evidence.{f}: a -> a" for f in ("source_url", "observed_at", "confidence")
    ]


def test_weight_and_confidence_decide_together_where_nodes_are_absent(load):
    """3 * 0.3 = 0.9, 1 * 0.95 = 0.95, 2 * 0.46 = 0.92: the lightest kind wins by its evidence."""
    kinds = (("funds", 0.3), ("holds", 0.95), ("administers", 0.46))
    nodes, edges = load({"edges": [edge(kind, src=f"s{i}", confidence=c) for i, (kind, c) in enumerate(kinds)]})
    assert nodes.isEmpty()
    ranked = ranking.rank_edges(edges).select("type", "score").collect()
    assert [tuple(r) for r in ranked] == [("holds", 0.95), ("administers", 0.92), ("funds", 0.9)]


def test_missing_lists_are_empty(load):
    nodes, edges = load({})
    assert nodes.count() == edges.count() == 0
    assert messages(nodes, edges) == []


def test_invalid_types_one_message_per_node_nulls_included(load):
    nodes, edges = load({"nodes": [
        {"id": "a", "type": "vendor"}, {"id": "b", "type": "vendor"}, {"id": "c"}, {"id": "d", "type": None},
        {"id": "e", "type": "agency"},
    ]})
    assert messages(nodes, edges) == [
        "invalid node type: vendor", "invalid node type: vendor", "invalid node type: None", "invalid node type: None"
    ]


def test_both_ends_dangling_is_one_gap_before_the_fields(load):
    nodes, edges = load({"nodes": [{"id": "a", "type": "agency"}], "edges": [
        edge(src="a", dst="a", **FULL), edge(src="x", dst="y", source_url="", observed_at="d", confidence=1),
        edge(src="a", dst="z", **FULL),
    ]})
    assert messages(nodes, edges) == [
        "dangling edge: x -> y", "edge missing evidence.source_url: x -> y", "dangling edge: a -> z"
    ]


def test_absent_end_matches_a_node_without_id(load):
    document = {"nodes": [{"type": "agency"}], "edges": [{"type": "holds", "evidence": FULL}]}
    assert messages(*load(document)) == []
    document["nodes"] = [{"id": "a", "type": "agency"}]
    assert messages(*load(document)) == ["dangling edge: None -> None"]


def test_duplicate_node_ids_and_edges_are_legal(load):
    nodes, edges = load({
        "nodes": [{"id": "a", "type": "agency"}, {"id": "a", "type": "person"}], "edges": [edge(**FULL), edge(**FULL)],
    })
    assert messages(nodes, edges) == []
    assert ranking.rank_edges(edges).count() == 2


def test_null_evidence_counts_as_empty(load):
    nodes, edges = load({"nodes": [{"id": "a", "type": "agency"}], "edges": [
        {"from": "a", "to": "a", "type": "funds", "evidence": None}, {"from": "a", "to": "a", "type": "funds"},
    ]})
    assert len(messages(nodes, edges)) == 6
    assert [r.score for r in ranking.rank_edges(edges).collect()] == [0.0, 0.0]


def test_zero_and_false_are_present(load):
    nodes, edges = load({"nodes": [{"id": "a", "type": "agency"}], "edges": [
        edge(source_url="u", observed_at="d", confidence=0), edge(source_url=False, observed_at=0, confidence=False),
    ]})
    assert messages(nodes, edges) == []


@pytest.mark.parametrize(("given", "score"), [
    (0.95, 3.8), (1, 4.0), (0, 0.0), (-1, -4.0), (1.5, 6.0), ("0.9", 3.6), (" 0.9 ", 3.6), (True, 4.0), (False, 0.0),
    ("abc", 0.0), ("", 0.0), (None, 0.0), ("NaN", 0.0),
])
def test_confidence_values(load, given, score):
    _, edges = load({"edges": [edge(confidence=given)]})
    assert ranking.score_edges(edges).first().score == score


@pytest.mark.parametrize(("given", "absent"), [("abc", False), ("NaN", False), (" ", False), ("", True), (None, True)])
def test_a_confidence_that_is_no_number_is_no_missing_field(load, given, absent):
    nodes, edges = load({"nodes": [{"id": "a", "type": "agency"}], "edges": [
        edge(source_url="u", observed_at="d", confidence=given), edge(source_url="u", observed_at="d", confidence="0.5")
    ]})
    assert messages(nodes, edges) == (["edge missing evidence.confidence: a -> a"] if absent else [])
    full = [(r.kind, r.value) for r in validation.gaps(nodes, edges, unparsable=True).collect()]
    assert full == [("missing_evidence" if absent else "unparsable_confidence", given)]


def test_unknown_type_weighs_half_and_is_no_gap(load):
    nodes, edges = load({"nodes": [{"id": "a", "type": "agency"}], "edges": [edge("cites", **FULL), edge(None, **FULL)]})
    assert messages(nodes, edges) == []
    assert [r.score for r in ranking.rank_edges(edges).collect()] == [0.5, 0.5]


def test_ties_on_the_rounded_score_keep_input_order(load):
    _, edges = load({"edges": [
        edge("holds", confidence=0.80001, source_url="first"), edge("holds", confidence=0.80004, source_url="second"),
        edge("administers", confidence=0.4, source_url="third"), edge("funds", confidence=0.9, source_url="best"),
    ]})
    ranked = [r.u for r in ranking.rank_edges(edges).select(F.col("evidence.source_url").alias("u")).collect()]
    assert ranked == ["best", "first", "second", "third"]


def test_order_holds_for_many_ties(load):
    _, edges = load({"edges": [edge("holds", confidence=0.5, source_url=f"{i:04d}") for i in range(500)]})
    ranked = [r.u for r in ranking.rank_edges(edges.repartition(7)).select(F.col("evidence.source_url").alias("u")).collect()]
    assert ranked == [f"{i:04d}" for i in range(500)]


def test_weights_as_table_equal_weights_as_mapping(spark, tables):
    weights = {"owns_mission": 4.0, "owns_program": 4.0, "funds": 3.0, "procures_for": 3.0, "administers": 2.0, "holds": 1.0}
    table = spark.createDataFrame(list(weights.items()), "type string, weight double")
    edges = derived.edges(tables)
    one, other = ranking.score_edges(edges, weights), ranking.score_edges(edges, table)
    assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()


def test_rounding_is_exact_with_ties_to_even(spark):
    rng = random.Random(5)
    values = [i / 16000 for i in range(0, 40000, 7)] + [i / 10000 for i in range(20011)] + [i / 16 for i in range(64)]
    values += [rng.uniform(-5, 5) for _ in range(5000)] + [rng.uniform(0, 1e12) for _ in range(500)]
    values += [0.5 * 0.125, 4.0 * 0.123125, -0.0625, 0.0, 1e300, 5e-324, float("-inf")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    df = with_round3(df, "v", "r")
    assert [(r.v, r.r) for r in df.collect() if r.r != round(r.v, 3)] == []


def test_rounding_and_coercion_columns(spark):
    df = spark.createDataFrame([("1e-1",), ("inf",)], "c string")
    assert [r.r for r in with_round3(df.select(to_confidence(F.col("c")).alias("v")), "v", "r").collect()] == [0.1, float("inf")]


def test_report_writes_three_outputs_and_replaces_them(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "graph.json").write_text(json.dumps(SAMPLE, indent=2))
    for _ in range(2):
        assert report.run(spark, str(source), out, multi_line=True).first().asDict() == {"nodes": 4, "edges": 4, "gaps": 0}
    ranked = [json.loads(r.value) for r in spark.read.text(f"{out}/ranked").collect()]
    assert [r["score"] for r in ranked] == [1.6, 0.75, 0.6, 0.5]
    assert ranked[0]["tags"] == {"kept": [True, "x"]}
    nodes = sorted((json.loads(r.value) for r in spark.read.text(f"{out}/graph/nodes").collect()), key=lambda n: n["id"])
    assert nodes == sorted(SAMPLE["nodes"], key=lambda n: n["id"])
    edges = sorted((json.loads(r.value) for r in spark.read.text(f"{out}/graph/edges").collect()), key=lambda e: e["from"])
    assert edges == sorted(SAMPLE["edges"], key=lambda e: e["from"])
    assert spark.read.parquet(f"{out}/gaps").columns == validation.GAP_COLUMNS


def test_given_score_is_overwritten_and_other_keys_stay(spark, load, tmp_path):
    _, edges = load({"edges": [{**edge(**FULL), "score": 99, "extra": "x"}]})
    graph_json.write_ranked(ranking.score_edges(edges), str(tmp_path / "ranked"))
    (line,) = spark.read.text(str(tmp_path / "ranked")).collect()
    assert json.loads(line.value) == {**edge(**FULL), "score": 4.0, "extra": "x"}


def test_invalid_json_writes_nothing(spark, tmp_path):
    (tmp_path / "bad.json").write_text("{not json")
    with pytest.raises(Exception):
        report.run(spark, str(tmp_path / "bad.json"), str(tmp_path / "out"), multi_line=True)
    assert not (tmp_path / "out").exists()


def test_planted_defects_are_all_found(tables):
    nodes, edges = derived.nodes(tables), derived.edges(tables)
    kinds = {r["kind"]: r["count"] for r in validation.gaps(nodes, edges).groupBy("kind").count().collect()}
    assert kinds == {"invalid_node_type": 2, "dangling_edge": 601, "missing_evidence": 22 + 18 + 37}
    assert nodes.count() == 7929 and edges.count() == 6000
    scored = ranking.score_edges(edges)
    assert scored.where("score = 4.0").count() == 86
    assert scored.agg(F.round(F.sum("score"), 3).alias("s")).first().s == 13957.965


def test_partitioning_does_not_change_results(tables):
    nodes, edges = derived.nodes(tables), derived.edges(tables)
    plain = validation.gaps(nodes, edges)
    shuffled = validation.gaps(nodes.repartition(5, F.rand(1)), edges.repartition(11, F.rand(2)))
    assert plain.exceptAll(shuffled).isEmpty() and shuffled.exceptAll(plain).isEmpty()


def tricky(n):
    """A document whose strings look like structure."""
    nodes = [{"id": f"n{i}", "type": 'a "quoted" }], {[', "name": "line\\n\\\\", "extra": {"nodes": [1, [2, {}]], "x": []}} for i in range(n)]
    edges = [{"from": f"n{i}", "to": f"n{(i * 7) % n}", "type": ",:{", "evidence": {"source_url": "u,\"{", "confidence": i / 8}} for i in range(3 * n)]
    return {"note": {"edges": [{"from": "no"}], "nodes": "no"}, "nodes": nodes, "count": n, "edges": edges, "tail": [1, 2]}


@pytest.mark.parametrize("run_bits", [1, 12])
def test_split_documents_equal_whole_ones(spark, tmp_path, monkeypatch, run_bits):
    from evgraph.sources import split_json

    monkeypatch.setattr(split_json, "RUN_BITS", run_bits)
    (tmp_path / "two.json").write_text(json.dumps(tricky(40), indent=2))
    (tmp_path / "wide.json").write_text(json.dumps(tricky(7), indent=None).replace('}, {', '},\n{').replace('"edges": [{"from": "n', '"edges":\n\n [{"from": "n'))
    (tmp_path / "line.json").write_text(json.dumps(SAMPLE))
    (tmp_path / "none.json").write_text('{\n"nodes": [\n],\n"other": 1}')
    (tmp_path / "edges.json").write_text(json.dumps({"edges": tricky(3)["edges"]}, indent="\t"))
    whole = graph_json.read_graph(spark, str(tmp_path), multi_line=True)
    got = split_json.read_split(spark, str(tmp_path))
    for mine, want, columns in ((got[0], graph_json.nodes(whole), ["id", "type", "name"]), (got[1], graph_json.edges(whole), ["src", "dst", "type", "evidence"])):
        columns = ["doc", "pos", *columns, F.to_json("raw").alias("raw")]
        assert sorted(map(str, mine.select(*columns).collect())) == sorted(map(str, want.select(*columns).collect()))
    assert got[1].count() == 3 * 40 + 3 * 7 + 4 + 9


def test_a_compressed_document_is_cut_by_many_tasks_and_moves_once(spark, tmp_path):
    import bz2

    from evgraph.sources import split_json

    text = json.dumps(tricky(5000), indent=2)
    (tmp_path / "big.json.bz2").write_bytes(bz2.compress(text.encode(), 1))
    before = spark.conf.get(split_json.CUT)
    runs = split_json.packed_runs(spark, str(tmp_path), "8k")
    assert spark.conf.get(split_json.CUT) == before and runs.select("run.block").distinct().count() > 3
    assert runs.select(F.sum(F.size("lines"))).first()[0] == len(text.splitlines())
    nodes, edges = split_json.read_split(spark, str(tmp_path), "8k")
    whole = graph_json.read_graph(spark, str(tmp_path), multi_line=True)
    for mine, want in ((nodes, graph_json.nodes(whole)), (edges, graph_json.edges(whole))):
        columns = ["pos", F.to_json("raw").alias("raw")]
        assert sorted(map(str, mine.select(*columns).collect())) == sorted(map(str, want.select(*columns).collect()))
    marked = split_json.marked_runs(spark, str(tmp_path), "8k")
    numbers = marked.select("doc", "run", "commas")
    plan = split_json._joined(marked.drop("commas"), numbers)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_pretty_documents_are_packed_so_that_readers_can_cut_them(tables):
    from pathlib import Path

    from evgraph.catalog import graph as catalog

    files = [f for f in Path(catalog.write_pretty_documents(tables).removeprefix("file:")).rglob("part-*")]
    assert files and all(f.name.endswith(".bz2") for f in files)


def test_one_document_is_cut_by_many_tasks(spark, tmp_path):
    from evgraph.sources import split_json

    (tmp_path / "big.json").write_text(json.dumps(tricky(2000), indent=2))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128k")
    try:
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 4
        nodes, edges = split_json.read_split(spark, str(tmp_path))
        assert nodes.count() == 2000 and edges.count() == 6000
        assert edges.where("src = concat('n', pos)").count() == 6000  # every edge starts at the node of its place
        assert edges.agg(F.max("pos"), F.countDistinct("pos")).first()[:] == (5999, 6000)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("text", ['{"nodes": [', '{"nodes": [\n{"id": 1},\n{"id" 2}]}', '{"nodes": [{"id": "a}]}'])
def test_documents_that_are_no_json_fail(spark, tmp_path, text):
    from evgraph.sources import split_json

    (tmp_path / "bad.json").write_text(text)
    with pytest.raises(Exception):
        split_json.read_split(spark, str(tmp_path))[0].collect()


def test_lines_are_packed_before_they_move(spark, tmp_path, monkeypatch):
    from evgraph.sources import split_json

    long = 'x\\"' * 20_000  # long strings full of escapes are read, too
    document = {"nodes": [{"id": "a", "name": long}, {"id": "b"}], **tricky(500)}
    document["nodes"] = [{"id": "a", "name": long}, {"id": "b"}]
    (tmp_path / "big.json").write_text(json.dumps(document, indent=2))
    monkeypatch.setattr(split_json, "RUN_BITS", 9)
    lines, runs = spark.read.text(str(tmp_path)).count(), split_json.marked_runs(spark, str(tmp_path)).count()
    assert runs <= lines / 512 + 2
    nodes, edges = split_json.read_split(spark, str(tmp_path))
    assert [r.name for r in nodes.orderBy("pos").collect()] == [long, None] and edges.count() == 1500


def test_a_list_named_twice_fails_as_in_whole_documents(spark, tmp_path):
    from evgraph.sources import split_json

    (tmp_path / "twice.json").write_text('{"nodes": [{"id": "a"}],\n"nodes": [{"id": "b"}]}')
    with pytest.raises(Exception):
        graph_json.nodes(graph_json.read_graph(spark, str(tmp_path), multi_line=True)).collect()
    with pytest.raises(ValueError):
        split_json.read_split(spark, str(tmp_path))


def test_an_export_computes_its_rows_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(500, numPartitions=4).mapInArrow(count, "id long")
    graph_json.export_jsonl(rows, str(tmp_path / "out"), ["id"])
    files = sorted(f for f in (tmp_path / "out").iterdir() if f.name.startswith("part-"))
    assert [json.loads(line)["id"] for f in files for line in f.read_text().splitlines()] == list(range(500))
    assert seen.value == 500


def test_packed_lines_lie_in_bounded_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(graph_json, "LINES_PER_FILE", 10)
    lines = spark.range(25).coalesce(1).select(F.concat(F.lit("line "), F.col("id").cast("string")).alias("value"))
    graph_json.write_lines(lines, str(tmp_path / "out"), "gzip")
    files = sorted(f.name for f in (tmp_path / "out").iterdir() if f.name.startswith("part-"))
    assert len(files) == 3 and all(f.endswith(".gz") for f in files)
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect()) == sorted(f"line {i}" for i in range(25))


def test_queries_read_packed_documents_and_a_report_packs_its_lines(spark, tables, tmp_path):
    from evgraph.catalog.graph import write_documents

    source = write_documents(tables)
    assert all(r.doc.endswith(".gz") for r in graph_json.read_graph(spark, source).select("doc").distinct().collect())
    report.run(spark, source, str(tmp_path / "packed"), compression="gzip")
    report.run(spark, source, str(tmp_path / "plain"))
    for part in ("graph/nodes", "graph/edges", "ranked"):
        packed, plain = (spark.read.text(str(tmp_path / kind / part)) for kind in ("packed", "plain"))
        assert packed.count() == plain.count() and packed.exceptAll(plain).isEmpty()


def test_ranking_moves_a_record_and_its_place_alone(spark, tmp_path, monkeypatch):
    sorted_columns = []
    monkeypatch.setattr(graph_json, "ranking_order", lambda columns: sorted_columns.append(set(columns)) or ranking.ranking_order(columns))
    (tmp_path / "graph.json").write_text(json.dumps({"edges": [edge(src=str(i), source_url="u", confidence=i % 3 / 2) for i in range(30)]}))
    edges = graph_json.edges(graph_json.read_graph(spark, str(tmp_path / "graph.json")))
    graph_json.write_ranked(ranking.score_edges(edges), str(tmp_path / "ranked"))
    assert sorted_columns == [{"score", "doc", "line", "pos", "raw"}]
    files = sorted(f for f in (tmp_path / "ranked").iterdir() if f.name.startswith("part-"))
    got = [json.loads(line) for f in files for line in f.read_text().splitlines()]
    assert [int(r["from"]) for r in got] == sorted(range(30), key=lambda i: (-(i % 3), i))
