"""Graphs of specifications: order, cycles, files, refreshes."""

import json
import random

import pytest

from claimlake.plans.flows import FlowSpec
from claimlake.plans.graph import FlowGraph, GraphRunner, read_specs

SPECS = [
    {"name": "rows", "layer": "bronze", "source": "{landing}", "source_format": "parquet"},
    {"name": "kept", "layer": "silver", "table": "bronze_rows", "mode": "stream", "select": ["k", "v * {factor} AS v"],
     "rules": {"expect_or_drop": [{"name": "positive", "constraint": "v > 0"}]}},
    {"name": "latest", "layer": "silver", "table": "silver_kept", "keys": ["k"], "sequence": "v", "buckets": 2},
    {"name": "bad", "layer": "gold", "sql": "SELECT count(*) AS n FROM silver_kept_quarantine"},
    {"name": "sums", "layer": "gold", "sql": "SELECT sum(v) AS v FROM silver_latest"},
    {"name": "both", "layer": "gold", "sql": "SELECT v, n FROM gold_sums CROSS JOIN gold_bad"},
]


def graph_of(tokens):
    return FlowGraph(FlowSpec.from_mapping(s, tokens) for s in SPECS)


def test_order_does_not_depend_on_the_order_given():
    specs = [FlowSpec.from_mapping(s, {"landing": "x", "factor": "1"}) for s in SPECS]
    orders = set()
    for seed in range(10):
        random.Random(seed).shuffle(specs)
        graph = FlowGraph(specs)
        assert all(graph.order.index(i) < graph.order.index(n) for n in graph.order for i in graph.reads[n])
        orders.add(tuple(graph.order))
        assert set(graph.below("silver_latest")) == {"silver_latest", "gold_sums", "gold_both"}
    assert len(orders) == 1 and graph.reads["gold_bad"] == {"silver_kept"}


def test_cycles_unknown_tables_and_repeats_are_reported():
    cycle = [FlowSpec("a", sql="SELECT * FROM bronze_b"), FlowSpec("b", table="bronze_c"), FlowSpec("c", sql="SELECT 1 FROM bronze_a")]
    with pytest.raises(ValueError, match="wait for each other: .*bronze_a"):
        FlowGraph(cycle)
    with pytest.raises(ValueError, match="bronze_b reads bronze_c, which no"):
        FlowGraph(cycle[1:2])
    with pytest.raises(ValueError, match="two specifications"):
        FlowGraph([cycle[0], cycle[0]])
    with pytest.raises(ValueError, match="gold_x"):
        FlowGraph(cycle[:1]).below("gold_x")


def test_files_runs_and_refreshes(spark, tmp_path):
    (tmp_path / "specs" / "deep").mkdir(parents=True)
    for n, spec in enumerate(reversed(SPECS)):
        (tmp_path / "specs" / ("deep" if n % 2 else ".") / f"{n}.json").write_text(json.dumps(spec if n else [spec]))
    landing, root = str(tmp_path / "landing"), str(tmp_path / "tables")
    land = lambda *rows: spark.createDataFrame(rows, "k string, v int").write.mode("append").parquet(landing)
    tokens = {"landing": landing, "factor": "1"}
    land(("a", 1), ("a", 2), ("b", 3), ("b", -1))
    graph = FlowGraph(read_specs(spark, str(tmp_path / "specs"), tokens))
    both = lambda: tuple(GraphRunner(spark, root, graph).flows.read("gold_both").first())
    GraphRunner(spark, root, graph).run()
    assert both() == (5, 1)

    doubled = GraphRunner(spark, root, graph_of({**tokens, "factor": "2"}))
    assert doubled.refresh("silver_kept")[0] == "silver_kept" and both() == (10, 1)
    assert not (tmp_path / "tables" / "silver" / "kept" / "refresh").exists()

    broken = [FlowSpec.from_mapping(s, tokens) for s in SPECS[:-1]] + [FlowSpec("both", "gold", sql="SELECT nothing FROM gold_sums")]
    runner = GraphRunner(spark, root, FlowGraph(broken))
    with pytest.raises(Exception, match="nothing"):
        runner.refresh("gold_sums")
    assert both() == (10, 1) and runner.flows.read("gold_sums").first().v == 10
    land(("c", 5))
    GraphRunner(spark, root, graph_of({**tokens, "factor": "2"})).refresh("bronze_rows")
    assert both() == (20, 1)

    (tmp_path / "specs" / "bad.json").write_text('{"name": "x"}')
    with pytest.raises(ValueError, match="bad.json"):
        read_specs(spark, str(tmp_path / "specs"), tokens)
