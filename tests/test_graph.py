"""Roll-ups, graph views, rules and labels on small frames."""

import pytest
from pyspark.sql import functions as F

from tracelark.functions import duration_text, numeric_or_zero, step_label, thousands, title_label
from tracelark.operators import graph, quality, rollup, totals
from tracelark.operators.quality import Rule
from tracelark.sources import ensure_database

EDGE_SCHEMA = """store_id string, channel string, source_activity string, target_activity string,
    edge_frequency bigint, case_count bigint, avg_transition_duration_ms double, min_transition_duration_ms bigint,
    max_transition_duration_ms bigint, p50_transition_duration_ms bigint, p95_transition_duration_ms bigint"""
NODE_SCHEMA = """activity_name string, store_id string, channel string, occurrence_count bigint, case_count bigint,
    start_count bigint, end_count bigint, avg_activity_duration_ms double, activity_category string"""


@pytest.fixture(scope="module")
def edges(spark):
    data = [
        ("s1", "web", "A", "B", 90, 9, 10.0, 1, 20, 10, 20),
        ("s2", "web", "A", "B", 10, 1, 30.0, 2, 40, 30, 40),
        ("s1", "app", "A", "A", 25, 5, 2.0, 0, 4, 2, 4),
        (None, "app", "B", "C", 4, 4, 8.0, 8, 8, 8, 8),
        ("s2", None, None, "A", 1, 1, 1.0, 1, 1, 1, 1),
    ]
    return spark.createDataFrame(data, EDGE_SCHEMA)


@pytest.fixture(scope="module")
def nodes(spark):
    data = [
        ("A", "s1", "web", 100, 10, 10, 0, 60.0, "X"),
        ("A", "s2", "web", 11, 2, 2, 0, None, "X"),
        ("B", "s1", "web", 94, 9, 0, 5, None, "X"),
        ("C", None, "app", 4, 4, 0, 0, None, "Y"),
        ("D", "s1", "app", 1, 1, 0, 0, None, None),
    ]
    return spark.createDataFrame(data, NODE_SCHEMA)


def test_edge_rollup_modes(edges):
    approx = rollup.edge_rollup(edges).collect()
    assert [(r.source_activity, r.target_activity, r.edge_frequency) for r in approx] == [
        ("A", "B", 100),
        ("A", "A", 25),
        ("B", "C", 4),
    ]
    assert (approx[0].avg_transition_duration_ms, approx[0].p50_transition_duration_ms) == (20.0, 20.0)
    assert (approx[0].min_transition_duration_ms, approx[0].max_transition_duration_ms, approx[0].case_count) == (1, 40, 10)
    assert rollup.edge_rollup(edges, "weighted").first().avg_transition_duration_ms == 12.0
    with pytest.raises(ValueError):
        rollup.edge_rollup(edges, "other")


def test_node_rollup_counts_missing_durations_as_zero(nodes):
    approx = {r.activity_name: r for r in rollup.node_rollup(nodes).collect()}
    assert set(approx) == {"A", "B", "C"}  # no category, no row
    assert (approx["A"].occurrence_count, approx["A"].avg_activity_duration_ms) == (111, 30.0)
    counted = nodes.withColumn("duration_pairs", nodes.occurrence_count)
    weighted = {r.activity_name: r for r in rollup.node_rollup(counted, "weighted").collect()}
    assert weighted["A"].avg_activity_duration_ms == 60.0 and weighted["B"].avg_activity_duration_ms is None


def test_filters(edges):
    assert rollup.filter_dimensions(edges).count() == 5
    assert rollup.filter_dimensions(edges, ["s1", "s2"]).count() == 4
    assert rollup.filter_dimensions(edges, ["s1"], ["app"]).count() == 1


def test_subgraph(nodes, edges):
    node_totals, edge_totals = rollup.node_rollup(nodes), rollup.edge_rollup(edges)
    kept_nodes, kept_edges = graph.dfg_subgraph(node_totals, edge_totals, 50)
    assert [(r.edge_id, r.edge_label, r.width, r.is_self_loop) for r in kept_edges.collect()] == [("A→B", "100", 12.0, False)]
    assert {r.activity_name: (r.is_start, r.is_end, r.has_self_loop) for r in kept_nodes.collect()} == {
        "A": (True, False, False),
        "B": (False, True, False),
    }
    # above every edge only start and end nodes stay
    assert {r.activity_name for r in graph.subgraph_nodes(node_totals, edge_totals, 1000).collect()} == {"A", "B"}
    assert {r.activity_name for r in graph.subgraph_nodes(node_totals, edge_totals).collect()} == {"A", "B", "C"}
    loops = {r.activity_name for r in graph.subgraph_nodes(node_totals, edge_totals).where("has_self_loop").collect()}
    assert loops == {r.activity_name for r in graph.self_loops(edge_totals).collect()} == {"A"}


def test_widths(edges):
    widths = {(r.source_activity, r.target_activity): r.width for r in graph.edge_weights(rollup.edge_rollup(edges)).collect()}
    assert widths == {("A", "B"): 12.0, ("A", "A"): 6.5, ("B", "C"): 3.2}
    still = graph.edge_weights(rollup.edge_rollup(edges.withColumn("edge_frequency", F.lit(0).cast("bigint"))))
    assert {r.width for r in still.collect()} == {2.0}


def test_neighbours(edges):
    edge_totals = rollup.edge_rollup(edges)
    shares = {(r.source_activity, r.target_activity): r.outgoing_percent for r in graph.outgoing_share(edge_totals).collect()}
    assert shares == {("A", "B"): 80.0, ("A", "A"): 20.0, ("B", "C"): 100.0}
    assert {r.activity_name: r.out_degree for r in graph.out_degree(edge_totals).collect()} == {"A": 2, "B": 1}
    assert {r.activity_name: r.successors for r in graph.successors(edge_totals).collect()} == {"A": ["A", "B"], "B": ["B", "C"]}


def test_steps(edges):
    edge_totals = rollup.edge_rollup(edges)
    steps = [(r.step, r.edges_kept) for r in graph.frequency_steps(edge_totals).collect()]
    assert steps == [(0, 3), (1, 3), (2, 3), (4, 3), (8, 2), (16, 2), (32, 1), (64, 1)]
    assert [tuple(r) for r in graph.frequency_steps(edge_totals.where("false")).collect()] == [(0, 0)]


def test_summary_and_choices(nodes, edges):
    assert graph.graph_summary(nodes, edges).first().asDict() == {"activities": 4, "edge_types": 4, "stores": 2, "channels": 2}
    assert [r.value for r in graph.dim_values(nodes, "store_id").collect()] == ["s1", "s2"]
    assert [(r.value, r.label) for r in graph.dim_values(nodes, "channel").collect()] == [("app", "App"), ("web", "Web")]


def test_labels(spark):
    row = spark.range(1).select(
        title_label(F.lit("ITEM_SCANNED_QR_CODE")),
        thousands(F.lit(1234567)),
        duration_text(F.lit(None).cast("bigint")),
        duration_text(F.lit(12300)),
        duration_text(F.lit(245999)),
        duration_text(F.lit(-5000)),
        step_label(F.lit(512)),
        step_label(F.lit(262144)),
        step_label(F.lit(2500000)),
    ).first()
    assert tuple(row) == ("Item Scanned Qr Code", "1,234,567", "—", "12.3s", "4m 5s", "-5.0s", "512", "262k", "2M")


def test_numbers_from_text(spark):
    frame = spark.createDataFrame([("12", "x"), (None, "2.5")], "a string, b string")
    got = numeric_or_zero(frame, {"a": "bigint", "b": "double"}).collect()
    assert [tuple(r) for r in got] == [(12, 0.0), (0, 2.5)]


def test_unknown_breaks_a_rule(spark):
    frame = spark.createDataFrame([(1, 5), (None, 5), (2, None), (3, -1)], "id int, v int")
    rules = [Rule("has_id", "id IS NOT NULL"), Rule("positive", "v > 0"), Rule("small", "v < 3", "warn")]
    counts = {(r.rule, r.action): r.violations for r in quality.violation_counts(frame, rules).collect()}
    assert counts == {("has_id", "drop"): 1, ("positive", "drop"): 2, ("small", "warn"): 3}
    assert [r.id for r in quality.clean_rows(frame, rules).collect()] == [1]
    broken = {r.id: r.broken_rules for r in quality.quarantined_rows(frame, rules).collect()}
    assert broken == {None: ["has_id"], 2: ["positive"], 3: ["positive"]}


def test_line_totals(spark):
    money = "decimal(12,2)"
    lines = spark.createDataFrame(
        [
            ("t", "10.00", "1.00", False, False, "Bakery"),
            ("t", "5.10", "0.00", False, True, "Deli"),
            ("t", "7.00", "2.00", True, False, "Bakery"),
            ("t", "3.00", "0.50", False, False, "Grocery"),
            ("u", "-9.00", "0.00", False, False, None),
        ],
        "transaction_id string, e string, d string, is_void boolean, is_return boolean, department string",
    ).select("*", F.col("e").cast(money).alias("extended_amount"), F.col("d").cast(money).alias("line_discount_amount"))
    got = {r.transaction_id: tuple(float(v) for v in r[1:]) for r in totals.line_totals(lines).collect()}
    assert got == {"t": (18.1, 1.5, 1.25, 2.0, 19.35), "u": (-9.0, 0.0, 0.0, 1.0, 0.0)}


def test_first_product_wins_and_unknown_is_null(spark):
    lines = spark.createDataFrame([("t", "s1"), ("t", "s9")], "transaction_id string, sku string").withColumn("department", F.lit("old"))
    products = spark.createDataFrame([("s1", "Z"), ("s1", "B")], "sku string, department string")
    got = {r.sku: r.department for r in totals.with_product_department(lines, products).collect()}
    assert got == {"s1": "B", "s9": None}


def test_database(spark):
    ensure_database(spark, "tracelark_test")
    assert spark.catalog.databaseExists("tracelark_test")
    spark.sql("DROP DATABASE tracelark_test")


def test_steps_go_up_to_the_largest_frequency(spark):
    edges = spark.createDataFrame([(1,), (5_000_000,), (2**40,), (0,)], "edge_frequency bigint")
    found = {r.step: r.edges_kept for r in graph.frequency_steps(edges).collect()}
    assert max(found) == 2**40 and found[0] == 4 and found[1] == 3 and found[2**22] == 2 and found[2**23] == 1 and len(found) == 42


def test_exact_percentiles_of_many_durations(spark):
    from pyspark.sql import functions as F

    from tracelark.operators import dfg

    events = spark.range(1_000_000).select(
        F.col("id").alias("case_id"),
        F.lit("A").alias("activity_name"),
        F.lit("B").alias("next_activity"),
        F.timestamp_seconds(F.lit(0)).alias("event_ts"),
        F.timestamp_seconds("id").alias("next_ts"),
    )
    row = rollup.exact_edge_rollup(events).first()
    assert (row.p50_transition_duration_ms, row.p95_transition_duration_ms) == (499_999_000, 949_999_000)
    observed = spark.createDataFrame([("e", d) for d in (None, 5, 5, 7, 9)] + [("f", 3), (None, 8)], "edge string, duration_ms bigint")
    found = {r.edge: (r.p50_transition_duration_ms, r.p95_transition_duration_ms) for r in dfg._exact_percentiles(observed, ["edge"]).collect()}
    assert found == {"e": (5, 9), "f": (3, 3), None: (8, 8)}


def test_layout_lets_most_of_the_table_be_skipped(spark):
    """Row-group statistics of the stored edges rule most of the table out for one store and channel."""
    import glob
    import random

    import pyarrow.parquet as pq
    from tracelark.session import fresh_dir
    from tracelark.sources.tables import overwrite_graph_table

    random.seed(1)
    rows = [(f"s{s:02d}", f"c{c}", f"A{i}", f"B{i}", s + c + i) for s in range(40) for c in range(4) for i in range(50)]
    random.shuffle(rows)
    edges = spark.createDataFrame(rows, "store_id string, channel string, source_activity string, target_activity string, n int")
    path = fresh_dir(spark, "layout")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        overwrite_graph_table(edges, path, ["store_id", "channel", "source_activity", "target_activity"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    whole = needed = 0
    for file in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            store = meta.row_group(g).column(0).statistics
            whole += 1
            needed += store.min <= "s07" <= store.max
    assert whole >= 12 and needed <= 3
