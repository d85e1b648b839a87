"""Appends of touched cases against the full refresh; sketches that merge."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from tracelark.operators import dfg, rollup
from tracelark.operators.event_log import LOG_ORDER
from tracelark.operators.sequence import link_events
from tracelark.plans import catalogue, logs
from tracelark.session import fresh_dir, shared_dir
from tracelark.streaming import IncrementalGraph

EVENTS = (
    "case_id string, activity_name string, event_ts timestamp, resource_id string, activity_category string, "
    "event_attributes map<string,string>, event_key string, category_rank int"
)
DIMS = "case_id string, store_id string, channel string"
START = dt.datetime(2024, 1, 1)


def event(case, name, minute, key="k"):
    at = None if minute is None else START + dt.timedelta(minutes=minute)
    return (case, name, at, None, "C", {"a": name or ""}, key, 0)


def plain(df):
    names = sorted(df.columns)
    return sorted((tuple(f"{r[n]:.6g}" if isinstance(r[n], float) else r[n] for n in names) for r in df.collect()), key=repr)


def same_as_full(spark, graph, events, dims):
    linked = link_events(spark.createDataFrame(events, EVENTS), LOG_ORDER, spark.createDataFrame(dims, DIMS))
    assert plain(graph.table("gold_dfg_edges")) == plain(dfg.dfg_edges(linked, accuracy=None))
    assert plain(graph.table("gold_dfg_nodes")) == plain(dfg.dfg_nodes(linked))
    columns = ["case_id", "activity_name", "event_ts", "event_sequence", "next_activity", "next_ts", "is_end", "store_id", "channel"]
    assert plain(graph.log().select(columns)) == plain(linked.select(columns))


def appended(spark, graph, events, dims):
    return graph.append(spark.createDataFrame(events, EVENTS), spark.createDataFrame(dims, DIMS))


def test_three_appends_equal_the_full_refresh(spark):
    random.seed(3)
    names = ["A", "B", "X_RAISED", "X_RESOLVED", "C"]
    cases = [f"c{i}" for i in range(40)]
    dims = {c: (c, f"s{i % 3}" if i % 7 else None, f"ch{i % 2}") for i, c in enumerate(cases)}
    graph = IncrementalGraph(spark, fresh_dir(spark, "increment"), buckets=8)
    every = []
    for part, chosen in enumerate((cases[:20], cases[10:30], cases[:40:3] + [None])):
        rows = [
            event(c, random.choice(names), random.randrange(10_000) if random.random() > 0.05 else None, f"{part}-{i}")
            for i, c in enumerate(random.choices(chosen, k=150))
        ]
        every += rows
        done = appended(spark, graph, rows, [dims[c] for c in {r[0] for r in rows} if c])
        assert done.version == part + 1
        assert done.reopened_cases == len({r[0] for r in rows} & {r[0] for r in every[: -len(rows)]})
        same_as_full(spark, graph, every, list(dims.values()))


def test_only_touched_cases_are_read(spark):
    graph = IncrementalGraph(spark, fresh_dir(spark, "increment"), buckets=32)
    first = [event(f"c{i}", a, m) for i in range(200) for a, m in (("A", i), ("B", i + 5))]
    dims = [(f"c{i}", "s", "ch") for i in range(200)]
    done = appended(spark, graph, first, dims)
    assert done.folders_read == [] and len(graph.snapshots.current()) > 32
    # an early event for one case: its bucket alone is read and rewritten
    early = [event("c7", "EARLY", -100)]
    done = appended(spark, graph, early, [])
    assert done.reopened_cases == 1 and len(done.folders_read) == 1 and len(done.folders_left) >= 30
    same_as_full(spark, graph, first + early, dims)
    # cases never seen before: no stored event is read, whatever bucket they are in
    more = [event(f"n{i}", "A", i) for i in range(50)]
    done = appended(spark, graph, more, [(f"n{i}", "t", None) for i in range(50)])
    assert done.reopened_cases == 0 and done.folders_read == []
    same_as_full(spark, graph, first + early + more, dims + [(f"n{i}", "t", None) for i in range(50)])


def test_dimensions_that_change_move_a_case(spark):
    graph = IncrementalGraph(spark, fresh_dir(spark, "increment"), buckets=4)
    first = [event("a", "A", 0), event("a", "B", 9), event("b", "A", 3)]
    appended(spark, graph, first, [("a", "s1", "x")])
    appended(spark, graph, [event("a", "C", 11)], [("a", "s2", "x")])
    same_as_full(spark, graph, first + [event("a", "C", 11)], [("a", "s2", "x")])
    appended(spark, graph, [], [])
    same_as_full(spark, graph, first + [event("a", "C", 11)], [("a", "s2", "x")])


def test_a_failed_append_changes_nothing(spark, monkeypatch):
    from tracelark.streaming import incremental

    graph = IncrementalGraph(spark, fresh_dir(spark, "increment"), buckets=4)
    first = [event("a", "A", 0), event("a", "B", 9)]
    appended(spark, graph, first, [("a", "s1", "x")])
    with monkeypatch.context() as patched:
        patched.setattr(incremental, "nodes_of_sums", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            appended(spark, graph, [event("a", "C", 5)], [])
    same_as_full(spark, graph, first, [("a", "s1", "x")])
    appended(spark, graph, [event("a", "C", 5)], [])
    same_as_full(spark, graph, first + [event("a", "C", 5)], [("a", "s1", "x")])


@pytest.mark.parametrize("hot_rows", [None, 30, 2_000_000])
def test_long_cases_append_alike_and_nothing_else_is_left(spark, hot_rows):
    """Appends that reopen cases, some too long for one task, in buckets with others that stay as they are."""
    random.seed(8)
    names = ["A", "B", "X_RAISED", "X_RESOLVED", "Y_RAISED", "Y_RESOLVED"]
    dims = [(f"c{i}", f"s{i % 2}", None if i == 3 else "ch") for i in range(12)]
    graph = IncrementalGraph(spark, fresh_dir(spark, "increment"), buckets=3, hot_rows=hot_rows)
    others = set(os.listdir(shared_dir(spark)))
    every = []
    for part, chosen in enumerate((["c0"] * 40 + [f"c{i}" for i in range(10)], ["c0"] * 5 + ["c2", "c11", None], ["c0", "c0", "c3"])):
        rows = [event(c, random.choice(names), random.randrange(-500 * part, 500), f"{part}-{i}") for i, c in enumerate(chosen)]
        every += rows
        appended(spark, graph, rows, dims if part == 1 else [d for d in dims if d[0] in chosen])
        same_as_full(spark, graph, every, dims)
    assert not {"row_state", "row_was"} & set(graph.log().columns)
    left = {n.rsplit("-", 1)[0] for n in set(os.listdir(shared_dir(spark))) - others}
    assert not left & {"new-events", "touched", "known", "old-cases", "linked", "append"}


def test_sketches_merge_within_their_error(spark):
    k = 200
    random.seed(5)
    rows = [(f"s{i % 5}", "x" if i % 3 else None, "A", "B", int(random.lognormvariate(8, 2))) for i in range(40_000)]
    rows += [("s0", "x", "A", "C", None), ("s1", "x", "A", "D", 7), ("s2", "x", None, "D", 7)]
    start = F.lit(START).cast("timestamp")
    linked = spark.createDataFrame(rows, "store_id string, channel string, activity_name string, next_activity string, s long").select(
        F.monotonically_increasing_id().cast("string").alias("case_id"),
        "store_id",
        "channel",
        "activity_name",
        "next_activity",
        start.alias("event_ts"),
        F.timestamp_seconds(F.unix_seconds(start) + F.col("s")).alias("next_ts"),
    )
    edges = dfg.dfg_edges(linked, sketch_k=k)
    found = {(r.source_activity, r.target_activity): r for r in rollup.sketch_edge_rollup(edges, k).collect()}
    assert set(found) == {("A", "B"), ("A", "C"), ("A", "D")}
    durations = sorted(r[4] * 1000 for r in rows if r[3] == "B")
    for share, value in ((0.5, found["A", "B"].p50_transition_duration_ms), (0.95, found["A", "B"].p95_transition_duration_ms)):
        low, high = (sum(d < value for d in durations) / len(durations), sum(d <= value for d in durations) / len(durations))
        error = 2 * rollup.sketch_rank_error(k)
        assert low - error <= share <= high + error
    assert found["A", "C"].p50_transition_duration_ms is None and found["A", "D"].p95_transition_duration_ms == 7000
    # a part of the stores, and a roll-up of roll-ups
    part = rollup.sketch_edge_rollup(rollup.filter_dimensions(edges, ["s1"]), k).where("target_activity = 'D'").collect()
    assert [r.edge_frequency for r in part] == [1]


def test_the_appended_order_log_carries_only_what_is_read(spark, tmp_path):
    orders = [(i, i % 4, "OFP"[i % 3], "1-URGENT" if i % 2 else "5-LOW", START + dt.timedelta(days=i % 90)) for i in range(60)]
    spark.createDataFrame(
        orders, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string, o_orderdate timestamp"
    ).write.parquet(f"{tmp_path}/orders.parquet")
    lines = [
        (i, n, i, n, 1.0, 1.0, "RNA"[(i + n) % 3], "OF"[n % 2], START + dt.timedelta(days=(17 * i + 31 * n) % 120)) for i in range(60) for n in range(4)
    ]
    spark.createDataFrame(
        lines,
        "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    customers = [(i, i, "BUILDING") for i in range(3)]
    spark.createDataFrame(customers, "c_custkey bigint, c_nationkey int, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(i, f"NATION_{i}") for i in range(3)], "n_nationkey int, n_name string").write.parquet(f"{tmp_path}/nation.parquet")
    graph = catalogue._appended(spark, str(tmp_path))
    assert not {"event_attributes", "resource_id"} & set(graph.log().columns)
    whole = logs.order_log(spark, str(tmp_path))
    columns = [c for c in graph.log().columns if c in whole.columns]
    assert len(columns) > 8 and plain(graph.log().select(columns)) == plain(whole.select(columns))
    assert plain(graph.table("gold_dfg_nodes")) == plain(dfg.dfg_nodes(whole))
    assert plain(graph.table("gold_dfg_edges")) == plain(dfg.dfg_edges(whole, accuracy=None))
