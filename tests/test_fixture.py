"""The hand-made documents of FIXTURES.md against the values given there."""

from dataclasses import fields

import pytest
from pyspark.sql import functions as F

from tracelark.operators import checks, dfg, quality, totals
from tracelark.operators.event_log import event_log
from tracelark.operators.retail import CATEGORY_RANKS
from tracelark.plans.retail import RetailTables, typed_tables
from tracelark.session import fresh_dir
from tracelark.sources import add_ingest_columns, overwrite_table

SEQUENCES = {
    "T1": "TRANSACTION_STARTED, ITEM_SCANNED_BARCODE, ITEM_WEIGHED, WEIGHT_SCAN_REQUIRED_RAISED, "
    "WEIGHT_SCAN_REQUIRED_RESOLVED, ITEM_RETURNED, WEIGHT_SCAN_REQUIRED_RAISED, WEIGHT_SCAN_REQUIRED_RESOLVED, "
    "TENDER_APPLIED, TRANSACTION_COMPLETED",
    "T2": "TRANSACTION_STARTED, WEIGHT_SCAN_REQUIRED_RAISED, WEIGHT_SCAN_REQUIRED_RESOLVED, ITEM_VOIDED, "
    "ITEM_VOID_RAISED, TRANSACTION_VOIDED, ITEM_VOID_RESOLVED",
    "T3": "TRANSACTION_STARTED, ITEM_SCANNED_BARCODE, ITEM_SCANNED_BARCODE, PRICE_OVERRIDE_RAISED, "
    "TRANSACTION_SUSPENDED, TENDER_APPLIED",
}
SINGLE_EDGES = {
    ("STR-001", "ITEM_RETURNED", "WEIGHT_SCAN_REQUIRED_RAISED"): 10000,
    ("STR-001", "ITEM_SCANNED_BARCODE", "ITEM_WEIGHED"): 5000,
    ("STR-001", "ITEM_VOIDED", "ITEM_VOID_RAISED"): 5000,
    ("STR-001", "ITEM_VOID_RAISED", "TRANSACTION_VOIDED"): 5000,
    ("STR-001", "ITEM_WEIGHED", "WEIGHT_SCAN_REQUIRED_RAISED"): 1000,
    ("STR-001", "TENDER_APPLIED", "TRANSACTION_COMPLETED"): 15000,
    ("STR-001", "TRANSACTION_STARTED", "ITEM_SCANNED_BARCODE"): 5000,
    ("STR-001", "TRANSACTION_STARTED", "WEIGHT_SCAN_REQUIRED_RAISED"): 20000,
    ("STR-001", "TRANSACTION_VOIDED", "ITEM_VOID_RESOLVED"): 10000,
    ("STR-001", "WEIGHT_SCAN_REQUIRED_RESOLVED", "ITEM_RETURNED"): 5000,
    ("STR-001", "WEIGHT_SCAN_REQUIRED_RESOLVED", "ITEM_VOIDED"): 10000,
    ("STR-001", "WEIGHT_SCAN_REQUIRED_RESOLVED", "TENDER_APPLIED"): 5000,
    ("STR-002", "ITEM_SCANNED_BARCODE", "ITEM_SCANNED_BARCODE"): 0,
    ("STR-002", "ITEM_SCANNED_BARCODE", "PRICE_OVERRIDE_RAISED"): 10000,
    ("STR-002", "PRICE_OVERRIDE_RAISED", "TRANSACTION_SUSPENDED"): 20000,
    ("STR-002", "TRANSACTION_STARTED", "ITEM_SCANNED_BARCODE"): 0,
    ("STR-002", "TRANSACTION_SUSPENDED", "TENDER_APPLIED"): 0,
}
EXACT = {
    ("ITEM_SCANNED_BARCODE", "ITEM_WEIGHED"): 4001,
    ("WEIGHT_SCAN_REQUIRED_RESOLVED", "ITEM_RETURNED"): 4500,
    ("WEIGHT_SCAN_REQUIRED_RESOLVED", "TENDER_APPLIED"): 5100,
}
# occurrences, cases, starts, ends, mean duration
SPECIAL_NODES = {
    ("STR-001", "WEIGHT_SCAN_REQUIRED_RAISED"): (3, 2, 0, 0, 9600.0),
    ("STR-001", "WEIGHT_SCAN_REQUIRED_RESOLVED"): (3, 2, 0, 0, None),
    ("STR-001", "TRANSACTION_STARTED"): (2, 2, 2, 0, None),
    ("STR-001", "ITEM_VOID_RAISED"): (1, 1, 0, 0, 15000.0),
    ("STR-001", "ITEM_VOID_RESOLVED"): (1, 1, 0, 1, None),
    ("STR-001", "TRANSACTION_COMPLETED"): (1, 1, 0, 1, None),
    ("STR-002", "ITEM_SCANNED_BARCODE"): (2, 1, 0, 0, None),
    ("STR-002", "TENDER_APPLIED"): (1, 1, 0, 1, None),
    ("STR-002", "TRANSACTION_STARTED"): (1, 1, 1, 0, None),
}
PLAIN_NODES = [
    *[("STR-001", n) for n in ("ITEM_RETURNED", "ITEM_SCANNED_BARCODE", "ITEM_VOIDED", "ITEM_WEIGHED", "TENDER_APPLIED", "TRANSACTION_VOIDED")],
    ("STR-002", "PRICE_OVERRIDE_RAISED"),
    ("STR-002", "TRANSACTION_SUSPENDED"),
]


def stored(tables):
    """Written once, so that every test does not parse again."""
    spark = tables.transactions.sparkSession
    root = fresh_dir(spark, "fixture")
    names = [f.name for f in fields(RetailTables)]
    return RetailTables(**{n: overwrite_table(getattr(tables, n), f"{root}/{n}") for n in names})


@pytest.fixture(scope="module")
def tables(fixture_raw):
    return stored(typed_tables(fixture_raw))


@pytest.fixture(scope="module")
def all_tables(fixture_raw):
    return stored(typed_tables(fixture_raw, keep_null_ids=True))


@pytest.fixture(scope="module")
def log(spark, tables):
    return overwrite_table(tables.log(), fresh_dir(spark, "fixture-log"))


def test_row_counts(tables):
    assert [f.count() for f in (tables.transactions, tables.items, tables.incidents, tables.tender)] == [3, 6, 5, 2]


def test_typed_values(tables):
    first = tables.items.where("transaction_id = 'T1' AND line_id = 'LN-002'").first()
    assert (str(first.quantity), str(first.extended_amount), first.sequence_number) == ("1.500", "3.00", 2)
    assert tables.items.where("scan_ts = timestamp'2025-05-01 10:00:05.999'").count() == 1


def test_event_log(tables):
    events = event_log(tables.sources(), CATEGORY_RANKS)
    assert events.columns == [
        "case_id",
        "activity_name",
        "event_ts",
        "resource_id",
        "activity_category",
        "event_attributes",
        "event_sequence",
    ]
    rows = events.orderBy("case_id", "event_sequence").collect()
    assert len(rows) == 23
    for case, expected in SEQUENCES.items():
        mine = [r for r in rows if r.case_id == case]
        assert ", ".join(r.activity_name for r in mine) == expected
        assert [r.event_sequence for r in mine] == list(range(1, len(mine) + 1))


def test_attributes_and_resources(log):
    started = log.where("case_id = 'T1' AND event_sequence = 1").first()
    assert started.resource_id == "C1"
    assert started.event_attributes == {
        "store_id": "STR-001",
        "terminal_id": "STR-001-TERM-01",
        "channel": "IN_STORE_ASSISTED",
        "currency": "USD",
    }
    done = log.where("activity_name = 'TRANSACTION_COMPLETED'").first()
    assert done.event_attributes["total_amount"] == "17.48" and done.event_attributes["item_count"] == "2"
    resolved = log.where("case_id = 'T1' AND activity_name LIKE '%_RESOLVED'").orderBy("event_sequence").collect()
    assert [r.resource_id for r in resolved] == [None, "MGR-1"]
    tender = log.where("case_id = 'T1' AND activity_name = 'TENDER_APPLIED'").first()
    assert tender.event_attributes["card_brand"] is None and "card_brand" in tender.event_attributes


def test_edges(log):
    edges = dfg.dfg_edges(log).collect()
    assert len(edges) == 18
    assert sum(r.edge_frequency for r in edges) == 20
    for r in edges:
        numbers = (
            r.avg_transition_duration_ms,
            r.min_transition_duration_ms,
            r.max_transition_duration_ms,
            r.p50_transition_duration_ms,
            r.p95_transition_duration_ms,
        )
        if r.edge_frequency == 3:
            assert (r.source_activity, r.target_activity) == (
                "WEIGHT_SCAN_REQUIRED_RAISED",
                "WEIGHT_SCAN_REQUIRED_RESOLVED",
            )
            assert r.case_count == 2
            assert numbers == (pytest.approx(34000 / 3), 4000, 20000, 10000, 20000)
        else:
            expected = SINGLE_EDGES[r.store_id, r.source_activity, r.target_activity]
            assert (r.edge_frequency, r.case_count) == (1, 1)
            assert set(numbers) == {expected}


def test_exact_precision(log):
    edges = {
        (r.source_activity, r.target_activity): r.min_transition_duration_ms
        for r in dfg.dfg_edges(log, precision="milli").where("store_id = 'STR-001'").collect()
    }
    assert edges["TRANSACTION_STARTED", "ITEM_SCANNED_BARCODE"] == 5099
    for edge, expected in EXACT.items():
        assert edges[edge] == expected


def test_nodes(log):
    nodes = dfg.dfg_nodes(log).collect()
    found = {
        (r.store_id, r.activity_name): (
            r.occurrence_count,
            r.case_count,
            r.start_count,
            r.end_count,
            r.avg_activity_duration_ms,
        )
        for r in nodes
    }
    assert len(nodes) == 17
    assert found == {**SPECIAL_NODES, **{key: (1, 1, 0, 0, None) for key in PLAIN_NODES}}


@pytest.mark.parametrize("precision, expected", [("milli", 11500.0), ("second", 34000 / 3)])
def test_paired_duration(log, precision, expected):
    by_id = F.col("event_attributes")["incident_id"]
    spans = dfg.incident_duration(log, precision, pair_by=by_id)
    value = spans.where("activity_name = 'WEIGHT_SCAN_REQUIRED_RAISED'").first().avg_activity_duration_ms
    assert value == pytest.approx(expected)


def test_keeping_null_ids(spark, all_tables):
    """The broken lines collapse into one null header, which adds two events and one edge."""
    log = overwrite_table(all_tables.log(), fresh_dir(spark, "fixture-log"))
    edges = dfg.dfg_edges(log)
    assert log.count() == 25
    assert log.agg(F.count_distinct("case_id")).first()[0] == 3
    check = checks.edge_reconciliation(log, edges).first()
    assert (check.total_edge_obs, check.expected_obs) == (21, 22)
    extra = edges.where("source_activity IS NULL").first()
    assert (extra.target_activity, extra.case_count, extra.store_id) == ("TRANSACTION_STARTED", 0, None)


def test_equality_joins_lose_null_dimensions(log):
    homeless = log.withColumn("store_id", F.lit(None).cast("string"))
    safe = dfg.dfg_nodes(homeless).agg(F.sum("start_count"), F.sum("end_count"), F.count("avg_activity_duration_ms")).first()
    assert tuple(safe)[:2] == (3, 3) and safe[2] > 0
    strict = dfg.dfg_nodes(homeless, null_safe=False)
    assert tuple(strict.agg(F.sum("start_count"), F.sum("end_count"), F.count("avg_activity_duration_ms")).first()) == (0, 0, 0)


def test_checks_hold(log):
    assert checks.order_violations(log.drop("next_activity", "next_ts", "is_end")).count() == 0
    edges, nodes = dfg.dfg_edges(log), dfg.dfg_nodes(log)
    check = checks.edge_reconciliation(log, edges).first()
    assert check.total_edge_obs == check.expected_obs == 20
    assert tuple(checks.start_end_totals(log, nodes).first()) == (3, 3, 3)


def test_totals_reconcile(tables):
    rows = totals.reconcile_totals(tables.transactions, tables.items).collect()
    assert len(rows) == 3
    for row in rows:
        assert [float(v) for v in row[1:]] == [0.0] * 5


def test_quality_counts(all_tables):
    tables = all_tables
    counts = {r.rule: r.violations for r in quality.violation_counts(tables.transactions, quality.TRANSACTION_RULES).collect()}
    assert counts == {"valid_transaction_id": 1, "valid_start_ts": 1, "non_negative_total": 1, "end_after_start": 1}
    assert quality.clean_rows(tables.transactions, quality.TRANSACTION_RULES).count() == 3
    broken = quality.quarantined_rows(tables.transactions, quality.TRANSACTION_RULES).first()
    assert broken.broken_rules == ["valid_transaction_id", "valid_start_ts"]


def test_same_graph_after_shuffling_the_input(spark, fixture_lines, log):
    lines = spark.createDataFrame([(line,) for line in reversed(fixture_lines)], "raw_json string").repartition(5)
    shuffled = typed_tables(add_ingest_columns(lines, ingest_ts=F.lit("2025-05-02").cast("timestamp"))).log()
    assert sorted(map(str, dfg.dfg_edges(shuffled).collect())) == sorted(map(str, dfg.dfg_edges(log).collect()))
