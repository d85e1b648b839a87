"""Order inside cases: both plans against plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tracelark.operators import checks, dfg, variants
from tracelark.operators import sequence
from tracelark.operators.sequence import link_events, long_cases

START = dt.datetime(2024, 1, 1)
SCHEMA = "case_id string, activity_name string, event_ts timestamp, category_rank int, event_key string"
ORDER = ("event_ts", "category_rank", "activity_name", "event_key")


def random_events(seed=1, rows=400, hot=0.4):
    """A hot case, a null case, ties in time, null times and null labels."""
    rng = random.Random(seed)
    out = []
    for i in range(rows):
        case = "hot" if rng.random() < hot else rng.choice(["a", "b", "c", "d", None])
        ts = None if rng.random() < 0.03 else START + dt.timedelta(seconds=rng.randrange(40), milliseconds=rng.randrange(1000) if rng.random() < 0.5 else 0)
        label = None if rng.random() < 0.03 else rng.choice("XYZ") + rng.choice(["", "_RAISED", "_RESOLVED"])
        out.append((case, label, ts, rng.choice([None, 0, 1, 2]), f"{i:05d}"))
    return out


def nulls_first(row):
    return tuple((value is not None, value if value is not None else 0) for value in row)


def by_hand(events):
    cases = {}
    for e in events:
        cases.setdefault(e[0], []).append(e)
    out = []
    for case, rows in cases.items():
        rows.sort(key=lambda e: nulls_first((e[2], e[3], e[1], e[4])))
        for i, e in enumerate(rows):
            after = rows[i + 1] if i + 1 < len(rows) else None
            out.append((case, e[1], e[2], e[4], i + 1, after and after[1], after and after[2], after is None))
    return sorted(out, key=str)


def linked_rows(df):
    names = ["case_id", "activity_name", "event_ts", "event_key", "event_sequence", "next_activity", "next_ts", "is_end"]
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)


@pytest.fixture(scope="module")
def events():
    return random_events()


@pytest.fixture(scope="module")
def frame(spark, events):
    return spark.createDataFrame(events, SCHEMA).repartition(6)


@pytest.mark.parametrize("hot_rows", [None, 1_000_000, 60, 20])
def test_both_plans_number_alike(frame, events, hot_rows):
    assert linked_rows(link_events(frame, ORDER, hot_rows=hot_rows)) == by_hand(events)


def test_only_long_cases_take_the_range_plan(frame, events):
    hot = sum(e[0] == "hot" for e in events)
    assert [(r.case_id, r.n) for r in long_cases(frame, 100).collect()] == [("hot", hot)]
    weighted = frame.select("case_id", F.lit(2).alias("weight"))
    assert max(r.n for r in long_cases(weighted, 100).collect()) == 2 * hot


@pytest.mark.parametrize("bound", [10, 100_000])
def test_any_number_of_long_cases_takes_the_range_plan(spark, monkeypatch, bound):
    """Whether their keys are broadcast or shuffled; the plain window is left with the short case only."""
    monkeypatch.setattr(sequence, "BROADCAST_ROWS", bound)
    plain = []
    by_case = sequence._by_case
    monkeypatch.setattr(sequence, "_by_case", lambda events, order: (plain.append(events), by_case(events, order))[1])
    rows = [(f"c{c}", f"A{i}", START, 0, f"{i:04d}") for c in range(1200) for i in range(4)] + [("short", "A", START, 0, "0")]
    found = linked_rows(link_events(spark.createDataFrame(rows, SCHEMA), ORDER, hot_rows=3))
    assert found == by_hand(rows)
    assert [r.case_id for r in plain[0].select("case_id").collect()] == ["short"]


def test_a_case_of_equal_times_is_split_too(spark):
    same = [("hot", "A", START, 0, f"{i:04d}") for i in range(300)]
    linked = link_events(spark.createDataFrame(same, SCHEMA), ORDER, hot_rows=50)
    assert linked_rows(linked) == by_hand(same)


def test_dimensions_follow_both_plans(spark, frame):
    dims = spark.createDataFrame([("hot", "s1"), ("a", "s2")], "case_id string, store_id string")
    rows = link_events(frame, ORDER, dims, hot_rows=60).select("case_id", "store_id").distinct().collect()
    assert {tuple(r) for r in rows} == {("hot", "s1"), ("a", "s2"), ("b", None), ("c", None), ("d", None), (None, None)}


def test_stored_numbers_are_kept(frame):
    numbered = link_events(frame.where("event_ts IS NOT NULL"), ORDER, hot_rows=None)
    gaps = numbered.withColumn("event_sequence", F.col("event_sequence") * 10)
    for hot_rows in (None, 50):
        again = link_events(gaps, hot_rows=hot_rows)
        pairs = again.where("is_end OR event_sequence = 10").groupBy("case_id").agg(F.count("*"), F.max("event_sequence"))
        for case, rows, last in pairs.collect():
            assert (rows, last) == (2, gaps.where(F.col("case_id").eqNullSafe(case)).count() * 10)


def test_order_check_finds_violations_in_both_plans(spark):
    rows = [("a", "X", START + dt.timedelta(seconds=-i if i % 3 == 0 else i), i) for i in range(1, 31)]
    log = spark.createDataFrame(rows, "case_id string, activity_name string, event_ts timestamp, event_sequence int")
    expected = sum(b[2] < a[2] for a, b in zip(rows, rows[1:]))
    for hot_rows in (None, 8):
        found = checks.order_violations(log, hot_rows=hot_rows).collect()
        assert [tuple(r) for r in found] == [("a", expected)]


def test_edges_and_spans_from_both_plans(frame, events):
    """Edges, distinct cases and the pairs of raised and resolved events, counted by hand."""
    plain = link_events(frame, ORDER, hot_rows=None)
    split = link_events(frame, ORDER, hot_rows=60)
    observed = [r for r in by_hand(events) if r[5] is not None]
    edges = {}
    for r in observed:
        edges.setdefault((r[1], r[5]), []).append(r)
    for linked in (plain, split):
        got = {(r.source_activity, r.target_activity): r for r in dfg.dfg_edges(linked, dims=()).collect()}
        assert set(got) == set(edges)
        for key, rows in edges.items():
            times = sorted(
                (int((r[6] - START).total_seconds() // 1) - int((r[2] - START).total_seconds() // 1)) * 1000
                for r in rows
                if r[2] and r[6]
            )
            assert got[key].edge_frequency == len(rows)
            assert got[key].case_count == len({r[0] for r in rows} - {None})
            assert got[key].min_transition_duration_ms == (times[0] if times else None)
            assert got[key].max_transition_duration_ms == (times[-1] if times else None)
            if times:
                assert got[key].avg_transition_duration_ms == pytest.approx(sum(times) / len(times))
                assert got[key].p50_transition_duration_ms == times[(len(times) + 1) // 2 - 1]

    spans = {}
    for a in events:
        for b in events:
            if a[0] is not None and a[0] == b[0] and a[1] and b[1] and a[1].endswith("_RAISED") and b[1] == a[1][:2].rstrip("_") + "_RESOLVED":
                pair = spans.setdefault(a[1], [])
                if a[2] and b[2]:
                    pair.append((b[2] - a[2]).total_seconds() * 1000)
    got = {r.activity_name: r.avg_activity_duration_ms for r in dfg.incident_duration(split, "milli", dims=()).collect()}
    assert set(got) == set(spans)
    for name, values in spans.items():
        assert got[name] == pytest.approx(sum(values) / len(values))


def test_variants_by_hand(spark):
    rng = random.Random(3)
    rows = [
        (f"c{case:02d}" if case else None, rng.choice("AB"), START + dt.timedelta(seconds=i), 0, str(i))
        for case in range(40)
        for i in range(rng.randrange(1, 4))
    ]
    counted = {}
    rows += [(None, "ONLY", START + dt.timedelta(seconds=9), 0, "9")]
    for case in sorted({r[0] for r in rows}, key=str):
        variant = " → ".join(r[1] for r in rows if r[0] == case)
        counted.setdefault(variant, []).append(case)
    expected = sorted(((len(c), c[0] or "", v) for v, c in counted.items()), key=lambda x: (-x[0], x[1]))
    linked = link_events(spark.createDataFrame(rows, SCHEMA), ORDER, hot_rows=None)
    got = variants.top_variants(linked, k=50).collect()
    assert [(r.case_count, r.variant) for r in got] == [(n, v) for n, _, v in expected]
    assert [r.variant for r in variants.top_variants(linked, k=3).collect()] == [v for _, _, v in expected[:3]]
    assert variants.top_variants(linked.where("false")).count() == 0
