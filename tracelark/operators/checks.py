"""Consistency checks of a log and its graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .sequence import link_events


def order_violations(log: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Cases with an event earlier than the one before it by number; none are expected."""
    options = {} if hot_rows is None else {"hot_rows": hot_rows}
    by_number = link_events(log, ("event_sequence",), **options)
    return (
        by_number.where(F.col("next_ts") < F.col("event_ts"))
        .groupBy("case_id")
        .agg(F.count("*").alias("violations"))
        .orderBy(F.desc("violations"), "case_id")
    )


def label_counts(log: DataFrame) -> DataFrame:
    return (
        log.groupBy("activity_name", "activity_category")
        .agg(F.count("*").alias("occurrences"))
        .orderBy("activity_category", "activity_name")
    )


def edge_reconciliation(log: DataFrame, edges: DataFrame) -> DataFrame:
    """Edge frequencies must add up to events minus cases."""
    expected = log.agg((F.count("*") - F.count_distinct("case_id")).alias("n"))
    return edges.agg(F.coalesce(F.sum("edge_frequency"), F.lit(0)).alias("total_edge_obs")).select(
        "total_edge_obs", expected.scalar().alias("expected_obs")
    )


def start_end_totals(log: DataFrame, nodes: DataFrame) -> DataFrame:
    """Starts, ends and cases must be equally many."""
    cases = log.agg(F.count_distinct("case_id").alias("n"))
    return nodes.agg(
        F.sum("start_count").alias("total_starts"), F.sum("end_count").alias("total_ends")
    ).select("total_starts", "total_ends", cases.scalar().alias("total_cases"))


def dimension_breakdown(nodes: DataFrame) -> DataFrame:
    return (
        nodes.groupBy("store_id", "channel")
        .agg(
            F.count_distinct("activity_name").alias("activities"),
            F.sum("occurrence_count").alias("total_occurrences"),
        )
        .orderBy("store_id", "channel")
    )
