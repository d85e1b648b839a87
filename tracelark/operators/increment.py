"""The graph as sums, so that cases can be taken out and put in again.

Everything the edge and node tables say follows from four tables of sums:
transitions by edge and duration, cases by edge, occurrences by node, and
durations of incident pairs.  What a set of cases adds to them is computed from
those cases alone; a changed case is one taken out and one put in.
Minimum, maximum and percentiles come from the distinct durations of an edge, which
is what makes them retractable (whole seconds keep those few).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .dfg import DIMS, _merge, assemble_nodes, counted_percentiles, edge_observations, incident_changes

EDGE = ("source_activity", "target_activity")
NODE = ("activity_name", "activity_category")


def summed_columns(dims: Sequence[str] = DIMS) -> dict[str, tuple[list[str], list[str]]]:
    """Keys and sums of each table."""
    return {
        "edge_values": ([*dims, *EDGE, "duration_ms"], ["n"]),
        "edge_cases": ([*dims, *EDGE], ["case_count"]),
        "node_counts": ([*NODE, *dims], ["occurrence_count", "case_count", "start_count", "end_count"]),
        "incident_sums": ([*dims, "activity_name"], ["duration_sum", "duration_pairs"]),
    }


def graph_sums(linked: DataFrame, precision: str = "second", dims: Sequence[str] = DIMS) -> dict[str, DataFrame]:
    """The four tables for the cases of a linked log.

    With columns ``now`` and ``was`` (1 or 0) they hold what the cases add as they are now less what they added as they were;
    a row that is the same in both need not come twice.
    """
    rows = linked if "now" in linked.columns else linked.withColumns({"now": F.lit(1), "was": F.lit(0)})
    observed = edge_observations(rows, precision, dims, keep=("now", "was"))
    changed = F.col("now") != F.col("was")
    edge, node = [*dims, *EDGE], [*NODE, *dims]
    difference = F.sum(F.col("now") - F.col("was"))

    def held(now_or_was: str) -> Column:
        """Whether the case has the edge or node at all."""
        return F.when(F.col("case_id").isNotNull(), (F.col(now_or_was) > 0).cast("int")).otherwise(0)

    in_case = observed.groupBy("case_id", *edge).agg(F.sum("now").alias("now"), F.sum("was").alias("was"))
    starts, ends = F.col("event_sequence") == 1, F.col("is_end") & F.col("case_id").isNotNull()
    step = F.col("now") - F.col("was")
    per_case = rows.groupBy("case_id", *node).agg(
        F.sum("now").alias("now"),
        F.sum("was").alias("was"),
        F.sum(F.when(starts, step).otherwise(0)).alias("starts"),
        F.sum(F.when(ends, step).otherwise(0)).alias("ends"),
    )
    per_case = per_case.where(changed | (F.col("starts") != 0) | (F.col("ends") != 0))
    return {
        "edge_values": observed.where(changed).groupBy(*edge, "duration_ms").agg(difference.alias("n")),
        "edge_cases": in_case.where(changed).groupBy(*edge).agg(F.sum(held("now") - held("was")).alias("case_count")),
        "node_counts": per_case.groupBy(*node).agg(
            difference.alias("occurrence_count"),
            F.sum(held("now") - held("was")).alias("case_count"),
            F.sum("starts").alias("start_count"),
            F.sum("ends").alias("end_count"),
        ),
        "incident_sums": incident_changes(rows, precision, dims),
    }


def changed_sums(
    before: Mapping[str, DataFrame], change: Mapping[str, DataFrame], dims: Sequence[str] = DIMS
) -> dict[str, DataFrame]:
    """``before``, which may be empty, with ``change``.  Rows that come to nothing are gone."""
    result = {}
    for name, (keys, sums) in summed_columns(dims).items():
        parts = [t[name] for t in (before, change) if t]
        stacked = reduce(DataFrame.unionByName, parts)
        total = stacked.groupBy(*keys).agg(*[F.sum(s).alias(s) for s in sums])
        result[name] = total.where(reduce(lambda a, b: a | b, [F.col(s) != 0 for s in sums]))
    return result


def edges_of_sums(sums: Mapping[str, DataFrame], dims: Sequence[str] = DIMS) -> DataFrame:
    """The edge table, with exact percentiles."""
    keys = [*dims, *EDGE]
    values = sums["edge_values"]
    known = values.where(F.col("duration_ms").isNotNull())
    total = F.sum(F.col("duration_ms").cast("decimal(20,0)") * F.col("n")).cast("double")
    timed = F.sum(F.when(F.col("duration_ms").isNotNull(), F.col("n"))).cast("double")
    counts = values.groupBy(*keys).agg(
        F.sum("n").alias("edge_frequency"),
        F.try_divide(total, timed).alias("avg_transition_duration_ms"),
        F.min("duration_ms").alias("min_transition_duration_ms"),
        F.max("duration_ms").alias("max_transition_duration_ms"),
    )
    merged = _merge(keys, counts, sums["edge_cases"], counted_percentiles(known, keys))
    return merged.select(
        *keys,
        "edge_frequency",
        F.coalesce("case_count", F.lit(0)).alias("case_count"),
        "avg_transition_duration_ms",
        "min_transition_duration_ms",
        "max_transition_duration_ms",
        "p50_transition_duration_ms",
        "p95_transition_duration_ms",
    )


def nodes_of_sums(sums: Mapping[str, DataFrame], dims: Sequence[str] = DIMS) -> DataFrame:
    """The node table."""
    spans = sums["incident_sums"].select(
        *dims, "activity_name", F.try_divide("duration_sum", "duration_pairs").alias("avg_activity_duration_ms")
    )
    return assemble_nodes(sums["node_counts"], spans, dims)
