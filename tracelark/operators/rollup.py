"""Filtering the graph by its dimensions and rolling it up over them.

``approx`` averages the averages and percentiles of the parts as they are,
``weighted`` weighs a mean by the number of values behind it (exact for means,
not for percentiles): transitions for edges, raised/resolved pairs for nodes,
whose table must have been built with ``pair_counts``.  ``sketch_edge_rollup`` merges
the sketches of an edge table built with ``sketch_k``: its percentiles are those of all durations, within the
sketch's rank error, without the events.  An exact roll-up goes back to the events: ``dfg_edges`` and
``dfg_nodes`` on a filtered linked log with ``dims=()``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import numeric_or_zero
from .dfg import dfg_edges, dfg_nodes

MODES = ("approx", "weighted")
NODE_COUNTS = ("occurrence_count", "case_count", "start_count", "end_count")
DURATION = "avg_activity_duration_ms"
#: Size of the sketches of durations in an edge table: ranks within half a percent.
SKETCH_K = 1000

_EDGE_TYPES = {
    "edge_frequency": "bigint",
    "case_count": "bigint",
    "avg_transition_duration_ms": "double",
    "min_transition_duration_ms": "bigint",
    "max_transition_duration_ms": "bigint",
    "p50_transition_duration_ms": "bigint",
    "p95_transition_duration_ms": "bigint",
}
_NODE_TYPES = {**{name: "bigint" for name in NODE_COUNTS}, DURATION: "double"}


def filter_dimensions(
    df: DataFrame, stores: Iterable[str] | None = None, channels: Iterable[str] | None = None
) -> DataFrame:
    """Rows of the chosen stores and channels; nothing chosen means all of them."""
    for column, chosen in (("store_id", stores), ("channel", channels)):
        values = list(chosen or ())
        if values:
            df = df.where(F.col(column).isin(values))
    return df


def load_edges(edges: DataFrame) -> DataFrame:
    """Edge table with numbers read leniently, most frequent first."""
    return numeric_or_zero(edges, _EDGE_TYPES).orderBy(
        F.desc("edge_frequency"), "store_id", "channel", "source_activity", "target_activity"
    )


def load_nodes(nodes: DataFrame) -> DataFrame:
    """Node table with numbers read leniently (so a missing duration is 0), most frequent first."""
    return numeric_or_zero(nodes, _NODE_TYPES).orderBy(
        F.desc("occurrence_count"), "store_id", "channel", "activity_name", "activity_category"
    )


def edge_rollup(edges: DataFrame, mode: str = "approx") -> DataFrame:
    """One row per (source, target), most frequent first."""
    _check(mode)
    numbers = numeric_or_zero(edges, _EDGE_TYPES) if mode == "approx" else edges
    weight = F.col("edge_frequency")

    def mean(name: str) -> Column:
        return (F.avg(name) if mode == "approx" else _weighted(name, weight)).alias(name)

    return (
        numbers.where(F.col("source_activity").isNotNull() & F.col("target_activity").isNotNull())
        .groupBy("source_activity", "target_activity")
        .agg(
            F.sum("edge_frequency").alias("edge_frequency"),
            F.sum("case_count").alias("case_count"),
            mean("avg_transition_duration_ms"),
            F.min("min_transition_duration_ms").alias("min_transition_duration_ms"),
            F.max("max_transition_duration_ms").alias("max_transition_duration_ms"),
            mean("p50_transition_duration_ms"),
            mean("p95_transition_duration_ms"),
        )
        .orderBy(F.desc("edge_frequency"), "source_activity", "target_activity")
    )


def sketch_edge_rollup(edges: DataFrame, sketch_k: int = SKETCH_K) -> DataFrame:
    """The ``weighted`` roll-up with percentiles from the merged sketches of the edge rows.

    A percentile's rank is off by no more than ``sketch_rank_error(sketch_k)`` of all durations, with the
    confidence stated there; up to about ``sketch_k`` durations it is exact.
    ``duration_sketch`` is the merged sketch, so that roll-ups can be rolled up again.
    """
    keys = ["source_activity", "target_activity"]
    means = edge_rollup(edges, "weighted").drop("p50_transition_duration_ms", "p95_transition_duration_ms")
    known = edges.where(F.col(keys[0]).isNotNull() & F.col(keys[1]).isNotNull())
    merged = known.groupBy(*keys).agg(F.kll_merge_agg_bigint("duration_sketch", sketch_k).alias("duration_sketch"))
    # an edge without any duration has an empty sketch, which has no quantiles
    some = F.kll_sketch_get_n_bigint("duration_sketch") > 0
    percentiles = merged.select(
        *keys,
        *[
            F.when(some, F.kll_sketch_get_quantile_bigint("duration_sketch", F.lit(q))).alias(f"p{name}_transition_duration_ms")
            for q, name in ((0.5, 50), (0.95, 95))
        ],
        "duration_sketch",
    )
    return means.join(percentiles, keys).orderBy(F.desc("edge_frequency"), *keys)


def sketch_rank_error(sketch_k: int = SKETCH_K) -> float:
    """The error of ranks of a KLL sketch of this size, as a share of all values, that holds for 99 of 100 sketches."""
    return 2.296 / sketch_k**0.9021


def node_rollup(nodes: DataFrame, mode: str = "approx") -> DataFrame:
    """One row per (activity, category), most frequent first."""
    _check(mode)
    numbers = numeric_or_zero(nodes, _NODE_TYPES) if mode == "approx" else nodes
    duration = F.avg(DURATION) if mode == "approx" else _weighted(DURATION, F.col("duration_pairs"))
    return (
        numbers.where(F.col("activity_name").isNotNull() & F.col("activity_category").isNotNull())
        .groupBy("activity_name", "activity_category")
        .agg(*[F.sum(name).alias(name) for name in NODE_COUNTS], duration.alias(DURATION))
        .orderBy(F.desc("occurrence_count"), "activity_name", "activity_category")
    )


def exact_edge_rollup(linked: DataFrame, stores=None, channels=None, **options) -> DataFrame:
    """The edge roll-up recomputed from the events, with exact percentiles and case counts."""
    edges = dfg_edges(filter_dimensions(linked, stores, channels), dims=(), accuracy=None, **options)
    return edges.orderBy(F.desc("edge_frequency"), "source_activity", "target_activity")


def exact_node_rollup(linked: DataFrame, stores=None, channels=None, **options) -> DataFrame:
    nodes = dfg_nodes(filter_dimensions(linked, stores, channels), dims=(), **options)
    return nodes.orderBy(F.desc("occurrence_count"), "activity_name", "activity_category")


def _weighted(name: str, weight: Column) -> Column:
    known = F.when(F.col(name).isNotNull(), weight)
    return F.try_divide(F.sum(F.col(name) * weight), F.sum(known))


def _check(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
