"""Views of a rolled-up graph: threshold, loops, weights, neighbours, summaries.

All of them work on every node or edge at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import edge_id, thousands, title_label

# Fixed values
WIDEST = 11


def kept_edges(edges: DataFrame, min_frequency: int = 0) -> DataFrame:
    return edges.where(F.col("edge_frequency") >= min_frequency)


def self_loops(edges: DataFrame) -> DataFrame:
    """Activities that follow themselves."""
    loops = edges.where(F.col("source_activity") == F.col("target_activity"))
    return loops.select(F.col("source_activity").alias("activity_name")).distinct()


def edge_width(frequency: Column, most: Column) -> Column:
    """1 to 12 by the root of the share of the most frequent edge."""
    scaled = F.round(F.lit(1) + F.sqrt(frequency / F.nullif(most, F.lit(0))) * WIDEST, 1)
    return F.when(most == 0, F.lit(2.0)).otherwise(scaled)


def edge_weights(edges: DataFrame, min_frequency: int = 0) -> DataFrame:
    """Kept edges with id, label, width and loop flag; widths refer to all edges."""
    most = edges.select(F.max("edge_frequency")).scalar()
    return kept_edges(edges, min_frequency).withColumns(
        {
            "edge_id": edge_id(F.col("source_activity"), F.col("target_activity")),
            "edge_label": thousands(F.col("edge_frequency")),
            "width": edge_width(F.col("edge_frequency"), most),
            "is_self_loop": F.col("source_activity") == F.col("target_activity"),
        }
    )


def subgraph_nodes(nodes: DataFrame, edges: DataFrame, min_frequency: int = 0) -> DataFrame:
    """Nodes at a kept edge, and all start and end nodes, with their flags and label."""
    is_loop = F.col("source_activity") == F.col("target_activity")
    touched = (
        kept_edges(edges, min_frequency)
        .select(F.explode(F.array("source_activity", "target_activity")).alias("activity_name"), is_loop.alias("loop"))
        .groupBy("activity_name")
        .agg(F.bool_or("loop").alias("has_self_loop"))
    )
    is_start, is_end = F.col("start_count") > 0, F.col("end_count") > 0
    return (
        nodes.join(touched, "activity_name", "left")
        .where(F.col("has_self_loop").isNotNull() | is_start | is_end)
        .withColumns(
            {
                "has_self_loop": F.coalesce("has_self_loop", F.lit(False)),
                "is_start": is_start,
                "is_end": is_end,
                "node_label": title_label(F.col("activity_name")),
            }
        )
    )


def dfg_subgraph(nodes: DataFrame, edges: DataFrame, min_frequency: int = 0) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges left at a frequency threshold; edges are never dropped for their nodes."""
    return subgraph_nodes(nodes, edges, min_frequency), edge_weights(edges, min_frequency)


def outgoing_share(edges: DataFrame) -> DataFrame:
    """Every transition's percentage of all that leave its source, loops included.

    The total per source is a separate aggregate, so a source with very many
    targets is never gathered in one window partition.
    """
    totals = edges.groupBy("source_activity").agg(F.sum("edge_frequency").alias("outgoing"))
    share = F.when(F.col("outgoing") > 0, F.col("edge_frequency") / F.col("outgoing") * 100).otherwise(F.lit(0.0))
    return (
        edges.join(totals, "source_activity")
        .withColumns(
            {
                "outgoing_percent": share,
                "is_self_loop": F.col("source_activity") == F.col("target_activity"),
            }
        )
        .drop("outgoing")
        .orderBy("source_activity", F.desc("edge_frequency"), "target_activity")
    )


def out_degree(edges: DataFrame) -> DataFrame:
    """Number of outgoing connections of every node that has any."""
    return edges.groupBy(F.col("source_activity").alias("activity_name")).agg(F.count("*").alias("out_degree"))


def successor_rows(edges: DataFrame) -> DataFrame:
    """(activity_name, successor): every node with itself and with each node one step after it, a row each."""
    names = edges.select(
        F.col("source_activity").alias("activity_name"),
        F.explode(F.array("source_activity", "target_activity")).alias("successor"),
    )
    return names.distinct()


def successors(edges: DataFrame) -> DataFrame:
    """The same as one sorted list per node, for graphs whose nodes have few neighbours."""
    return successor_rows(edges).groupBy("activity_name").agg(F.sort_array(F.collect_list("successor")).alias("successors"))


def dim_values(nodes: DataFrame, dimension: str) -> DataFrame:
    """Sorted choices of a filter with their labels (channels are shown as words)."""
    value = F.col(dimension)
    label = title_label(value) if dimension == "channel" else value
    return (
        nodes.where(value.isNotNull())
        .select(F.lit(dimension).alias("dimension"), value.alias("value"), label.alias("label"))
        .distinct()
        .orderBy("value")
    )


def graph_summary(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: distinct activities, edge types, stores and channels."""
    edge_types = edges.select("source_activity", "target_activity").distinct().select(F.count("*"))
    return nodes.agg(
        F.count_distinct("activity_name").alias("activities"),
        F.count_distinct("store_id").alias("stores"),
        F.count_distinct("channel").alias("channels"),
    ).select("activities", edge_types.scalar().alias("edge_types"), "stores", "channels")


def frequency_steps(edges: DataFrame) -> DataFrame:
    """Thresholds 0 and powers of two up to the largest frequency, with the edges each keeps.

    Step 0 is there even without edges.
    """
    last = F.length(F.bin("edge_frequency")) - 1  # of the powers up to the frequency
    powers = F.transform(F.sequence(F.lit(0), last), lambda p: F.pow(F.lit(2.0), p).cast("bigint"))
    reached = edges.where("edge_frequency > 0").select(F.explode(powers).alias("step"))
    kept = reached.groupBy("step").agg(F.count("*").alias("edges_kept")).where(F.col("step") > 0)
    zero = edges.agg(F.count("*").alias("edges_kept")).select(F.lit(0).cast("bigint").alias("step"), "edges_kept")
    return zero.unionByName(kept).orderBy("step")
