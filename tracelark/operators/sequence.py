"""Order inside a case: sequence number, successor, last event.

The usual plan is one shuffle by case, one sort and one window.  A case that
holds a large part of all events would end up in a single task, so cases are
counted first (a map-side combined aggregate) and those that are too long
take another way: their rows are range-partitioned on the full order, every
range is numbered on its own, and the ranges are stitched together with one
summary row each.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import shared_dir

#: A case above this many events is numbered in ranges of about this size.
HOT_CASE_ROWS = 2_000_000
#: Keys of long cases and range summaries are broadcast if they are no more rows than this, else shuffled.
BROADCAST_ROWS = 100_000

CASE = "case_id"
LINKS = ("event_sequence", "next_activity", "next_ts", "is_end")

#: Order of a log that is already numbered.
STORED_ORDER = ("event_ts", "event_sequence")


def long_cases(cases: DataFrame, threshold: int = HOT_CASE_ROWS) -> DataFrame:
    """(case_id, n) of all cases above the threshold; usually empty.

    ``cases`` has one row per event, or per ``weight`` events.
    """
    size = F.sum("weight") if "weight" in cases.columns else F.count("*")
    return cases.groupBy(CASE).agg(size.alias("n")).where(F.col("n") > threshold)


def link_events(
    events: DataFrame,
    order: Sequence[str] = STORED_ORDER,
    dims: DataFrame | None = None,
    hot_rows: int | None = HOT_CASE_ROWS,
    probe: DataFrame | None = None,
    within: Sequence[str] = (),
) -> DataFrame:
    """Add ``event_sequence``, ``next_activity``, ``next_ts``, ``is_end`` and the case dimensions.

    ``order`` is ascending with nulls first and should be total; a log ordered
    by ``event_sequence`` keeps the numbers it has.  ``dims`` has one row per
    case and is left-joined after the window, whose partitioning and order the
    join then reuses.  ``probe`` stands in for
    ``events`` when cases are counted, see ``long_cases``; it may count too
    much, not too little.  ``hot_rows=None`` skips the count.  ``within`` names
    columns that depend on the case alone and by which the rows are already
    partitioned.
    """
    kept = events.drop(*[name for name in LINKS if name not in order and name in events.columns])
    more = (within,) if within else ()
    if not hot_rows:
        return _with_dims(_by_case(kept, order, *more), dims)
    shared_dir(kept.sparkSession)  # checkpoint() needs the folder
    hot = long_cases(probe if probe is not None else events, hot_rows).checkpoint()
    found, rows = hot.agg(F.count("*"), F.sum("n")).first()
    if not found:
        return _with_dims(_by_case(kept, order, *more), dims)

    def small(frame: DataFrame, size: int) -> DataFrame:
        return F.broadcast(frame) if size <= BROADCAST_ROWS else frame

    keys = small(hot.select(CASE), found)
    same_case = kept[CASE].eqNullSafe(hot[CASE])
    short = kept.join(keys, same_case, "left_anti")
    long = kept.join(keys, same_case, "left_semi")
    ranges = max(2, math.ceil(rows / hot_rows))
    long_dims = None
    if dims is not None:  # one row per long case
        long_dims = small(dims.join(keys, dims[CASE] == hot[CASE], "left_semi"), found)
    # a case covers adjacent ranges, so there are at most ranges + cases summary rows
    linked = _by_range(long, order, ranges, lambda summary: small(summary, ranges + found))
    return _with_dims(_by_case(short, order, *more), dims).unionByName(_with_dims(linked, long_dims))


def _with_dims(linked: DataFrame, dims: DataFrame | None) -> DataFrame:
    return linked if dims is None else linked.join(dims, CASE, "left")


def _by_case(events: DataFrame, order: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    window = Window.partitionBy(CASE, *within).orderBy(*order)
    number = F.col("event_sequence") if "event_sequence" in order else F.row_number().over(window).cast("bigint")
    return events.select(
        *[F.col(name) for name in events.columns if name != "event_sequence"],
        number.alias("event_sequence"),
        F.lead("activity_name").over(window).alias("next_activity"),
        F.lead("event_ts").over(window).alias("next_ts"),
        F.lead(F.lit(1)).over(window).isNull().alias("is_end"),
    )


def _by_range(events: DataFrame, order: Sequence[str], ranges: int, small: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The same columns for long cases, each spread over several ranges."""
    # The checkpoint pins the range of every row: were it recomputed, a new
    # sample could move the bounds between the two uses below.
    sliced = (
        events.repartitionByRange(ranges, CASE, *order)
        .withColumn("_range", F.spark_partition_id())
        .checkpoint()
    )
    inside = Window.partitionBy(CASE, "_range").orderBy(*order)
    numbered = sliced.withColumns(
        {
            "_row": F.row_number().over(inside),
            "_next_activity": F.lead("activity_name").over(inside),
            "_next_ts": F.lead("event_ts").over(inside),
        }
    )

    position = [F.col(name).alias(f"_by{i}") for i, name in enumerate(order)]
    first = F.min(F.struct(*position, "activity_name", "event_ts"))
    along = Window.partitionBy("_case").orderBy("_slice")
    summary = (
        sliced.groupBy(F.col(CASE).alias("_case"), F.col("_range").alias("_slice"))
        .agg(F.count("*").alias("_size"), first.alias("_first"))
        .select(
            "_case",
            "_slice",
            "_size",
            F.coalesce(F.sum("_size").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
            F.lead(F.col("_first.activity_name")).over(along).alias("_then_activity"),
            F.lead(F.col("_first.event_ts")).over(along).alias("_then_ts"),
            F.lead(F.lit(1)).over(along).isNull().alias("_last_slice"),
        )
    )
    match = numbered[CASE].eqNullSafe(summary["_case"]) & (numbered["_range"] == summary["_slice"])
    at_edge = F.col("_row") == F.col("_size")

    def across(inner: str, outer: str) -> Column:
        return F.when(at_edge, F.col(outer)).otherwise(F.col(inner))

    number = F.col("event_sequence") if "event_sequence" in order else F.col("_before") + F.col("_row")
    return numbered.join(small(summary), match).select(
        *[F.col(name) for name in events.columns if name != "event_sequence"],
        number.alias("event_sequence"),
        across("_next_activity", "_then_activity").alias("next_activity"),
        across("_next_ts", "_then_ts").alias("next_ts"),
        (at_edge & F.col("_last_slice")).alias("is_end"),
    )
