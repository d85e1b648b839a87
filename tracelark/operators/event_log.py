"""One domain-neutral event log out of any number of sources.

A source is a frame and the events each of its rows gives.  The rows are
fanned out by an event number, not by building whole event structs, so column
pruning still reaches every source scan and an attribute nobody reads is never
built.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import attribute_map, category_rank
from .sequence import HOT_CASE_ROWS, link_events

LOG_COLUMNS = (
    "case_id",
    "activity_name",
    "event_ts",
    "resource_id",
    "activity_category",
    "event_attributes",
    "event_sequence",
)
#: Time, then category priority, then label; the source key makes the order total.
LOG_ORDER = ("event_ts", "category_rank", "activity_name", "event_key")


@dataclass(frozen=True)
class Event:
    """An event given by a source row; ``when`` restricts it to some rows."""

    activity: Column
    ts: Column
    category: str
    resource: Column | None = None
    attributes: Mapping[str, Column] = field(default_factory=dict)
    when: Column | None = None


@dataclass(frozen=True)
class EventSource:
    """``case`` names the case of a row, ``key`` tells rows of one case apart.

    ``count_in`` may name a frame that has the case column too, no fewer rows
    per case, and is cheaper to scan (say, from before de-duplication).
    """

    frame: DataFrame
    case: Column
    key: Column
    events: Sequence[Event]
    count_in: DataFrame | None = None


def source_events(source: EventSource) -> DataFrame:
    """Un-numbered events of one source, in a single scan of it."""
    count = len(source.events)
    number = F.explode(F.array(*[F.lit(i) for i in range(count)])) if count > 1 else F.lit(0)
    fanned = source.frame.select("*", number.alias("_event"))

    def choose(columns: Sequence[Column]) -> Column:
        if count == 1:
            return columns[0]
        picked = F.when(F.col("_event") == 0, columns[0])
        for i, column in enumerate(columns[1:-1], start=1):
            picked = picked.when(F.col("_event") == i, column)
        return picked.otherwise(columns[-1])

    events = source.events
    if any(e.when is not None for e in events):
        fanned = fanned.where(choose([F.lit(True) if e.when is None else e.when for e in events]))
    no_resource = F.lit(None).cast("string")
    return fanned.select(
        source.case.alias("case_id"),
        choose([e.activity for e in events]).alias("activity_name"),
        choose([e.ts for e in events]).alias("event_ts"),
        choose([no_resource if e.resource is None else e.resource for e in events]).alias("resource_id"),
        choose([F.lit(e.category) for e in events]).alias("activity_category"),
        choose([attribute_map(e.attributes) for e in events]).alias("event_attributes"),
        source.key.cast("string").alias("event_key"),
    )


def union_events(sources: Sequence[EventSource]) -> DataFrame:
    return reduce(DataFrame.unionByName, [source_events(s) for s in sources])


def case_sizes(sources: Sequence[EventSource]) -> DataFrame:
    """Upper bounds for the number of events of each case: (case_id, weight) per source row."""
    parts = [
        (s.frame if s.count_in is None else s.count_in).select(
            s.case.alias("case_id"), F.lit(len(s.events)).alias("weight")
        )
        for s in sources
    ]
    return reduce(DataFrame.unionByName, parts)


def ranked_events(sources: Sequence[EventSource], ranks: Mapping[str, int]) -> DataFrame:
    """Events of all sources with the category priority used to break ties in time."""
    return union_events(sources).withColumn("category_rank", category_rank(F.col("activity_category"), ranks))


def linked_log(
    sources: Sequence[EventSource],
    ranks: Mapping[str, int],
    dims: DataFrame | None = None,
    hot_rows: int | None = HOT_CASE_ROWS,
) -> DataFrame:
    """The event log plus successor, end flag and case dimensions, from one pass by case."""
    linked = link_events(ranked_events(sources, ranks), LOG_ORDER, dims, hot_rows, case_sizes(sources))
    return linked.drop("category_rank", "event_key")


def event_log(
    sources: Sequence[EventSource], ranks: Mapping[str, int], hot_rows: int | None = HOT_CASE_ROWS
) -> DataFrame:
    return linked_log(sources, ranks, hot_rows=hot_rows).select(*LOG_COLUMNS)


def stream_events(
    sources: Sequence[EventSource], ranks: Mapping[str, int], delay: str = "2 hours"
) -> DataFrame:
    """Un-numbered events of streaming sources, each under an event-time watermark.

    Numbers need whole cases; they are given by the batch refresh over the
    table this stream appends to.
    """
    streams = [source_events(s).withWatermark("event_ts", delay) for s in sources]
    events = reduce(DataFrame.unionByName, streams)
    return events.withColumn("category_rank", category_rank(F.col("activity_category"), ranks))
