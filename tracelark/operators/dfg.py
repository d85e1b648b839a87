"""The directly-follows graph of a linked log.

Everything starts from ``link_events`` output: successor and end flag are
already on each event, so edges, nodes, starts and ends are plain aggregates.
Distinct case counts go through a first aggregate per case, which is combined
map-side and, right after the window by case, needs no further shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import elapsed_ms, epoch_ms

DIMS = ("store_id", "channel")
RAISED = "_RAISED"
RESOLVED = "_RESOLVED"
PERCENTILE_ACCURACY = 10_000


def edge_observations(
    linked: DataFrame, precision: str = "second", dims: Sequence[str] = DIMS, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per pair of consecutive events; needs a label on the second one.  ``keep`` names further columns."""
    return linked.where(F.col("next_activity").isNotNull()).select(
        "case_id",
        *dims,
        F.col("activity_name").alias("source_activity"),
        F.col("next_activity").alias("target_activity"),
        elapsed_ms(F.col("event_ts"), F.col("next_ts"), precision).alias("duration_ms"),
        *keep,
    )


def dfg_edges(
    linked: DataFrame,
    precision: str = "second",
    dims: Sequence[str] = DIMS,
    accuracy: int | None = PERCENTILE_ACCURACY,
    sketch_k: int | None = None,
) -> DataFrame:
    """Frequency, case count and duration statistics per edge and dimensions.

    Percentiles have a rank error of n/``accuracy``; None makes them exact.
    ``sketch_k`` adds ``duration_sketch``, a KLL sketch of that size of the
    edge's durations, from which a roll-up can tell percentiles of all of them.

    Counting distinct cases next to a percentile would keep a percentile
    buffer for every case and edge, so the two are aggregated apart and their
    (small) results merged by key, nulls included.
    """
    observed = edge_observations(linked, precision, dims)
    keys = [*dims, "source_activity", "target_activity"]
    per_case = observed.groupBy("case_id", *keys).agg(
        F.count("*").alias("n"),
        F.count("duration_ms").alias("timed"),
        F.sum("duration_ms").alias("total"),
        F.min("duration_ms").alias("low"),
        F.max("duration_ms").alias("high"),
    )
    counts = per_case.groupBy(*keys).agg(
        F.sum("n").alias("edge_frequency"),
        F.count("case_id").alias("case_count"),
        F.try_divide(F.sum("total"), F.sum("timed")).alias("avg_transition_duration_ms"),
        F.min("low").alias("min_transition_duration_ms"),
        F.max("high").alias("max_transition_duration_ms"),
    )
    if sketch_k is not None:
        sketches = observed.groupBy(*keys).agg(F.kll_sketch_agg_bigint("duration_ms", sketch_k).alias("duration_sketch"))
        counts = _merge(keys, counts, sketches)
    if accuracy is None:
        return _merge(keys, counts, _exact_percentiles(observed, keys))
    percentiles = observed.groupBy(*keys).agg(
        F.percentile_approx("duration_ms", [0.5, 0.95], accuracy).alias("p")
    ).select(
        *keys,
        F.col("p")[0].alias("p50_transition_duration_ms"),
        F.col("p")[1].alias("p95_transition_duration_ms"),
    )
    return _merge(keys, counts, percentiles)


def _exact_percentiles(observed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The smallest durations that at least half, and 95 %, of an edge's durations do not exceed.

    Equal durations are counted first.  Ranks are found in two steps, so that
    the durations of a hot edge never meet in one task: which stretch of 2**20 ms
    (17 minutes) holds a rank, then which duration of that stretch.
    """
    counted = observed.where(F.col("duration_ms").isNotNull()).groupBy(*keys, "duration_ms").agg(F.count("*").alias("n"))
    return counted_percentiles(counted, keys)


def counted_percentiles(counted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same from (keys, duration_ms, n), one row for each distinct duration of an edge."""
    distinct = counted.withColumn("stretch", F.floor(F.col("duration_ms") / (1 << 20)))
    along = Window.partitionBy(*keys).orderBy("stretch")
    stretches = (
        distinct.groupBy(*keys, "stretch")
        .agg(F.sum("n").alias("n"))
        .select(
            *keys,
            "stretch",
            (F.sum("n").over(along) - F.col("n")).alias("before"),
            F.sum("n").over(along).alias("through"),
            F.sum("n").over(Window.partitionBy(*keys)).alias("all"),
        )
    )
    parts = []
    for percent, name in ((50, "p50_transition_duration_ms"), (95, "p95_transition_duration_ms")):
        rank = F.floor((F.col("all") * percent + 99) / 100)  # of the durations, in order, from 1
        holding = stretches.where((F.col("before") < rank) & (rank <= F.col("through")))
        renamed = holding.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("stretch").alias("_stretch"), "before", rank.alias("rank"))
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
        inside = Window.partitionBy(*keys, "stretch").orderBy("duration_ms")
        placed = distinct.join(renamed, same & (F.col("stretch") == F.col("_stretch"))).withColumn(
            "up_to", F.col("before") + F.sum("n").over(inside)
        )
        parts.append(placed.where(F.col("up_to") >= F.col("rank")).groupBy(*keys).agg(F.min("duration_ms").alias(name)))
    return _merge(keys, *parts)


def _merge(keys: Sequence[str], *parts: DataFrame) -> DataFrame:
    """Put the columns of frames with one row per key side by side; null keys match."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    values = [name for name in stacked.columns if name not in keys]
    return stacked.groupBy(*keys).agg(*[F.max(name).alias(name) for name in values])


def start_activities(linked: DataFrame, dims: Sequence[str] = DIMS) -> DataFrame:
    """How many cases begin with an activity."""
    first = linked.where(F.col("event_sequence") == 1)
    return first.groupBy("activity_name", *dims).agg(F.count("*").alias("start_count"))


def end_activities(linked: DataFrame, dims: Sequence[str] = DIMS) -> DataFrame:
    """How many cases finish with an activity."""
    last = linked.where(F.col("is_end") & F.col("case_id").isNotNull())
    return last.groupBy("activity_name", *dims).agg(F.count("*").alias("end_count"))


def node_occurrences(linked: DataFrame, dims: Sequence[str] = DIMS) -> DataFrame:
    """Events, cases, starts and ends per activity, category and dimensions."""
    keys = ["activity_name", "activity_category", *dims]
    per_case = linked.groupBy("case_id", *keys).agg(
        F.count("*").alias("n"),
        F.count_if(F.col("event_sequence") == 1).alias("starts"),
        F.count_if(F.col("is_end") & F.col("case_id").isNotNull()).alias("ends"),
    )
    return per_case.groupBy(*keys).agg(
        F.sum("n").alias("occurrence_count"),
        F.count("case_id").alias("case_count"),
        F.sum("starts").alias("start_count"),
        F.sum("ends").alias("end_count"),
    )


def incident_duration(
    linked: DataFrame,
    precision: str = "second",
    dims: Sequence[str] = DIMS,
    pair_by: Column | None = None,
    pair_counts: bool = False,
) -> DataFrame:
    """Mean time from a raised to a resolved event of the same case and base name.

    Every raised event pairs with every resolved one of its case and name (or,
    with ``pair_by``, of the same incident id).  ``pair_counts`` adds their number.
    """
    sums = incident_sums(linked, precision, dims, pair_by)
    return sums.select(
        *dims,
        "activity_name",
        F.try_divide("duration_sum", "duration_pairs").alias("avg_activity_duration_ms"),
        *([F.col("duration_pairs").cast("bigint").alias("duration_pairs")] if pair_counts else []),
    )


def incident_sums(
    linked: DataFrame, precision: str = "second", dims: Sequence[str] = DIMS, pair_by: Column | None = None
) -> DataFrame:
    """Sum of the durations of all pairs and their number, per raised activity and dimensions.

    The pairs are never built: over n raised and m resolved events their
    durations add up to n * sum(resolved) - m * sum(raised).
    """
    sides = _incident_rows(linked, precision, dims, pair_by).groupBy("case_id", *dims, "base", "pair_id").agg(*_incident_sides())
    total, pairs = _incident_pairs()
    paired = sides.where((F.col("raised_rows") > 0) & (F.col("resolved_rows") > 0))
    return paired.groupBy(*dims, F.concat("base", F.lit(RAISED)).alias("activity_name")).agg(
        F.sum(total).alias("duration_sum"), F.sum(pairs).alias("duration_pairs")
    )


def incident_changes(linked: DataFrame, precision: str = "second", dims: Sequence[str] = DIMS) -> DataFrame:
    """The same sums of the rows with ``now`` 1 less those of the rows with ``was`` 1, in one pass over both."""
    rows = _incident_rows(linked, precision, dims, None, keep=("now", "was"))
    sides = rows.groupBy("case_id", *dims, "base").agg(
        *_incident_sides("now"), *_incident_sides("was"), F.max(F.col("now") != F.col("was")).alias("changed")
    )
    sums = []
    for sign, state in ((1, "now"), (-1, "was")):
        both = (F.col(f"{state}_raised_rows") > 0) & (F.col(f"{state}_resolved_rows") > 0)
        sums.append([F.when(both, sign * value).otherwise(F.lit(0.0)) for value in _incident_pairs(state)])
    some = (F.col("now_raised_rows") > 0) & (F.col("now_resolved_rows") > 0) | (F.col("was_raised_rows") > 0) & (F.col("was_resolved_rows") > 0)
    now, was = sums
    return sides.where(F.col("changed") & some).groupBy(*dims, F.concat("base", F.lit(RAISED)).alias("activity_name")).agg(
        F.sum(now[0] + was[0]).alias("duration_sum"), F.sum(now[1] + was[1]).alias("duration_pairs")
    )


def _incident_rows(
    linked: DataFrame, precision: str, dims: Sequence[str], pair_by: Column | None, keep: Sequence[str] = ()
) -> DataFrame:
    """Raised and resolved events with their base name."""
    ending = F.when(F.endswith("activity_name", F.lit(RAISED)), F.lit(RAISED)).when(
        F.endswith("activity_name", F.lit(RESOLVED)), F.lit(RESOLVED)
    )
    id_column = F.lit(None).cast("string") if pair_by is None else pair_by.cast("string")
    marked = linked.where(F.col("case_id").isNotNull()).select(
        "case_id",
        *dims,
        ending.alias("ending"),
        F.regexp_replace("activity_name", f"({RAISED}|{RESOLVED})$", "").alias("base"),
        id_column.alias("pair_id"),
        epoch_ms(F.col("event_ts"), precision).cast("decimal(20,0)").alias("at"),
        *keep,
    )
    marked = marked.where(F.col("ending").isNotNull())
    return marked if pair_by is None else marked.where(F.col("pair_id").isNotNull())


def _incident_sides(state: str | None = None) -> list[Column]:
    """Numbers and sums of raised and resolved events; with ``state`` of rows where that column is 1, named after it."""
    prefix = f"{state}_" if state else ""
    is_raised = F.col("ending") == RAISED
    counted = F.lit(True) if state is None else F.col(state) == 1
    raised_at = F.when(counted & is_raised, F.col("at"))
    resolved_at = F.when(counted & ~is_raised, F.col("at"))
    zero = F.lit(0).cast("decimal(20,0)")
    return [
        F.count_if(counted & is_raised).alias(f"{prefix}raised_rows"),
        F.count_if(counted & ~is_raised).alias(f"{prefix}resolved_rows"),
        F.count(raised_at).cast("decimal(18,0)").alias(f"{prefix}n"),
        F.count(resolved_at).cast("decimal(18,0)").alias(f"{prefix}m"),
        F.coalesce(F.sum(raised_at), zero).alias(f"{prefix}raised_sum"),
        F.coalesce(F.sum(resolved_at), zero).alias(f"{prefix}resolved_sum"),
    ]


def _incident_pairs(state: str | None = None) -> tuple[Column, Column]:
    """Sum of the durations of a case's pairs, and their number."""
    n, m, raised, resolved = (F.col(f"{state}_{c}" if state else c) for c in ("n", "m", "raised_sum", "resolved_sum"))
    return (n * resolved - m * raised).cast("double"), (n * m).cast("double")


def dfg_nodes(
    linked: DataFrame,
    precision: str = "second",
    dims: Sequence[str] = DIMS,
    pair_by: Column | None = None,
    null_safe: bool = True,
    pair_counts: bool = False,
) -> DataFrame:
    """Node table: occurrences, cases, starts, ends and mean incident duration.

    Starts, ends and durations belong to the activity whatever its category.
    With ``null_safe=False`` rows with a null activity or dimension get none of
    them, as under plain equality joins.  ``pair_counts`` adds the number of
    pairs behind each mean, the weight it has in a roll-up.
    """
    spans = incident_duration(linked, precision, dims, pair_by, pair_counts)
    return assemble_nodes(node_occurrences(linked, dims), spans, dims, null_safe, pair_counts)


def assemble_nodes(
    occurrences: DataFrame, spans: DataFrame, dims: Sequence[str] = DIMS, null_safe: bool = True, pair_counts: bool = False
) -> DataFrame:
    """The node table out of ``node_occurrences`` and ``incident_duration``."""
    name_keys = ["activity_name", *dims]
    by_name = Window.partitionBy(*name_keys)  # a few categories per name
    base = occurrences.withColumns(
        {
            "start_count": F.sum("start_count").over(by_name),
            "end_count": F.sum("end_count").over(by_name),
        }
    )
    extra = ["duration_pairs"] if pair_counts else []
    spans = spans.select(
        *[F.col(k).alias(f"_{k}") for k in name_keys], "avg_activity_duration_ms", *extra
    )
    if null_safe:
        match = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in name_keys]
    else:
        match = [F.col(k) == F.col(f"_{k}") for k in name_keys]
        known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in name_keys])
        base = base.withColumns(
            {c: F.when(known, F.col(c)).otherwise(F.lit(0)) for c in ("start_count", "end_count")}
        )
    return base.join(spans, match, "left").select(
        "activity_name",
        *dims,
        "occurrence_count",
        "case_count",
        "start_count",
        "end_count",
        "avg_activity_duration_ms",
        "activity_category",
        *extra,
    )
