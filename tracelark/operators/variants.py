"""Variants: the label sequences of cases and how many cases follow each."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

SEPARATOR = " → "


def variant_counts(linked: DataFrame) -> DataFrame:
    """Cases per variant, by a fingerprint of the label at every position.

    Hashes of (position, label) are combined by xor in two independent lanes,
    128 bits in all next to the length.  Unlike a collected list this merges
    map-side and has a fixed size however long a case is, and only these few
    bytes per case are shuffled to count variants.
    """
    lanes = {
        lane: F.bit_xor(F.xxhash64(F.lit(lane), F.col("event_sequence"), F.col("activity_name")))
        for lane in ("left", "right")
    }
    per_case = linked.groupBy("case_id").agg(
        F.count("*").alias("length"), *[value.alias(lane) for lane, value in lanes.items()]
    )
    return per_case.groupBy("length", "left", "right").agg(
        F.count("*").alias("case_count"), F.min("case_id").alias("first_case")
    )


def variant_steps(linked: DataFrame, k: int = 10) -> DataFrame:
    """(rank, position, activity_name, case_count): the k most frequent variants, one row for each label.

    Ties go to the smaller first case.  A variant is read off its first case;
    the ranking, k rows, is joined as a broadcast, so no case is gathered.
    """
    best = variant_counts(linked).orderBy(F.desc("case_count"), "first_case").limit(k).select("first_case", "case_count")
    ranked = best.select(
        "first_case", "case_count", F.row_number().over(Window.orderBy(F.desc("case_count"), "first_case")).alias("rank")
    )
    match = F.col("case_id").eqNullSafe(F.col("first_case"))
    return linked.select("case_id", "event_sequence", "activity_name").join(F.broadcast(ranked), match).select(
        "rank", F.col("event_sequence").alias("position"), "activity_name", "case_count"
    )


def top_variants(linked: DataFrame, k: int = 10, separator: str = SEPARATOR) -> DataFrame:
    """The same with each variant's labels joined to one text, most frequent first.

    A text is one value, so here a winner's own events do come together, and nothing else does.
    """
    steps = F.array_sort(F.collect_list(F.struct("position", "activity_name")))
    spelled = variant_steps(linked, k).groupBy("rank", "case_count").agg(steps.alias("steps"))
    variant = F.array_join(F.col("steps.activity_name"), separator)
    return spelled.orderBy("rank").select(variant.alias("variant"), "case_count")
