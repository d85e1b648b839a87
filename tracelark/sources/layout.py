"""Layout of a table for filters on any of several columns.

Sorted by one column after the other, a table can skip files only for filters
on the first.  Here the columns' ranks are interleaved bit by bit (a Z-order curve), so
that every file covers a small range of each column and statistics rule most
files out whichever of them is filtered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: Bits of a column's rank: 256 ranges of about equally many distinct values.
RANK_BITS = 8


def _bounds(df: DataFrame, column: str) -> list:
    """The first value of each of at most 2**RANK_BITS ranges of the distinct values."""
    values = df.select(F.col(column).alias("v")).where("v IS NOT NULL").distinct()
    ranged = values.repartitionByRange(1 << RANK_BITS, "v")
    firsts = ranged.groupBy(F.spark_partition_id().alias("p")).agg(F.min("v").alias("v")).collect()
    return sorted(r.v for r in firsts)


def _rank(column: str, bounds: list) -> Column:
    """Which range a value is in, spread over all RANK_BITS bits; nulls come first."""
    if not bounds:
        return F.lit(0).cast("bigint")
    # ranges are few and known, so a look through them is cheap and needs no join
    known = F.array(*[F.lit(b) for b in bounds])
    place = F.size(F.filter(known, lambda b: b <= F.col(column)))
    return F.coalesce(F.floor(F.greatest(place - 1, F.lit(0)) * (1 << RANK_BITS) / len(bounds)), F.lit(0)).cast("bigint")


def curve_key(df: DataFrame, columns: Sequence[str]) -> Column:
    """Place on the curve through the ranks of up to seven columns."""
    if not 0 < len(columns) <= 63 // RANK_BITS:
        raise ValueError(f"1 to {63 // RANK_BITS} columns, not {len(columns)}")
    key = F.lit(0).cast("bigint")
    for j, column in enumerate(columns):
        rank = _rank(column, _bounds(df, column))
        for bit in range(RANK_BITS):
            # later columns take the lower place of each group of bits
            place = bit * len(columns) + len(columns) - 1 - j
            key = key.bitwiseOR(F.shiftleft(F.shiftright(rank, bit).bitwiseAND(1), place))
    return key


def clustered(df: DataFrame, columns: Sequence[str], files: int) -> DataFrame:
    """The same rows in ``files`` partitions along the curve."""
    columns = list(columns)
    keyed = df.withColumn("_curve", curve_key(df, columns))
    return keyed.repartitionByRange(files, "_curve", *columns).sortWithinPartitions("_curve", *columns).drop("_curve")
