"""Event attributes, literal lookups and lenient numbers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F


def attribute_map(pairs: Mapping[str, Column], drop_nulls: bool = False) -> Column:
    """map<string,string> of the given columns; null values stay unless dropped."""
    if not pairs:
        return F.create_map().cast("map<string,string>")
    entries = [part for name, value in pairs.items() for part in (F.lit(name), value.cast("string"))]
    built = F.create_map(*entries)
    return F.map_filter(built, lambda _, value: value.isNotNull()) if drop_nulls else built


def category_rank(category: Column, ranks: Mapping[str, int]) -> Column:
    """Priority of a category; null (which sorts first) for an unlisted one."""
    lookup = F.create_map(*[F.lit(x) for pair in ranks.items() for x in pair])
    return F.element_at(lookup, category)


def numeric_or_zero(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Read columns (often text) as the given types, with 0 for what is no number."""
    return df.withColumns(
        {name: F.coalesce(F.col(name).try_cast(kind), F.lit(0).cast(kind)) for name, kind in columns.items()}
    )
