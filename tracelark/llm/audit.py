"""How the filters of a corpus act on each other, in every order they could be applied.

Each row's failures are a set of filters.  Counts by part and set of failures
give the removal game: v(S), the rows that the filters of S remove together.
The game's Hart-Mas-Colell potential is found recursively over all coalitions,

    P(none) = 0,   P(S) = (v(S) + sum of P(S without i) over i in S) / |S|,

and the Shapley value of a filter is P(all) - P(all without it).  What a filter
removes at a place of an order is a difference of two coalitions' values.
Potentials are kept as multiples of 1/lcm(1..n), so everything is in integers.

Rows are reduced to one narrow line each, then to at most 2**n counts a part;
texts meet by digest together with the id, so copies of one text are spread.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame, functions as F

from .tables import narrow, written

SPACES = r"[\x20\x09-\x0D]+"
#: Filters on a text by themselves, in the order of their letters; E is about the whole table.
DUPLICATE = "E"
PARTS = "ABCD"


def text_failures(text: Column) -> dict[str, Column]:
    """Whether a text fails A (under 200 words), B (under half of the words distinct), C (over 2 % capitals) or D (marks of markup)."""
    words = F.array_remove(F.split(text, SPACES), "")
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * capitals > 2 * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def _bits(failures: Mapping[str, Column]) -> Column:
    """The failed filters as a number: bit k for the k-th."""
    return sum((F.when(c, 1 << k).otherwise(0) for k, c in enumerate(failures.values())), F.lit(0))


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): rows of each source by the set of filters they fail.

    A row fails E if a row with a smaller id has the same text; a row without id never does and never is the smaller one.
    A row is good or toxic if any of its id's labels says so.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("source"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        _bits(text_failures(text)).alias("mask"),
    )
    facts = written(rows.groupBy("doc_id", "digest", "part", "mask").agg(F.count("*").alias("n")), "failures")
    named = facts.where("doc_id IS NOT NULL")
    # a text's first row is found by digest and id, so that the copies of one text do not meet in one task
    first = named.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    marked = named.join(first, ["digest", "doc_id"], "left")
    own = labels.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    labelled = marked.join(narrow(own), "doc_id", "left").select(
        "part",
        F.when(F.col("first"), F.col("mask")).otherwise(F.col("mask") + (1 << len(PARTS))).alias("mask"),
        "n",
        F.coalesce("good", F.lit(0)).alias("good"),
        F.coalesce("toxic", F.lit(0)).alias("toxic"),
    )
    unnamed = facts.where("doc_id IS NULL").select("part", "mask", "n", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    return (
        labelled.unionByName(unnamed)
        .groupBy("part", "mask")
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.col("n") * F.col("good")).alias("good"),
            F.sum(F.col("n") * F.col("toxic")).alias("toxic"),
        )
    )


def _removed(value: str, coalitions: int) -> Column:
    """By coalition: the sum of ``value`` over the rows that fail any of its filters."""
    hit = [F.when(F.col("mask").bitwiseAND(s) != 0, F.col(value)).otherwise(0) for s in range(coalitions)]
    return F.array(*[F.sum(h) for h in hit])


def _potentials(filters: int) -> Column:
    """By coalition: its potential times lcm(1..filters), each from those of one filter less."""
    scale = math.lcm(*range(1, filters + 1))
    less = " + ".join(f"if(s & {1 << i} <> 0, q[s ^ {1 << i}], 0L)" for i in range(filters))
    step = f"concat(q, array(({scale}L * v[s] + {less}) div bit_count(s)))"
    return F.expr(f"aggregate(sequence(1, {(1 << filters) - 1}), array(0L), (q, s) -> {step})")


def interactions(counts: DataFrame, filters: Sequence[str]) -> DataFrame:
    """Every part, order of the filters and step, from counts (part, mask, n, good, toxic).

    Counts within the part: kept after the step, removed by it, redundant (fail
    its filter, removed earlier), unique_fails (fail no other filter), good_lost
    and toxic_lost (removed here), shapley (removed by its filter, over all
    orders together).  There are n! * n rows a part.  ``filters`` are single letters, in the order of the mask's bits.
    """
    size = len(filters)
    every = (1 << size) - 1
    games = counts.groupBy("part").agg(
        F.sum("n").alias("rows"), _removed("n", 1 << size).alias("v"), _removed("good", 1 << size).alias("g"), _removed("toxic", 1 << size).alias("t")
    )
    orders = F.array(*[F.lit("".join(order)) for order in permutations(filters)])
    steps = games.withColumn("q", _potentials(size)).select("*", F.explode(orders).alias("filter_order"))
    steps = steps.select("*", F.explode(F.sequence(F.lit(1), F.lit(size))).alias("step"))

    def among(letters: Column) -> Column:
        return _bits({f: F.contains(letters, F.lit(f)) for f in filters})

    order = F.col("filter_order")
    steps = steps.select(
        "*",
        among(F.substring(order, F.lit(1), F.col("step") - 1)).alias("before"),
        among(F.substring(order, F.col("step"), F.lit(1))).alias("own"),
    ).withColumn("after", F.col("before") + F.col("own"))

    def at(values: str, coalition: str | Column) -> Column:
        return F.get(F.col(values), F.col(coalition) if isinstance(coalition, str) else coalition)

    removed = at("v", "after") - at("v", "before")
    others = F.lit(every) - F.col("own")
    orders_per_unit = math.factorial(size) // math.lcm(*range(1, size + 1))
    return steps.select(
        "part",
        "filter_order",
        "step",
        (F.col("rows") - at("v", "after")).alias("kept"),
        removed.alias("removed"),
        (at("v", "own") - removed).alias("redundant"),
        (at("v", F.lit(every)) - at("v", others)).alias("unique_fails"),
        (at("g", "after") - at("g", "before")).alias("good_lost"),
        (at("t", "after") - at("t", "before")).alias("toxic_lost"),
        (orders_per_unit * (at("q", F.lit(every)) - at("q", others))).alias("shapley"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The five filters over whole texts of ``docs``, by source (null: empty).

    A null or empty text fails A alone, and E like any other text.  Repeated rows count each.  An empty table gives no
    rows; without labels nothing good or toxic is lost.  Other columns, whatever their names, are left.
    """
    return interactions(failure_counts(docs, labels), [*PARTS, DUPLICATE])
