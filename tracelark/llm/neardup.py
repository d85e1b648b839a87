"""Near duplicates by bottom-k sketches of one hash function.

1. Each text becomes the set of hashes of its word runs; the k smallest values
   are its sketch.  Equal sets (exact copies among them) are one node from then on.
2. Inverted lists of the retained values.  Two sets as similar as asked share
   at least ``least_shared`` retained values, so their prefixes in the order
   "rarest list first" meet.  Values of one node only fill prefixes, so most
   nodes leave here, and a passage common to many texts is in few prefixes.
3. Each node is compared with one hub of its lists, the most central node; that
   links groups of copies without forming their pairs.  For what is still in
   different components of a list, prefixes of the whole sets must meet, at a place
   that leaves enough common values; the other pairs cannot be similar enough.
4. The sketch of the union estimates the similarity and drops pairs far below
   the threshold; full sets confirm the others in integers.

The chances: a pair at the threshold with long texts shares fewer retained
values than assumed with a probability of about 1e-9 (6.2 standard deviations
of a binomial count); short texts are kept whole in the sketch and lose nothing.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .components import connected_components, joined_components
from .tables import TEXT_HASH, document_texts, narrow, text_hash, written, written_by_cores
from .textops import overlap, shingle_rows, shingle_set, text_array, tidy

SKETCH = 48
DEVIATIONS = 6.2

_SKETCHED = pa.schema(
    [
        ("doc_id", pa.int64()),
        (TEXT_HASH, pa.int64()),
        ("n_shingles", pa.int64()),
        ("high", pa.int64()),
        ("low", pa.int64()),
        ("sketch", pa.list_(pa.int64())),
    ]
)
_SKETCHED_DDL = f"doc_id bigint, {TEXT_HASH} bigint, n_shingles bigint, high bigint, low bigint, sketch array<bigint>"


def ratio(similarity: float) -> tuple[int, int]:
    exact = Fraction(similarity).limit_denominator(10_000)
    return exact.numerator, exact.denominator


def least_shared(k: int, similarity: float) -> int:
    """Retained values that two long sets of this similarity share at least."""
    return max(1, math.floor(k * similarity - DEVIATIONS * math.sqrt(k * similarity * (1 - similarity))))


def sketches(docs: DataFrame, width: int, k: int = SKETCH) -> DataFrame:
    """doc_id, text hash, size, 128-bit digest (high, low) and bottom-k sketch of every row's set."""

    def run(batches):
        for batch in batches:
            sizes, high, low, values, ends = [], [], [], [], [0]
            for _, hashes in shingle_rows(text_array(batch), width):
                whole = shingle_set(hashes)
                digest = np.frombuffer(hashlib.blake2b(whole.tobytes(), digest_size=16).digest(), np.int64)
                sizes.append(len(whole))
                high.append(int(digest[0]))
                low.append(int(digest[1]))
                values.append(whole[:k])
                ends.append(ends[-1] + min(k, len(whole)))
            retained = pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.array(np.concatenate(values) if values else np.zeros(0, np.int64))
            )
            columns = [batch.column(0), batch.column(1), sizes, high, low]
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in columns] + [retained], schema=_SKETCHED
            )

    keyed = document_texts(docs).select("doc_id", text_hash().alias(TEXT_HASH), "text")
    return keyed.mapInArrow(tidy(run), _SKETCHED_DDL)


def full_sets(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """(node, n, values): the whole ascending set, as little-endian bytes, of the row named by each node."""

    def run(batches):
        for batch in batches:
            found = [shingle_set(hashes).tobytes() for _, hashes in shingle_rows(text_array(batch), width)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.binary())], names=["node", "n", "values"]
            )

    keyed = document_texts(docs).withColumn(TEXT_HASH, text_hash())
    wanted = nodes.select("node", "n", F.col("doc_id").alias("__id"), F.col(TEXT_HASH).alias("__hash"))
    rows = keyed.join(
        narrow(wanted), (keyed.doc_id.eqNullSafe(F.col("__id"))) & (keyed[TEXT_HASH] == F.col("__hash"))
    )
    return rows.select("node", "n", "text").mapInArrow(tidy(run), "node bigint, n bigint, values binary")


def _confirmed(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full sets are similar enough."""
    top, bottom = ratio(similarity)

    def run(batches):
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            keep = []
            for i in range(batch.num_rows):
                x, y = np.frombuffer(left[i].as_buffer(), np.int64), np.frombuffer(right[i].as_buffer(), np.int64)
                both = overlap(x, y)
                keep.append(both * bottom >= top * (len(x) + len(y) - both))
            chosen = batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays(chosen.columns, names=["a", "b"])

    first = sets.select(F.col("node").alias("a"), F.col("values").alias("left"))
    second = sets.select(F.col("node").alias("b"), F.col("values").alias("right"))
    return pairs.select("a", "b").join(first, "a").join(second, "b").select("a", "b", "left", "right").mapInArrow(tidy(run), "a bigint, b bigint")


def _estimated(pairs: DataFrame, nodes: DataFrame, k: int, similarity: float) -> DataFrame:
    """Pairs whose union sketch does not rule the similarity out."""
    first = nodes.select(F.col("node").alias("a"), F.col("sketch").alias("sa"))
    second = nodes.select(F.col("node").alias("b"), F.col("sketch").alias("sb"))
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, k)
    joined = pairs.select("a", "b").join(first, "a").join(second, "b").withColumn("su", union)
    shared = F.size(F.array_intersect(F.array_intersect("sa", "sb"), "su"))
    whole = F.size("su")
    least = whole * similarity - DEVIATIONS * F.sqrt(whole * similarity * (1 - similarity))
    return joined.where(shared >= least).select("a", "b")


def _sized(similarity: float, n: str = "n", m: str = "m") -> Column:
    """Sizes n and m alone allow the similarity."""
    top, bottom = ratio(similarity)
    return F.least(n, m) * bottom >= F.greatest(n, m) * top


def _postings(nodes: DataFrame, k: int, similarity: float) -> DataFrame:
    """(node, n, v, centre): prefixes of the sketches that may meet another node's; centre is large for nodes of large groups."""
    top, bottom = ratio(similarity)
    lists = nodes.select("node", F.explode("sketch").alias("v"))
    common = lists.groupBy("v").agg(F.count("*").alias("df")).where("df > 1")
    shared = lists.join(common, "v")
    by_node = Window.partitionBy("node")
    ranked = shared.select(
        "node",
        "v",
        F.row_number().over(by_node.orderBy("df", "v")).alias("rank"),
        F.count("*").over(by_node).alias("m"),
        F.sum(F.log("df")).over(by_node).alias("centre"),
    )
    facts = nodes.select("node", "n", F.size("sketch").alias("k"))
    needed = F.when(F.col("n") * bottom <= F.lit(k) * top, F.ceil(F.col("n") * top / bottom)).otherwise(
        F.least(F.lit(least_shared(k, similarity)), F.col("k"))
    )
    # rare values of one node come first in its order, so rank counts on from them
    possible = ranked.join(facts, "node").where((F.col("m") >= needed) & (F.col("k") - F.col("m") + F.col("rank") <= F.col("k") - needed + 1))
    return written_by_cores(possible.select("node", "n", "v", "centre"), "postings")


def _star_pairs(lists: DataFrame, similarity: float) -> DataFrame:
    """For each node the hub, of all lists it is in, that it shares most lists with.

    ``lists`` has v, node, n, root (its component so far), centre and rest: at
    most so many values from this one on can be common with another set.
    """
    hubs = lists.groupBy("v").agg(
        F.max_by(F.struct("node", "n", "root", "rest"), F.struct("centre", -F.col("node"))).alias("hub"), F.count("*").alias("members")
    ).where("members > 1")
    near = (
        lists.join(hubs, "v")
        .where((F.col("node") != F.col("hub.node")) & (F.col("root") != F.col("hub.root")))
        .select(F.col("node").alias("a"), "n", "rest", F.col("hub.node").alias("b"), F.col("hub.n").alias("m"), F.col("hub.rest").alias("rest_b"))
        .where(_sized(similarity) & _enough(similarity))
    )
    counted = near.groupBy("a", "b").agg(F.count("*").alias("lists"))
    best = counted.groupBy("a").agg(F.max_by("b", F.struct("lists", -F.col("b"))).alias("b"))
    return best.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _enough(similarity: float) -> Column:
    """What follows the first common value in either set suffices for the similarity of sets of sizes n and m."""
    top, bottom = ratio(similarity)
    return F.least("rest", "rest_b") * (top + bottom) >= (F.col("n") + F.col("m")) * top


def _rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    return rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _prefixes(postings: DataFrame, roots: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(v, node, n, centre, rest): prefixes of the whole sets, rarest values first, of the nodes in lists with several components."""
    top, bottom = ratio(similarity)
    placed = _rooted(postings.select("v", "node", "n"), roots)
    split = placed.groupBy("v").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("v")
    members = written_by_cores(placed.join(split, "v", "left_semi").select("node", "n").distinct(), "open")

    def values(batches):
        for batch in batches:
            arrays = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column(1)]
            sizes = [len(x) for x in arrays]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(batch.column(0).to_numpy(), sizes), pa.int64()),
                    pa.array(np.concatenate(arrays) if arrays else np.zeros(0, np.int64), pa.int64()),
                ],
                names=["node", "v"],
            )

    chosen = sets.join(members.select("node"), "node", "left_semi").select("node", "values")
    whole = chosen.mapInArrow(tidy(values), "node bigint, v bigint")
    common = whole.groupBy("v").agg(F.count("*").alias("df")).where("df > 1")
    by_node = Window.partitionBy("node")
    ranked = whole.join(common, "v").select(
        "node",
        "v",
        F.row_number().over(by_node.orderBy("df", "v")).alias("rank"),
        F.count("*").over(by_node).alias("m"),
        F.sum(F.log("df")).over(by_node).alias("centre"),
    )
    # values of one node only stand before all others, so rank counts on from them
    rest = ranked.join(members, "node").withColumn("rest", (F.col("m") - F.col("rank") + 1).cast("bigint"))
    return written_by_cores(rest.where(F.col("rest") * bottom >= F.col("n") * top).select("v", "node", "n", "centre", "rest"), "prefixes")


def _cross_pairs(prefixes: DataFrame, roots: DataFrame, similarity: float) -> DataFrame:
    """Pairs of different components whose prefixes meet at a place that leaves enough common values."""
    rows = _rooted(prefixes, roots)
    left = rows.select("v", F.col("node").alias("a"), "n", F.col("root").alias("ra"), "rest")
    right = rows.select("v", F.col("node").alias("b"), F.col("n").alias("m"), F.col("root").alias("rb"), F.col("rest").alias("rest_b"))
    pairs = left.join(
        right,
        (left.v == right.v) & (F.col("a") > F.col("b")) & (F.col("ra") != F.col("rb")) & _sized(similarity) & _enough(similarity),
    )
    return pairs.select("a", "b").distinct()


def _further(roots: DataFrame, found: DataFrame) -> DataFrame:
    links = written_by_cores(found, "links")
    return written_by_cores(joined_components(roots, links), "roots") if links.take(1) else roots


def components_of(postings: DataFrame, sets: DataFrame, similarity: float, estimate: Callable[[DataFrame], DataFrame] = lambda p: p) -> DataFrame:
    """(node, root) of all nodes with links, given lists (v, node, n, centre) in which every similar pair meets.

    Hubs of the lists first, then hubs of whole-set prefixes, then the pairs
    still apart; ``estimate`` drops pairs before their whole sets are compared.
    """
    alone = postings.withColumn("root", F.col("node")).withColumn("rest", F.col("n"))
    tried = written_by_cores(_star_pairs(alone, similarity), "stars")
    links = written_by_cores(_confirmed(estimate(tried), sets, similarity), "links")
    roots = written_by_cores(connected_components(links), "roots")
    prefixes = _prefixes(postings, roots, sets, similarity)
    again = written_by_cores(_star_pairs(_rooted(prefixes, roots), similarity).join(tried, ["a", "b"], "left_anti"), "stars")
    if again.take(1):
        tried = tried.union(again)
        roots = _further(roots, _confirmed(estimate(again), sets, similarity))
    others = written_by_cores(_cross_pairs(prefixes, roots, similarity).join(tried, ["a", "b"], "left_anti"), "pairs")
    if others.take(1):
        roots = _further(roots, _confirmed(estimate(others), sets, similarity))
    return roots


def similar_classes(docs: DataFrame, width: int = 5, similarity: float = 0.8, k: int = SKETCH) -> DataFrame:
    """One row per document row: doc_id, text hash, n_shingles, and the identity (high, low) of its component.

    Documents are linked when their sets of runs of ``width`` words have at
    least this Jaccard similarity, and components follow links.  Null or empty
    texts have no runs, are linked with nothing and have null high and low.
    Repeated rows and equal texts are in one component.  A null doc_id is an id
    like others.  An empty table gives no rows.
    """
    every = written(sketches(docs, width, k), "sketches")
    filled = every.where("n_shingles > 0")
    nodes = filled.groupBy("high", "low").agg(
        F.min_by(F.struct("doc_id", TEXT_HASH, "n_shingles", "sketch"), F.struct("doc_id", TEXT_HASH)).alias("x")
    )
    nodes = written_by_cores(
        nodes.select(
            F.monotonically_increasing_id().alias("node"),
            "high",
            "low",
            F.col("x.doc_id").alias("doc_id"),
            F.col(f"x.{TEXT_HASH}").alias(TEXT_HASH),
            F.col("x.n_shingles").alias("n"),
            F.col("x.sketch").alias("sketch"),
        ),
        "nodes",
    )
    postings = _postings(nodes, k, similarity)
    members = written_by_cores(nodes.join(postings.select("node").distinct(), "node", "left_semi"), "members")
    sets = written(full_sets(docs, members, width).dropDuplicates(["node"]), "sets")
    roots = components_of(postings, sets, similarity, lambda pairs: _estimated(pairs, members, k, similarity))
    named = nodes.select(F.col("node").alias("root"), F.col("high").alias("class_high"), F.col("low").alias("class_low"))
    classes = (
        nodes.join(roots, "node", "left")
        .select("high", "low", F.coalesce("root", "node").alias("root"))
        .join(named, "root")
        .select("high", "low", "class_high", "class_low")
    )
    return every.drop("sketch").join(classes, ["high", "low"], "left").select(
        "doc_id", TEXT_HASH, "n_shingles", F.col("class_high").alias("high"), F.col("class_low").alias("low")
    )


def near_duplicates(docs: DataFrame, width: int = 5, similarity: float = 0.8, k: int = SKETCH) -> DataFrame:
    """doc_id, text hash, n_shingles, component_id and kept of every document row.

    component_id is the smallest doc_id of the component (null if all are null),
    kept tells whether the row has that id.  A row without runs is its own component.
    """
    placed = written_by_cores(similar_classes(docs, width, similarity, k), "classes")
    smallest = placed.where("high is not null").groupBy("high", "low").agg(F.min("doc_id").alias("smallest"))
    joined = placed.join(smallest, ["high", "low"], "left")
    component = F.when(F.col("high").isNull(), F.col("doc_id")).otherwise(F.col("smallest"))
    return joined.select(
        "doc_id", TEXT_HASH, "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def one_of_each(docs: DataFrame, width: int = 5, similarity: float = 0.8, k: int = SKETCH) -> DataFrame:
    """The rows of ``docs`` without all but one row of each component: the one with the smallest doc_id.

    Nulls come after all ids; of repeated rows one stays; rows without runs all stay, but for repeated ones.
    """
    placed = similar_classes(docs, width, similarity, k)
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col(TEXT_HASH))
    rows = F.struct("doc_id", TEXT_HASH)
    grouped = placed.where("high is not null").groupBy("high", "low").agg(F.min_by(rows, order).alias("first"))
    lone = placed.where("high is null").select("doc_id", TEXT_HASH).distinct()
    chosen = written(grouped.select("first.*").union(lone), "chosen")
    counted = placed.groupBy("doc_id", TEXT_HASH).agg(F.count("*").alias("copies")).where("copies > 1")
    repeated = written(counted.select("doc_id", TEXT_HASH), "repeated")
    columns = docs.columns
    keyed = docs.withColumn(TEXT_HASH, text_hash()).withColumn("__id", F.col("doc_id").cast("bigint"))

    def among(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        other = keys.select(F.col("doc_id").alias("__other"), F.col(TEXT_HASH).alias("__other_hash"))
        return rows.join(
            narrow(other), F.col("__id").eqNullSafe(F.col("__other")) & (F.col(TEXT_HASH) == F.col("__other_hash")), how
        )

    kept = among(keyed, chosen, "left_semi")
    if repeated.take(1):
        single = among(kept, repeated, "left_anti")
        twice = among(kept, repeated, "left_semi").dropDuplicates(["__id", TEXT_HASH])
        kept = single.unionByName(twice)
    return kept.select(*columns)
