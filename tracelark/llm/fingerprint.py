"""MinHash fingerprints: universal hash permutations over word shingles, banded joins, verified similarity."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from .neardup import components_of, full_sets
from .tables import TEXT_HASH, document_texts, text_hash, written
from .textops import CHUNK, chunks, shingle_hashes, text_array, tidy, word_hashes, word_spans

PERMUTATIONS = 64
#: 64 values as 21 bands of 3 rows: a pair of similarity 0.8 shares no band with a probability of 3e-7.
BANDS, ROWS = 21, 3

_random = np.random.Generator(np.random.PCG64(8))
_FACTORS = _random.integers(0, 2**63, PERMUTATIONS).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _random.integers(0, 2**63, PERMUTATIONS).astype(np.uint64)
_NONE = np.uint32(0xFFFFFFFF)


def signatures(texts: pa.Array, width: int = 5) -> np.ndarray:
    """[texts, permutations] of 32-bit minima of (factor * shingle + shift) mod 2**64 / 2**32; without words all bits are set."""
    out = np.full((len(texts), PERMUTATIONS), _NONE, np.uint32)
    for first, _, data, offsets in chunks(texts):
        start, end, bounds = word_spans(data, offsets)
        hashes, ends = shingle_hashes(word_hashes(data, start, end), bounds, width)
        rows = np.flatnonzero(np.diff(ends))
        if not len(rows):
            continue
        heads = ends[:-1][rows]
        for i in range(PERMUTATIONS):
            out[first + rows, i] = np.minimum.reduceat(hashes * _FACTORS[i] + _SHIFTS[i], heads) >> np.uint64(32)
    return out


def fingerprint_texts(values: np.ndarray) -> list[str]:
    """The low 16 bits of each minimum, as hex: 256 digits."""
    joined = (values & np.uint32(0xFFFF)).astype(">u2").tobytes().hex()
    size = PERMUTATIONS * 4
    return [joined[i : i + size] for i in range(0, len(joined), size)]


def likeness(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Share of equal parts of two fingerprints, row by row."""
    return ((left & np.uint32(0xFFFF)) == (right & np.uint32(0xFFFF))).mean(1)


def fingerprints(docs: DataFrame, width: int = 5) -> DataFrame:
    """doc_id, text hash, signature (array of 64 minima) and fingerprint of every document row."""

    def run(batches):
        for batch in batches:
            values = signatures(text_array(batch), width)
            arrays = pa.ListArray.from_arrays(
                pa.array(np.arange(len(values) + 1) * PERMUTATIONS, pa.int32()), pa.array(values.ravel().astype(np.int64))
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), arrays, pa.array(fingerprint_texts(values), pa.string())],
                names=["doc_id", TEXT_HASH, "signature", "fingerprint"],
            )

    keyed = document_texts(docs).select("doc_id", text_hash().alias(TEXT_HASH), "text")
    return keyed.mapInArrow(tidy(run), f"doc_id bigint, {TEXT_HASH} bigint, signature array<bigint>, fingerprint string")


def similar_fingerprints(docs: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """doc_id, fingerprint and class_id (smallest doc_id of the component) of every document row.

    Rows with equal fingerprints are one node, nodes that agree in a band of
    their signatures are compared on full sets (a hub of each band first, then
    what is still apart), and components follow the links.  Rows without words
    are linked with nothing; a null doc_id counts as larger than all ids.
    """
    every = written(fingerprints(docs, width), "fingerprints")
    empty = "f" * (PERMUTATIONS * 4)
    # rows of one signature may still differ in their sets, so a node is a distinct text
    grouped = every.where(F.col("fingerprint") != empty).groupBy(TEXT_HASH, "signature").agg(F.min("doc_id").alias("doc_id"))
    nodes = written(grouped.select(F.monotonically_increasing_id().alias("node"), "doc_id", TEXT_HASH, "signature"), "nodes")
    sets = written(
        full_sets(docs, nodes.withColumn("n", F.lit(0).cast("bigint")), width)
        .dropDuplicates(["node"])
        .select("node", F.expr("length(values) div 8").cast("bigint").alias("n"), "values"),
        "sets",
    )
    bands = F.array(
        *[F.xxhash64(F.lit(i), *[F.element_at("signature", i * ROWS + j + 1) for j in range(ROWS)]) for i in range(BANDS)]
    )
    keyed = nodes.select("node", F.explode(bands).alias("v")).join(sets.select("node", "n"), "node")
    common = keyed.groupBy("v").agg(F.count("*").alias("df")).where("df > 1")
    shared = keyed.join(common, "v")
    centre = shared.groupBy("node").agg(F.sum(F.log("df")).alias("centre"))
    postings = written(shared.drop("df").join(centre, "node"), "postings")
    roots = components_of(postings, sets, similarity)
    placed = nodes.join(roots, "node", "left").select(TEXT_HASH, F.coalesce("root", "node").alias("root"), "doc_id")
    classes = placed.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    named = placed.join(classes, "root").select(TEXT_HASH, "class_id").distinct()
    return every.join(named, TEXT_HASH, "left").select(
        "doc_id", "fingerprint", F.when(F.col("fingerprint") == empty, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id")
    )


EDITED_DDL = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _bounded(batch: pa.RecordBatch, at: int, limit: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``limit`` bytes of text."""
    for first, stop, _, _ in chunks(batch.column(at).cast(pa.large_string()), limit, lower=False):
        yield batch.slice(first, stop - first)


def fingerprints_of_edits(docs: DataFrame, width: int = 5, slices: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text, with the likeness to that and to the next document's text.

    The next document is the one with the next smaller doc_id (a null id is the
    smallest; rows with one id follow each other by their texts' hashes), after
    the last one the first.  Its first floor(n/2) code points (or all) replace
    the last floor(n/2) of a text of n.  Null texts are empty; two texts without
    words have likeness 1.  A single row is its own next one.  No rows give none.

    Rows are dealt by ranges of ids: a slice's head is also sent to the slice
    before it, so each text moves once and no slice needs another.
    """
    spark = docs.sparkSession
    count = slices or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    plain = document_texts(docs).withColumn("place", F.coalesce("doc_id", F.lit(-(2**63)).cast("bigint")))
    places = plain.select("place")
    shares = [i / count for i in range(1, count)]
    splits = np.array(sorted(set(places.stat.approxQuantile("place", shares, 0.25 / count) if shares else [])))

    @F.pandas_udf(T.IntegerType())
    def slice_of(place):
        return pd.Series(len(splits) - np.searchsorted(splits, place.to_numpy(), "right"))

    heads = {r.slice: r.head for r in places.groupBy(slice_of("place").alias("slice")).agg(F.max("place").alias("head")).collect()}
    order = sorted(heads)
    before = {heads[s]: order[i - 1] for i, s in enumerate(order)}  # head -> the slice that also gets it
    # one row for each slice, so small enough to broadcast
    guests = spark.createDataFrame(list(before.items()), "head bigint, host int")
    own, also = F.struct("slice", F.lit(False).alias("guest")), F.struct(F.col("host").alias("slice"), F.lit(True).alias("guest"))
    dealt = F.when(F.col("host").isNull(), F.array(own)).otherwise(F.array(own, also))
    rows = (
        plain.withColumn("slice", slice_of("place"))
        .join(F.broadcast(guests), F.col("place") == F.col("head"), "left")
        .select("doc_id", "place", "text", F.explode(dealt).alias("to"))
        .select("to.slice", "to.guest", "doc_id", "place", text_hash().alias("hash"), "text")
        .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "slice")
        .sortWithinPartitions("slice", "guest", F.desc("place"), "hash")
        .select("guest", "doc_id", "text")
    )

    def run(batches):
        held = None  # the last row seen, whose next row is not known yet
        for whole in batches:
            for batch in _bounded(whole, 2):
                texts = batch.column(2).to_pylist()
                values = signatures(text_array(batch), width)
                guests, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                if held is not None:
                    guests, ids, texts = [held[0], *guests], [held[1], *ids], [held[2], *texts]
                    values = np.concatenate([held[3], values])
                held = (guests[-1], ids[-1], texts[-1], values[-1:])
                at = [i for i in range(len(texts) - 1) if not guests[i]]
                if not at:
                    continue
                edited = []
                for i in at:
                    half = len(texts[i]) // 2
                    edited.append(texts[i][: len(texts[i]) - half] + texts[i + 1][:half])
                changed = signatures(pa.array(edited, pa.large_string()), width)
                mine, following = values[at], values[[i + 1 for i in at]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([ids[i] for i in at], pa.int64()),
                        pa.array([len(texts[i]) for i in at], pa.int64()),
                        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
                        pa.array(fingerprint_texts(mine)),
                        pa.array(fingerprint_texts(changed)),
                        pa.array(likeness(mine, changed)),
                        pa.array(likeness(mine, following)),
                    ],
                    names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
                )

    return rows.mapInArrow(tidy(run), EDITED_DDL)
