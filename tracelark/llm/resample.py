"""Importance resampling: draw the documents whose hashed n-grams look most like a target's.

A chunk of texts is joined to one buffer with a sentinel between documents.  One
regular expression pass over it finds all words; ``searchsorted`` over the
documents' offsets gives each word its document, masks the n-grams that would
run over a sentinel, and ``bincount`` adds up buckets or weights.

Two passes over the documents: bucket counts first (one table of ``buckets``
rows, whatever the input), then each document's weight.  The draw adds seeded
Gumbel noise and takes the highest scores, which samples without replacement in
proportion to the weights; ranks come from one range partitioning, so no task
sees all documents.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .tables import document_texts, written
from .textops import text_array, tidy

#: Bytes of text joined at once; a longer document is taken in pieces of about this size.
JOINED = 512 << 10
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Cuts a long text where no word is (A-Z are lowered before, so they are no separators here).
BETWEEN = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
#: Ends a word, so none runs into the next document.
SENTINEL = b"\x00"

#: Rows of a partition in the numbers of ``monotonically_increasing_id``.
ROW_BITS = 33


def _groups(texts: pa.Array) -> Iterator[tuple[list[int], list[bytes]]]:
    """(rows, their lowered bytes) to be joined; a row in several groups in turn is a long text in pieces."""
    rows, parts, size = [], [], 0
    for row, text in enumerate(texts):
        data = text.as_buffer().to_pybytes().lower()
        if rows and size + len(data) > JOINED:
            yield rows, parts
            rows, parts, size = [], [], 0
        start = 0
        while len(data) - start > JOINED:
            cut = BETWEEN.search(data, start + JOINED)
            stop = cut.start() if cut else len(data)
            yield [row], [data[start:stop]]
            start = stop
        rows.append(row)
        parts.append(data[start:])
        size += len(data) - start
    if rows:
        yield rows, parts


def features(texts: pa.Array, longest: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row of each word, row of each feature, bucket of each feature) of a group of texts at a time.

    Features are all runs of 1 to ``longest`` words of one text, joined by one space.
    """
    carried_row, carried = -1, []
    for rows, parts in _groups(texts):
        offsets = np.fromiter(accumulate((len(p) + 1 for p in parts[:-1]), initial=0), np.int64, len(parts))
        found = [(m.start(), m.group()) for m in WORD.finditer(SENTINEL.join(parts))]
        words = [w for _, w in found]
        starts = np.fromiter((s for s, _ in found), np.int64, len(found))
        owner = np.array(rows, np.int64)[np.searchsorted(offsets, starts, "right") - 1]
        # words of the last piece of the same text, so that runs go on over the cut
        before = carried if rows[0] == carried_row else []
        every = before + words
        owners = np.concatenate([np.full(len(before), rows[0], np.int64), owner])
        feature_rows, hashes = [], []
        for n in range(1, longest + 1):
            last = np.arange(max(len(before), n - 1), len(every))
            last = last[owners[last] == owners[last - (n - 1)]]
            feature_rows.append(owners[last])
            runs = words if n == 1 else (b" ".join(every[i - n + 1 : i + 1]) for i in last.tolist())
            hashes.append(np.fromiter(map(zlib.crc32, runs), np.int64, len(last)))
        yield owner, np.concatenate(feature_rows), np.concatenate(hashes) % buckets
        carried_row = rows[-1]
        own = (owners == carried_row).sum()
        carried = every[len(every) - min(own, longest - 1) :] if longest > 1 else []


def bucket_counts(texts: DataFrame, longest: int = 1, buckets: int = 10_000) -> DataFrame:
    """(bucket, n): features of all rows of ``text`` by bucket; one row per task and bucket is shuffled."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, found in features(text_array(batch), longest, buckets):
                total += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held], pa.int64())], names=["bucket", "n"])

    return texts.select("text").mapInArrow(tidy(run), "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = 10_000) -> np.ndarray:
    """What a feature of each bucket adds to a document's weight, in thousandths of a nat.

    floor(1000 ln of the ratio of the smoothed shares in target and documents).  The driver holds ``buckets`` numbers.
    """
    held = np.zeros((2, buckets), np.int64)
    for side, table in enumerate((docs, target)):
        for bucket, n in bucket_counts(table, longest, buckets).collect():
            held[side, bucket] = n
    own, asked = held.sum(axis=1) + buckets
    return np.array(
        [
            math.floor(1000 * math.log((float(t) + 1) * float(own) / ((float(s) + 1) * float(asked))))
            for s, t in zip(*held.tolist())
        ],
        np.int64,
    )


def weighed(docs: DataFrame, gain: np.ndarray, longest: int = 1) -> DataFrame:
    """doc_id, n_words, n_features and weight (the sum of its features' gains) of every document row."""

    def run(batches):
        for batch in batches:
            size = batch.num_rows
            counts = np.zeros((3, size), np.int64)
            for word_rows, rows, found in features(text_array(batch), longest, len(gain)):
                counts[0] += np.bincount(word_rows, minlength=size)
                counts[1] += np.bincount(rows, minlength=size)
                # sums of whole numbers, exact in doubles
                counts[2] += np.bincount(rows, weights=gain[found], minlength=size).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts)], names=["doc_id", "n_words", "n_features", "weight"]
            )

    return document_texts(docs).mapInArrow(tidy(run), "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths from the id alone: the same in every run and on every machine."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))


def resampled(
    docs: DataFrame,
    target: DataFrame,
    longest: int = 1,
    buckets: int = 10_000,
    least_words: int = 20,
    percent: int = 10,
    seed: int = 2024,
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every document row.

    Of the rows with ``least_words`` words or more, the ``percent`` with the
    highest scores are drawn and get ranks 1, 2, 3...; ties go to the smaller
    doc_id (nulls last), then to fewer features and the smaller weight.  Other rows have no rank.  A null or
    empty text has no words, no features and the weight 0; a null doc_id is
    hashed as an empty one; repeated rows are drawn one by one.  An empty table
    gives no rows; an empty target leaves the smoothing alone.  Of ``docs``
    doc_id and text are read, of ``target`` text.
    """
    gain = gains(docs, target, longest, buckets)
    scored = written(weighed(docs, gain, longest).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "scored")
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), "n_features", "weight"]
    eligible = scored.where(F.col("n_words") >= least_words)
    in_order = eligible.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(in_order.withColumn("__place", F.monotonically_increasing_id()), "ranked")
    # one number per range: as many as there are partitions
    part = F.shiftright("__place", ROW_BITS)
    sizes = sorted(tuple(r) for r in placed.groupBy(part.alias("part")).count().collect())
    drawn = percent * sum(n for _, n in sizes) // 100
    before = accumulate((n for _, n in sizes), initial=0)
    firsts = docs.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(sizes, before)], "__part bigint, __before bigint")
    rank = F.col("__before") + F.col("__place").bitwiseAND((1 << ROW_BITS) - 1) + 1
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    ranked = placed.join(F.broadcast(firsts), part == F.col("__part")).select(*columns, F.when(rank <= drawn, rank).alias("rank"))
    others = scored.where(F.col("n_words") < least_words)
    return ranked.unionByName(others.select(*columns, F.lit(None).cast("bigint").alias("rank")))
