"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact containment.

A short item inside a long document has a tiny Jaccard similarity with it, so
documents are cut into windows that fit the items.  Items are partitioned by
their number of shingles; the partition with upper bound u looks at windows of
2 * 1.25 * u shingles that overlap by half, so every passage of an item's length
lies whole in one window and a window is never much larger than the item.  An
item is a candidate for a document when one of its 32 minima is the minimum of a
window; with a contained share of 0.8 the similarity with that window is 0.2 or
more, so an item is missed with a probability below 0.001.  Items of up to four
shingles would have windows too wide for that: every document that holds one of
their shingles is a candidate, so none is missed.  Candidates are confirmed by
counting the item's shingles in the whole document.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .neardup import ratio
from .tables import TEXT_HASH, document_texts, narrow, text_hash, written
from .textops import NOT_ALNUM, chunks, overlap, shingle_hashes, shingle_set, text_array, tidy, word_hashes, word_spans

PERMUTATIONS = 32
GROWTH = 1.5
#: Items of at most so many shingles are looked up by each of them instead of by minima.
FEW = 4
#: Items are searched in blocks of about this many shingles, so what is sent to the executors is bounded.
BLOCK = 1_000_000

_random = np.random.Generator(np.random.PCG64(3))
_FACTORS = _random.integers(0, 2**63, PERMUTATIONS).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _random.integers(0, 2**63, PERMUTATIONS).astype(np.uint64)


def size_class(size: int) -> int:
    """The smallest c with GROWTH**c >= size."""
    return max(0, math.ceil(math.log(max(1, size), GROWTH) - 1e-9))


def half_window(c: int) -> int:
    return max(4, math.ceil(1.25 * GROWTH**c))


def item_sets(items: DataFrame, width: int, id_name: str = "item_id") -> DataFrame:
    """item_id, width (fewer for shorter items), n and values (ascending set as bytes) of items with words."""

    def run(batches):
        for batch in batches:
            widths, sizes, blobs = [], [], []
            for _, _, data, offsets in chunks(text_array(batch)):
                start, end, bounds = word_spans(data, offsets, NOT_ALNUM)
                hashes = word_hashes(data, start, end)
                for i in range(len(offsets) - 1):
                    own = hashes[bounds[i] : bounds[i + 1]]
                    used = min(width, len(own))
                    values = shingle_set(shingle_hashes(own, np.array([0, len(own)]), max(1, used))[0])
                    widths.append(used)
                    sizes.append(len(values))
                    blobs.append(values.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(widths, pa.int64()), pa.array(sizes, pa.int64()), pa.array(blobs, pa.binary())],
                names=["item_id", "width", "n", "values"],
            )

    plain = items.select(F.col(id_name).cast("bigint").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    return plain.mapInArrow(tidy(run), "item_id bigint, width bigint, n bigint, values binary").where("n > 0").distinct()


class Index:
    """The minima of a block of items by shingle width and size class, and all shingles of items of few."""

    def __init__(self, ids: list[int | None], widths: list[int], values: list[np.ndarray]):
        self.ids, self.values = ids, values
        groups: dict[tuple[int, int], list[int]] = {}
        few: dict[int, list[int]] = {}
        for i, (width, own) in enumerate(zip(widths, values)):
            if len(own) <= FEW:
                few.setdefault(width, []).append(i)
            else:
                groups.setdefault((width, size_class(len(own))), []).append(i)
        self.widths = sorted({width for width, _ in groups} | set(few))
        self.few = {}
        for width, members in few.items():
            hashes = np.concatenate([values[i].view(np.uint64) for i in members])
            order = np.argsort(hashes, kind="stable")
            seen = np.zeros(1 << 20, bool)
            seen[hashes >> np.uint64(44)] = True
            self.few[width] = seen, hashes[order], np.repeat(members, [len(values[i]) for i in members])[order]
        self.groups = {}
        for (width, c), members in groups.items():
            slots = []
            for p in range(PERMUTATIONS):
                minima = np.array([(values[i].view(np.uint64) * _FACTORS[p] + _SHIFTS[p]).min() for i in members])
                order = np.argsort(minima, kind="stable")
                seen = np.zeros(1 << 16, bool)
                seen[minima >> np.uint64(48)] = True
                slots.append((seen, minima[order], np.array(members)[order]))
            self.groups.setdefault(width, []).append((half_window(c), slots))

    def candidates(self, width: int, hashes: np.ndarray, ends: np.ndarray) -> set[tuple[int, int]]:
        """(row, item) pairs whose minima meet in a window, or that share a shingle of an item of few."""
        found: set[tuple[int, int]] = set()
        runs = np.diff(ends)
        rows = np.flatnonzero(runs)
        if not len(rows):
            return found
        if width in self.few:
            seen, sought, members = self.few[width]
            maybe = np.flatnonzero(seen[hashes >> np.uint64(44)])
            left = np.searchsorted(sought, hashes[maybe], "left")
            right = np.searchsorted(sought, hashes[maybe], "right")
            hit = right > left
            row_of = np.searchsorted(ends, maybe[hit], "right") - 1
            for row, a, b in zip(row_of.tolist(), left[hit], right[hit]):
                found.update((row, int(m)) for m in members[a:b])
        if width not in self.groups:
            return found
        cuts = []
        for half, slots in self.groups[width]:
            blocks = -(-runs[rows] // half)
            first = np.concatenate([[0], np.cumsum(blocks)])
            row = np.repeat(np.arange(len(rows)), blocks)
            begin = ends[:-1][rows][row] + (np.arange(first[-1]) - first[row]) * half
            cuts.append((slots, begin, rows[row], row[1:] == row[:-1]))
        for p in range(PERMUTATIONS):
            moved = hashes * _FACTORS[p] + _SHIFTS[p]
            for slots, begin, row, same in cuts:
                seen, minima, members = slots[p]
                low = np.minimum.reduceat(moved, begin)
                # the window of a block is it and the next one of its row; the last block alone is part of the one before
                low[:-1][same] = np.minimum(low[:-1][same], low[1:][same])
                maybe = np.flatnonzero(seen[low >> np.uint64(48)])
                if len(maybe):
                    left = np.searchsorted(minima, low[maybe], "left")
                    right = np.searchsorted(minima, low[maybe], "right")
                    for at, a, b in zip(maybe[right > left], left[right > left], right[right > left]):
                        found.update((int(row[at]), int(m)) for m in members[a:b])
        return found


def _search(index, top: int, bottom: int):
    def run(batches):
        own = index.value
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            keys = [batch.column(0), batch.column(1)]
            for first, _, data, offsets in chunks(text_array(batch)):
                start, end, bounds = word_spans(data, offsets, NOT_ALNUM)
                words = word_hashes(data, start, end)
                for width in own.widths:
                    hashes, ends = shingle_hashes(words, bounds, width)
                    sets: dict[int, np.ndarray] = {}
                    for row, item in sorted(own.candidates(width, hashes, ends)):
                        if row not in sets:
                            sets[row] = shingle_set(hashes[ends[row] : ends[row + 1]])
                        values = own.values[item]
                        both = overlap(sets[row], values)
                        if both * bottom >= top * len(values):
                            for column, value in zip(out, (first + row, item, len(values), both, both / len(values))):
                                column.append(value)
            at = pa.array(out[0], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [keys[0].take(at), keys[1].take(at), pa.array([own.ids[i] for i in out[1]], pa.int64())]
                + [pa.array(out[2], pa.int64()), pa.array(out[3], pa.int64()), pa.array(out[4], pa.float64())],
                names=["doc_id", TEXT_HASH, "item_id", "n_item", "n_shared", "containment"],
            )

    return run


def contained_items(docs: DataFrame, items: DataFrame, width: int = 5, containment: float = 0.8) -> DataFrame:
    """doc_id, text hash, item_id, n_item, n_shared, containment: one row for each document row and item it contains.

    An item is contained when at least this share of its distinct runs of
    ``width`` words (letters and digits, A-Z lowered) stands in the document; an
    item of fewer words is one run.  Null, empty or wordless items and documents
    are in no row; repeated items count once, repeated documents each.  Items are
    searched in blocks of bounded size, so documents are read once per block.
    """
    spark = docs.sparkSession
    top, bottom = ratio(containment)
    sets = written(item_sets(items, width), "items")
    total = sets.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-total // BLOCK))
    plain = document_texts(docs).select("doc_id", text_hash().alias(TEXT_HASH), "text")
    ddl = f"doc_id bigint, {TEXT_HASH} bigint, item_id bigint, n_item bigint, n_shared bigint, containment double"
    result = None
    for block in range(blocks):
        part = sets.where(F.pmod(F.xxhash64("values"), F.lit(blocks)) == block).orderBy("item_id", "values").collect()
        index = Index([r.item_id for r in part], [r.width for r in part], [np.frombuffer(r["values"], np.int64) for r in part])
        found = plain.mapInArrow(tidy(_search(spark.sparkContext.broadcast(index), top, bottom)), ddl)
        result = found if result is None else result.unionByName(found)
    return result


def without_contaminated(docs: DataFrame, items: DataFrame, width: int = 5, containment: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that contain no item; all columns stay."""
    found = written(contained_items(docs, items, width, containment).select("doc_id", TEXT_HASH).distinct(), "contaminated")
    other = found.select(F.col("doc_id").alias("__other"), F.col(TEXT_HASH).alias("__other_hash"))
    keyed = docs.withColumn(TEXT_HASH, text_hash()).withColumn("__id", F.col("doc_id").cast("bigint"))
    same = F.col("__id").eqNullSafe(F.col("__other")) & (F.col(TEXT_HASH) == F.col("__other_hash"))
    return keyed.join(narrow(other), same, "left_anti").select(*docs.columns)
