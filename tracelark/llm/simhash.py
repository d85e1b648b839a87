"""SimHash near duplicates by balls that meet in the middle.

Two fingerprints within an even radius have a point within half of it of both,
so if each emits all variants within half the radius, the two meet at a
variant.  An odd radius has no middle: there, one quarter of the bits is left
out at a time.  The pair's differing bits lie in some quarter, and without it
an even radius is left over the 48 others.  For radius 3 that makes 4 * 49
variants a fingerprint.

Equal fingerprints are one node from the start.  Variants are shuffled once; a
variant of one fingerprint only goes no further.  Fingerprints that meet are
first compared with one hub of their variant, and only those still in different
components with each other, so a dense group does not form all its pairs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from .components import connected_components
from .tables import document_texts, narrow, written
from .textops import text_array, tidy

SEED = 42
BITS = 64
QUARTER = 16
#: Bytes of a text whose words are held at once.
PIECE = 1 << 20
SPACE = re.compile(rb"[\x20\x09-\x0D]")
#: A fingerprint with more rows than this gets its component by a broadcast; there are at most rows / HOT_ROWS of them.
HOT_ROWS = 10_000


def _shingles(text: bytes, width: int) -> Iterator[list[bytes]]:
    """Runs of ``width`` words joined by one space, a stretch of the text at a time; the whole sequence if it is shorter."""
    words, start, short = [], 0, True
    while start < len(text):
        cut = SPACE.search(text, start + PIECE) if start + PIECE < len(text) else None
        stop = cut.start() if cut else len(text)
        words += text[start:stop].split()
        start = stop
        if len(words) >= width:
            short = False
            yield [b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)]
            words = words[len(words) - width + 1 :]
    if short and words:
        yield [b" ".join(words)]


def fingerprint(text: bytes, width: int) -> int:
    """A bit is 1 if it is set in over half of the shingles' hashes; as a signed number."""
    ones, total = np.zeros(BITS, np.int64), 0
    for shingles in _shingles(text.lower(), width):
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.dtype("<u8"), len(shingles))
        for at in range(0, len(hashes), 1 << 16):
            part = hashes[at : at + (1 << 16)]
            ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(hashes)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, fp) of every document row."""

    def run(batches):
        for batch in batches:
            found = [fingerprint(t.as_buffer().to_pybytes(), width) for t in text_array(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], names=["doc_id", "fp"])

    return document_texts(docs).mapInArrow(tidy(run), "doc_id bigint, fp bigint")


def _without(quarter: int) -> Column:
    """The 48 bits outside a quarter, with its number on top."""
    fp, low = F.col("fp"), QUARTER * quarter
    above = F.lit(0).cast("bigint") if low + QUARTER == BITS else F.shiftleft(F.shiftrightunsigned(fp, low + QUARTER), low)
    return above.bitwiseOR(fp.bitwiseAND((1 << low) - 1)).bitwiseOR(F.lit(quarter << (BITS - QUARTER)))


def variants(nodes: DataFrame, radius: int) -> DataFrame:
    """(key, fp): all variants within half the radius, those of an odd radius without one quarter of the bits."""
    centres = F.array(*[_without(q) for q in range(BITS // QUARTER)]) if radius % 2 else F.array("fp")
    bits = BITS - QUARTER if radius % 2 else BITS
    flips = [sum(1 << i for i in chosen) for n in range(radius // 2 + 1) for chosen in combinations(range(bits), n)]
    signed = [f - (1 << BITS) if f >> (BITS - 1) else f for f in flips]
    masks = F.array(*[F.lit(f).cast("bigint") for f in signed])
    centred = nodes.select("fp", F.explode(centres).alias("centre"))
    return centred.select("fp", "centre", F.explode(masks).alias("flip")).select(F.col("centre").bitwiseXOR(F.col("flip")).alias("key"), "fp")


def _within(radius: int, a: str = "a", b: str = "b") -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= radius


def linked_components(nodes: DataFrame, radius: int) -> DataFrame:
    """(node, root) of the distinct fingerprints ``nodes`` (fp) that have another within ``radius`` bits."""
    at_key = Window.partitionBy("key")
    met = variants(nodes, radius).withColumns({"hub": F.min("fp").over(at_key), "last": F.max("fp").over(at_key)})
    met = written(met.where("hub <> last").select("key", "fp", "hub"), "variants")
    stars = met.where("fp <> hub").select(F.col("fp").alias("a"), F.col("hub").alias("b")).where(_within(radius)).distinct()
    links = written(stars, "links")
    roots = written(connected_components(links), "roots")
    rooted = met.select("key", "fp").join(roots, met.fp == roots.node, "left").select("key", "fp", F.coalesce("root", "fp").alias("root"))
    apart = rooted.withColumns({"low": F.min("root").over(at_key), "high": F.max("root").over(at_key)})
    apart = written(apart.where("low <> high").select("key", "fp", "root"), "apart")
    left = apart.select("key", F.col("fp").alias("a"), F.col("root").alias("ra"))
    right = apart.select("key", F.col("fp").alias("b"), F.col("root").alias("rb"))
    pairs = left.join(right, (left.key == right.key) & (F.col("a") < F.col("b")) & (F.col("ra") != F.col("rb")) & _within(radius))
    more = written(pairs.select("a", "b").distinct(), "links")
    return written(connected_components(links.union(more)), "roots") if more.take(1) else roots


def near_fingerprints(docs: DataFrame, width: int = 3, radius: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document row.

    Rows whose fingerprints differ in at most ``radius`` bits are linked; component_id
    is the smallest doc_id reachable (null if all of them are null).  A null or
    empty text, or one without words, has the fingerprint 0 and is linked like any other.  Repeated
    rows are in one component.  An empty table gives no rows.  Of ``docs``
    doc_id and text are read.
    """
    rows = written(fingerprints(docs, width), "fingerprints")
    nodes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies")), "nodes")
    roots = linked_components(nodes.select("fp"), radius)
    rooted = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "first", "copies", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = written(rooted.join(smallest, "root").select("fp", "copies", "component_id"), "classes")
    hot = classes.where(F.col("copies") > HOT_ROWS).drop("copies")
    rest = classes.where(F.col("copies") <= HOT_ROWS).drop("copies")
    spread = narrow(hot)
    placed = rows.join(spread, "fp").unionByName(rows.join(spread, "fp", "left_anti").join(rest, "fp"))
    return placed.select("doc_id", F.lower(F.lpad(F.hex("fp"), BITS // 4, "0")).alias("fingerprint"), "component_id")
