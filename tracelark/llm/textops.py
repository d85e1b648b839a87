"""Words and word shingles of Arrow text columns, as numpy arrays without a Python object per word.

Texts stay UTF-8 bytes.  A word's hash is a polynomial over a table of random
64-bit values modulo 2**64 with a mixing step at the end, so two different
words share a hash with a probability of about 2**-60; operators treat equal
hashes as equal words.  A null text is an empty one.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import lru_cache, wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once (one longer document is handled alone); numpy's working arrays are some 100 times that.
CHUNK = 256 << 10

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

#: Bytes that end a word: white space, or everything in ASCII but letters and digits.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_ALNUM = np.zeros(256, dtype=bool)
NOT_ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True

_PRIME = 0x9E3779B97F4A7C13
_BYTE_VALUES = np.random.Generator(np.random.PCG64(20240917)).integers(1, 2**63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every bit."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=1)
def _trim() -> Callable[[int], int]:
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError, TypeError):  # another C library
        return lambda pad: 0


def release() -> None:
    """Gives memory that numpy and Arrow have freed back to the system."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow: when a task ends, its worker gives memory it has freed back to the system.

    Workers wait for later tasks, and what numpy and Arrow freed would stay theirs beside the executor's heap.
    """

    @wraps(run)
    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return tidied


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_PRIME, -1, 2**64)
    up = np.full(size, _PRIME, dtype=np.uint64)
    down = np.full(size, inverse, dtype=np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def text_array(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    """The column with nulls as empty texts and 64-bit offsets."""
    column = batch.column(batch.schema.get_field_index(name))
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def chunks(texts: pa.Array, limit: int = CHUNK, lower: bool = True) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, their bytes with A-Z lowered, byte offsets of the rows)."""
    rows = len(texts)
    if not rows:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + rows + 1]
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    start = 0
    while start < rows:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        stop = min(rows, max(start + 1, stop))
        part = data[offsets[start] : offsets[stop]]
        yield start, stop, LOWER[part] if lower else part, offsets[start : stop + 1] - offsets[start]
        start = stop


def word_spans(data: np.ndarray, offsets: np.ndarray, ends_word: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end bytes of all words, and the number of words before each row (rows + 1 values)."""
    inside = ~ends_word[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    first[heads] |= inside[heads]
    tails = offsets[1:][offsets[1:] > 0] - 1
    last[tails] |= inside[tails]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(start, offsets)


class SpanHasher:
    """64-bit hashes of any spans of the same bytes."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(max(CHUNK, 1 << int(len(data)).bit_length()))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[data] * up[: len(data)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    return SpanHasher(data)(start, end) if len(start) else np.zeros(0, np.uint64)


_STEPS = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def shingle_hashes(hashes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words of each row, and the number of runs before each row.

    A row with fewer words has its whole sequence as the only run; one without words has none.
    """
    counts = np.diff(bounds)
    runs = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    ends = np.concatenate([[0], np.cumsum(runs)])
    total = int(ends[-1])
    if not total:
        return np.zeros(0, np.uint64), ends
    row = np.repeat(np.arange(len(counts)), runs)
    at = bounds[row] + (np.arange(total) - ends[row])
    value = np.zeros(total, np.uint64)
    length = np.minimum(counts, width)[row]
    for i in range(width):
        within = length > i
        if within.all():
            value += hashes[at + i] * _STEPS[i]
        else:
            value[within] += hashes[at[within] + i] * _STEPS[i]
    return mix(value + length.astype(np.uint64)), ends


def shingle_rows(texts: pa.Array, width: int, ends_word: np.ndarray = SPACE) -> Iterator[tuple[int, np.ndarray]]:
    """(words, hashes of the runs in order of the text) of each text in turn."""
    for _, _, data, offsets in chunks(texts):
        start, end, bounds = word_spans(data, offsets, ends_word)
        hashes, ends = shingle_hashes(word_hashes(data, start, end), bounds, width)
        for i in range(len(offsets) - 1):
            yield int(bounds[i + 1] - bounds[i]), hashes[ends[i] : ends[i + 1]]


def shingle_set(hashes: np.ndarray) -> np.ndarray:
    """The distinct values, ascending as signed 64-bit integers."""
    return np.unique(hashes.view(np.int64))


def overlap(left: np.ndarray, right: np.ndarray) -> int:
    """Size of the intersection of two ascending sets."""
    if len(left) > len(right):
        left, right = right, left
    if not len(left):
        return 0
    place = np.searchsorted(right, left)
    place[place == len(right)] = 0
    return int((right[place] == left).sum())
