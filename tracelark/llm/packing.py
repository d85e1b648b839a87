"""Packing of tokenised documents into fixed windows with a controlled mixture of sources.

Every source is a queue of tokens, dealt in quanta.  Deficit round-robin hands
the next quantum to the queue that is furthest behind its target, so after any
number of tokens a queue is about a quantum away from its share at most (until it
runs dry, when the others divide what it leaves).  That order needs no loop over
rounds or windows: quantum j of a queue with weight w is due at the time
(j + 1/2) / w, so the order of all quanta is a sort by that time.  Spark
partitions the quanta by ranges of it; what the ranges before have dealt is one
number per range, so deficits carry over windows, ranges and tasks, and neither
the driver nor a task holds a list of sources.  Quanta are sorted as places in
their documents; the ids are joined to the finished pieces.

A quantum is cut only where a document or a window ends, and quanta of one
document that follow each other are joined again.  So there are at most
documents + quanta + windows + ranges pieces, however many sources there are.
"""

from __future__ import annotations

import os
import zlib
from collections import defaultdict
from functools import lru_cache
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .tables import document_texts, narrow, written
from .textops import chunks, text_array, tidy

WINDOW = 2048
END_ID = 1
#: Tokens a queue gives at once: the shorter, the closer each window is to the targets, and the more pieces there are.
QUANTUM = 256
#: Words whose ids a worker remembers.
CACHED_WORDS = 500_000

PIECE_DDL = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, source string"
)


def _byte_letters() -> dict[int, str]:
    """Latin-1 characters as the letters that stand for their UTF-8 bytes in byte-level vocabularies."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    letter = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(256)}


class WordEncoder:
    """Token ids of texts by a tokenizer that never joins what ASCII white space separates.

    Each distinct word is tokenised once and remembered.  A word of Latin-1
    letters needs no normaliser but lower-casing, so it goes straight to the
    tokenizer's model; if the tokenizer is not of that kind (see ``_direct``), all words
    take its whole path.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.type = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.letters = _byte_letters()
        self.marks = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]  # found before letters are lowered
        self.direct = self._direct()
        self._clear()

    def _direct(self) -> bool:
        """Whether letters, marks and both together come out of the short path as out of the whole one."""
        words = ["word", "Word", "\xe9t\xe9", "\xc9t\xe9", "gr\xf6\xdfe"]
        whole = [self._whole(w) for w in words]
        return whole == [self._model(w.lower()) for w in words] and all(
            self._whole(w + m) == x + self._whole(m) for w, x in zip(words, whole) for m in ".,;:!?"
        )

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _model(self, word: str) -> list[int]:
        return [token.id for token in self.model.tokenize(word if word.isascii() else word.translate(self.letters))]

    def _clear(self) -> None:
        self.codes = defaultdict(count().__next__)  # words are numbered as they are first asked for
        self.learnt = 0
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.ids = np.zeros(0, self.type)

    def _learn(self) -> None:
        """Ids of the words numbered since the last call: of simple ones by tokenising, of others from their parts."""
        codes, new = self.codes, self._numbered(self.learnt)
        found: list[list[int]] = []
        whole: list[int] = []
        composed: list[int] = []
        parts: list[list[int]] = []
        i = 0
        while True:
            if i == len(new):  # parts of composed words may be new as well
                new += self._numbered(self.learnt + i)
                if i == len(new):
                    break
            word = new[i]
            stem = word[:-1] if word[-1] in ".,;:!?" else word
            ids: list[int] = []
            if self.direct and stem.isalpha() and (stem.isascii() or max(stem) <= "\xff"):
                low = stem.lower()
                if low != word:
                    composed.append(i)
                    parts.append([codes[low]] if stem is word or len(stem) == len(word) else [codes[low], codes[word[-1]]])
                else:
                    ids = self._model(word)
            else:
                whole.append(i)
            found.append(ids)
            i += 1
        if whole:
            encoded = self.tokenizer.encode_batch_fast([new[i] for i in whole], add_special_tokens=False)
            for i, e in zip(whole, encoded):
                found[i] = e.ids
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        starts = len(self.ids) + np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(found) else np.zeros(0, np.int64)
        self.starts = np.concatenate([self.starts, starts]).astype(np.int64)
        self.lengths = np.concatenate([self.lengths, lengths])
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(found), self.type, int(lengths.sum()))])
        if composed:
            sizes = np.fromiter(map(len, parts), np.int64, len(parts))
            ids, ends = self._gather(np.fromiter(chain.from_iterable(parts), np.int64, int(sizes.sum())))
            edges = ends[np.concatenate([[0], np.cumsum(sizes)])]
            at = self.learnt + np.array(composed)
            self.starts[at] = len(self.ids) + edges[:-1]
            self.lengths[at] = np.diff(edges)
            self.ids = np.concatenate([self.ids, ids])
        self.learnt = len(codes)

    def _numbered(self, first: int) -> list[str]:
        """The words with numbers from ``first`` on."""
        return list(islice(reversed(self.codes), len(self.codes) - first))[::-1]

    def _gather(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of coded words one after the other, and the number of ids before each word and at the end."""
        lengths = self.lengths[code]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return self.ids[np.repeat(self.starts[code] - ends[:-1], lengths) + np.arange(ends[-1])], ends

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after the other, and the number of ids of each text."""
        if len(self.codes) > CACHED_WORDS:
            self._clear()
        split = [self._words(self._folded(text)) for text in texts]
        counts = np.fromiter(map(len, split), np.int64, len(split))
        code = np.fromiter(map(self.codes.__getitem__, chain.from_iterable(split)), np.int64, int(counts.sum()))
        self._learn()
        ids, ends = self._gather(code)
        return ids, np.diff(ends[np.concatenate([[0], np.cumsum(counts)])])

    def _folded(self, text: str) -> str:
        """In small letters if the tokenizer makes no difference, so that fewer words are new."""
        if not self.direct:
            return text
        if not text.isascii():
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return text
        low = text.lower()
        return text if any(mark in low for mark in self.marks) else low

    @staticmethod
    def _words(text: str) -> list[str]:
        """Runs without white space; str.split also cuts at four control characters that are no white space to the tokenizer."""
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return [w for w in text.translate({9: " ", 10: " ", 11: " ", 12: " ", 13: " "}).split(" ") if w]
        return text.split()


@lru_cache(maxsize=1)
def word_encoder(path: str) -> WordEncoder:
    """One for all tasks of a worker process; what it remembers never changes a result."""
    return WordEncoder(path)


def tokenised(docs: DataFrame, tokenizer_path: str, end_id: int | None = END_ID) -> DataFrame:
    """part, row, doc_id, source, n, before, ids of every document row.

    ``before`` counts the tokens of the same source earlier in the same part;
    ``ids`` are little-endian unsigned integers of 16 bits (32 for larger vocabularies).
    """

    def run(batches):
        encoder = word_encoder(tokenizer_path)
        part, row, sums = TaskContext.get().partitionId(), 0, {}
        for batch in batches:
            texts = text_array(batch)
            sources = batch.column(2).to_pylist()
            for first, stop, _, _ in chunks(texts):
                ids, counts = encoder.encode(texts.slice(first, stop - first).to_pylist())
                ends = np.concatenate([[0], np.cumsum(counts)])
                blobs, sizes, before = [], [], []
                for i, source in enumerate(sources[first:stop]):
                    own = ids[ends[i] : ends[i + 1]]
                    if end_id is not None:
                        own = np.append(own, encoder.type(end_id))
                    blobs.append(own.tobytes())
                    sizes.append(len(own))
                    before.append(sums.get(source, 0))
                    sums[source] = before[-1] + len(own)
                count = stop - first
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(count, part, np.int64)),
                        pa.array(np.arange(row, row + count)),
                        batch.column(0).slice(first, count),
                        pa.array(sources[first:stop], pa.string()),
                        pa.array(sizes, pa.int64()),
                        pa.array(before, pa.int64()),
                        pa.array(blobs, pa.binary()),
                    ],
                    names=["part", "row", "doc_id", "source", "n", "before", "ids"],
                )
                row += count

    plain = document_texts(docs, F.col("source").cast("string").alias("source"))
    return plain.mapInArrow(tidy(run), "part bigint, row bigint, doc_id bigint, source string, n bigint, before bigint, ids binary")


def quanta(tokens: DataFrame, quantum: int) -> DataFrame:
    """due, source, place, part, row, doc_id, start, length, doc_tokens: the parts of documents in each quantum of their source.

    ``tokens`` has part, row, doc_id, source, n, first (tokens of the source before it) and weight.
    """
    whole = F.sequence(F.expr(f"first div {quantum}"), F.expr(f"(first + n - 1) div {quantum}"))
    begin = F.greatest(F.col("unit") * quantum, F.col("first"))
    end = F.least((F.col("unit") + 1) * quantum, F.col("first") + F.col("n"))
    return tokens.withColumn("unit", F.explode(whole)).select(
        ((F.col("unit") + 0.5) / F.col("weight")).alias("due"),
        "source",
        begin.alias("place"),
        "part",
        "row",
        "doc_id",
        (begin - F.col("first")).alias("start"),
        (end - begin).alias("length"),
        F.col("n").alias("doc_tokens"),
    )


_DEALT = "range bigint, at bigint, part bigint, row bigint, doc_id bigint, start bigint, length bigint, doc_tokens bigint, source string"


def dealt(units: DataFrame) -> DataFrame:
    """The quanta in the order they are due: range, tokens of the range before, and the piece; neighbours in a document are joined."""
    columns = ["part", "row", "doc_id", "start", "length", "doc_tokens", "source"]

    def run(batches):
        word_encoder.cache_clear()  # the tokens are written: a worker need not keep the words for what runs next
        number, given, held = TaskContext.get().partitionId(), 0, None

        def numbered(pieces, at):
            head = [pa.array(np.full(len(at), number, np.int64)), pa.array(at)]
            return pa.RecordBatch.from_arrays([*head, *pieces.columns], names=["range", "at", *columns])

        for batch in batches:
            batch = pa.RecordBatch.from_arrays(batch.columns, names=columns)  # all fields nullable, as in what is held
            if held is not None:  # the last piece so far, which may go on
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            if not batch.num_rows:
                continue
            part, row, start, length = (batch.column(i).to_numpy() for i in (0, 1, 3, 4))
            goes_on = (part[1:] == part[:-1]) & (row[1:] == row[:-1]) & (start[1:] == start[:-1] + length[:-1])
            first = np.flatnonzero(np.concatenate([[True], ~goes_on]))
            at = (given + np.cumsum(length) - length)[first]
            pieces = batch.take(pa.array(first))
            pieces = pieces.set_column(4, "length", pa.array(np.add.reduceat(length, first)))
            if len(first) > 1:
                yield numbered(pieces.slice(0, len(first) - 1), at[:-1])
            held, given = pieces.slice(len(first) - 1), int(at[-1])
        if held is not None:
            yield numbered(held, np.array([given], np.int64))

    order = ["due", "source", "place"]
    sorted_ = units.repartitionByRange(*order).sortWithinPartitions(*order)
    return sorted_.select(*columns).mapInArrow(tidy(run), _DEALT)


def cut_at_windows(pieces: DataFrame, before: dict[int, int], window: int) -> DataFrame:
    """Pieces cut where windows end; ``before`` has the tokens dealt before each range."""
    bases = pieces.sparkSession.createDataFrame(list(before.items()), "range bigint, base bigint")  # one row for each range
    placed = pieces.join(F.broadcast(bases), "range").withColumn("place", F.col("base") + F.col("at"))
    last = F.expr(f"(place + length - 1) div {window}")
    begin = F.greatest(F.col("window") * window, F.col("place"))
    end = F.least((F.col("window") + 1) * window, F.col("place") + F.col("length"))
    return placed.withColumn("window", F.explode(F.sequence(F.expr(f"place div {window}"), last))).select(
        "part",
        "row",
        "doc_id",
        (F.col("start") + begin - F.col("place")).alias("start"),
        (end - begin).alias("length"),
        "doc_tokens",
        F.col("window").alias("sequence_id"),
        (begin - F.col("window") * window).alias("offset"),
        "source",
    )


def with_checksums(pieces: DataFrame, tokens: DataFrame, width: int) -> DataFrame:
    """The pieces with the CRC-32 of their ids: each document's ids move once, to its pieces, and are cut before Python sees them."""

    def run(batches):
        for batch in batches:
            blobs = batch.column(7)
            ids = (np.frombuffer(blobs[i].as_buffer(), f"<u{width}").astype("<u4") for i in range(batch.num_rows))
            crc = pa.array([zlib.crc32(x) for x in ids], pa.int64())
            columns = [batch.column(i) for i in range(7)]
            yield pa.RecordBatch.from_arrays([*columns[:3], crc, *columns[3:]], names=names)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source"]
    own = F.expr(f"substring(t.ids, int(p.start * {width}) + 1, int(p.length * {width}))")
    joined = pieces.alias("p").join(tokens.select("part", "row", "ids").alias("t"), ["part", "row"])
    cut = joined.select("p.doc_id", "p.start", "p.length", "p.doc_tokens", "p.sequence_id", "p.offset", "p.source", own.alias("ids"))
    return cut.mapInArrow(tidy(run), PIECE_DDL)


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    window: int = WINDOW,
    targets: dict[str | None, float] | None = None,
    end_id: int | None = END_ID,
    quantum: int = QUANTUM,
) -> DataFrame:
    """One row per piece of a document: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source.

    ``targets`` are shares of tokens by source (default: each source's share of
    the corpus, so every window is the corpus in small, up to a quantum); a source
    without a target gets its share of the corpus.  All windows but the last are
    full.  A null text is empty (its only id is ``end_id``; without one it has no
    piece), a null source is a source, repeated rows are packed once each, no rows
    give no pieces.  The driver holds a number for each range of the sort.
    """
    spark = docs.sparkSession
    tokens = written(tokenised(docs, tokenizer_path, end_id), "tokens").where("n > 0")
    by_part = written(tokens.groupBy("part", "source").agg(F.sum("n").alias("n")), "queues")
    total = by_part.agg(F.sum("n").alias("n")).first().n
    if not total:
        return spark.createDataFrame([], PIECE_DDL)
    width = tokens.select(F.expr("int(length(ids) div n)").alias("width")).first().width  # the same in all rows

    asked = [(source, float(share)) for source, share in (targets or {}).items() if share > 0]
    asked = narrow(spark.createDataFrame(asked, "source string, target double"), len(asked)).alias("a")
    sizes = by_part.groupBy("source").agg(F.sum("n").alias("size")).alias("s")
    weight = F.coalesce("a.target", F.col("s.size") / F.lit(float(total)))
    weights = sizes.join(asked, F.col("s.source").eqNullSafe(F.col("a.source")), "left").select("s.source", weight.alias("weight"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = by_part.select("part", "source", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")).alias("p")
    parts = parts.join(weights.alias("w"), F.col("p.source").eqNullSafe(F.col("w.source")))
    bases = written(parts.select("part", "p.source", "base", "weight"), "bases")
    placed = tokens.alias("t").join(
        narrow(bases).alias("b"), (F.col("t.part") == F.col("b.part")) & F.col("t.source").eqNullSafe(F.col("b.source"))
    )
    first = (F.col("base") + F.col("before")).alias("first")
    placed = placed.select("t.part", "row", "doc_id", "t.source", "n", first, "weight")
    pieces = written(dealt(quanta(placed, quantum)), "dealt")
    before, given = {}, 0
    for r in pieces.groupBy("range").agg(F.sum("length").alias("n")).orderBy("range").collect():
        before[r.range] = given
        given += r.n
    return with_checksums(cut_at_windows(pieces, before, window), tokens, width)
