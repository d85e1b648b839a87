"""Byte-level language model by context-tree weighting, and smoothed unigram scores of words.

A byte is eight binary decisions; a decision's node is named by the last d bytes
and the bits of the byte so far.  In each node the Krichevsky-Trofimov estimate
says (ones + 1/2) / (decisions + 1).  The tree of all depths is weighted: with
KT(s) the estimate's probability of all training decisions in node s and

    Pw(s) = KT(s)                                       at the full depth,
    Pw(s) = KT(s) / 2 + (product of Pw(children)) / 2   above it,

a node answers itself with weight KT(s) / (2 Pw(s)) and leaves the rest to the
child named by the next older byte.  A child that was never seen leaves all to
its parent.  Texts begin after, and end with, a byte that UTF-8 never uses, so
the probabilities of all texts add up to one.

Counts are sums over all training rows, made and weighted by Spark jobs that
grow with the corpus; the nodes sent to the scoring tasks are those seen most
often, as many as ``NODES`` allows.  A node is seen at least as often as the
deeper ones below it, so a gram whose deepest nodes were all sent is answered in
the task; the others are written with the row and answered by joins with the
whole tree.  ``NODES`` decides about speed alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from .tables import document_texts, held_out, written
from .textops import LOWER, SPACE, chunks, text_array, tidy, word_hashes, word_spans

DEPTH = 4
END = 255
#: Bounds of what is sent to every task: nodes of the tree, and words looked up there (other grams and words are joined).
NODES = 2_000_000
FREQUENT = 500_000
#: Bytes of text handled at once; each byte takes some dozens of bytes of arrays.
STRETCH = 1 << 20
_SLOTS = 20
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def gram_keys(data: np.ndarray, offsets: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """The last ``depth`` bytes and the byte itself as one integer, of every byte and end of the rows; and rows' bounds."""
    size = np.diff(offsets)
    ends = np.concatenate([[0], np.cumsum(size + 1 + depth)])
    padded = np.full(int(ends[-1]), END, np.uint8)
    row = np.repeat(np.arange(len(size)), size)
    padded[np.arange(len(data)) + row * (depth + 1) + depth] = data
    keys = np.zeros(len(padded), np.int64)
    for back in range(depth, -1, -1):
        keys <<= 8
        if back:
            keys[back:] |= padded[:-back]
        else:
            keys |= padded
    real = np.ones(len(padded), bool)
    for i in range(depth):
        real[ends[:-1] + i] = False
    return keys[real], np.concatenate([[0], np.cumsum(size + 1)])


class _Counts:
    """Counts of integers, merged now and then."""

    def __init__(self, limit: int = 1 << 20):
        self.limit, self.held, self.parts = limit, 0, []

    def add(self, values: np.ndarray) -> None:
        if len(values):
            self.parts.append(np.unique(values, return_counts=True))
            self.held += len(self.parts[-1][0])
            if self.held > self.limit:
                self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        keys = np.concatenate([k for k, _ in self.parts])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], np.concatenate([c for _, c in self.parts])[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        merged = keys[first], np.add.reduceat(counts, first)
        self.parts, self.held = [merged], 0
        return merged


def counted(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(word, key, n): counts of word hashes (word true) and of byte grams (word false) over all rows of ``docs``."""

    def run(batches):
        words, grams = _Counts(), _Counts()
        for batch in batches:
            texts = text_array(batch)
            for _, _, data, offsets in chunks(texts, STRETCH, lower=False):
                grams.add(gram_keys(data, offsets, depth)[0])
            for _, _, data, offsets in chunks(texts):
                start, end, _ = word_spans(data, offsets, SPACE)
                words.add(word_hashes(data, start, end).view(np.int64))
        for flag, counts in ((True, words), (False, grams)):
            keys, numbers = counts.merge()
            for i in range(0, len(keys), 1 << 17):
                some = keys[i : i + (1 << 17)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(some), flag)), pa.array(some), pa.array(numbers[i : i + (1 << 17)].astype(np.int64))],
                    names=["word", "key", "n"],
                )

    parts = document_texts(docs).select("text").mapInArrow(tidy(run), "word boolean, key bigint, n bigint")
    return parts.groupBy("word", "key").agg(F.sum("n").alias("n"))


def _log_gamma(x: Column) -> Column:
    """Natural logarithm of the gamma function for x >= 1/2: Stirling's series at x + 8, then eight steps down."""
    y = x + 8
    product = x
    for i in range(1, 8):
        product = product * (x + i)
    series = 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y)
    return (y - 0.5) * F.log(y) - y + 0.9189385332046727 + series - F.log(product)


def _log_kt(zeros: Column, ones: Column) -> Column:
    """Logarithm of the estimate's probability of a sequence with these numbers of decisions; log(pi) = 2 log gamma(1/2)."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1.0) - 1.1447298858494002


def _decisions(key: str = "key") -> Column:
    """The eight decisions of a gram's last byte: the path to each and its bit."""
    byte = F.col(key).bitwiseAND(255)
    return F.array(
        *[
            F.struct(
                (F.lit(1 << i).bitwiseOR(F.shiftright(byte, 8 - i))).cast("bigint").alias("path"),
                F.shiftright(byte, 7 - i).bitwiseAND(1).alias("bit"),
            )
            for i in range(8)
        ]
    )


def _recent(context: str, d: int) -> Column:
    """The ``d`` most recent bytes of a context."""
    return F.col(context).bitwiseAND((1 << (8 * d)) - 1)


def levels(grams: DataFrame, depth: int = DEPTH) -> list[DataFrame]:
    """(context, path, n, one, weight) of the nodes of each depth, from 0 on, as written tables.

    Decisions in each node, probability of a one, and the weight of the node's own answer.
    """
    decisions = grams.select(F.shiftright("key", 8).alias("context"), "n", F.explode(_decisions()).alias("d"))
    level = decisions.groupBy("context", F.col("d.path").alias("path")).agg(
        F.sum(F.when(F.col("d.bit") == 0, F.col("n")).otherwise(0)).alias("zeros"),
        F.sum(F.when(F.col("d.bit") == 1, F.col("n")).otherwise(0)).alias("ones"),
    )
    level = level.withColumn("weighted", _log_kt(F.col("zeros"), F.col("ones"))).withColumn("weight", F.lit(1.0))
    result = []
    for d in range(depth, -1, -1):
        level = written(level, "tree")
        named = level.select(
            "context",
            "path",
            (F.col("zeros") + F.col("ones")).alias("n"),
            ((F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1)).cast("float").alias("one"),
            F.col("weight").cast("float").alias("weight"),
        )
        result.insert(0, named)
        if d:
            above = level.groupBy(_recent("context", d - 1).alias("context"), "path").agg(
                F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weighted").alias("below")
            )
            own = _log_kt(F.col("zeros"), F.col("ones")) - F.log(F.lit(2.0))
            rest = F.col("below") - F.log(F.lit(2.0))
            both = F.greatest("own", "rest") + F.log1p(F.exp(-F.abs(F.col("own") - F.col("rest"))))
            level = (
                above.withColumn("own", own)
                .withColumn("rest", rest)
                .withColumn("weighted", both)
                .select("context", "path", "zeros", "ones", "weighted", F.exp(F.col("own") - F.col("weighted")).alias("weight"))
            )
    return result


def node_table(tree: list[DataFrame]) -> DataFrame:
    """(key, n, one, weight) of the nodes of all levels.

    key = ((depth * 256**DEPTH + context) * 256 + 1 and the bits so far), the most recent context byte lowest.
    """
    result = None
    for d, level in enumerate(tree):
        key = (F.lit(d).cast("bigint") * (1 << 40)) + F.col("context") * 256 + F.col("path")
        named = level.select(key.alias("key"), "n", "one", "weight")
        result = named if result is None else result.unionByName(named)
    return result


def answers(tree: list[DataFrame]) -> list[DataFrame]:
    """(context, path, value) of each depth: the tree's probability of a one if no deeper node was seen.

    From the root on, a node adds weight * one to what its ancestors said and leaves the share 1 - weight to its child.
    """
    own, one = F.col("weight").cast("double"), F.col("one").cast("double")
    result, above = [], None
    for d, level in enumerate(tree):
        if above is None:
            level = level.withColumn("said", F.lit(0.0)).withColumn("left", F.lit(1.0))
        else:
            level = level.withColumn("__above", _recent("context", d - 1)).join(above, ["__above", "path"])
        level = written(
            level.select(
                "context",
                "path",
                (F.col("said") + F.col("left") * one).alias("value"),
                (F.col("said") + F.col("left") * own * one).alias("said"),
                (F.col("left") * (1 - own)).alias("left"),
            ),
            "answers",
        )
        above = level.select(F.col("context").alias("__above"), "path", "said", "left")
        result.append(level.select("context", "path", "value"))
    return result


def gram_logs(grams: DataFrame, tree: list[DataFrame]) -> DataFrame:
    """(key, log): log10 of the probability of each of these distinct grams' last byte, by joins with the whole tree."""
    values = answers(tree)
    depth = len(tree) - 1
    decisions = grams.select("key", F.shiftright("key", 8).alias("context"), F.explode(_decisions()).alias("d"))
    decisions = decisions.select("key", "context", "d.path", "d.bit")
    looked = written(decisions.join(values[depth], ["context", "path"], "left"), "decisions")
    known = looked.where(F.col("value").isNotNull()).select("key", "bit", "value")
    shallow = None
    for d in range(depth):
        level = values[d].select(F.lit(d).alias("depth"), "context", "path", "value")
        shallow = level if shallow is None else shallow.unionByName(level)
    if shallow is not None:
        contexts = F.array(*[F.struct(F.lit(d).alias("depth"), _recent("context", d).alias("context")) for d in range(depth)])
        sought = looked.where(F.col("value").isNull()).select("key", "path", "bit", F.explode(contexts).alias("c"))
        sought = sought.select("key", "path", "bit", "c.depth", "c.context").join(shallow, ["depth", "context", "path"], "left")
        deepest = F.max(F.when(F.col("value").isNotNull(), F.struct("depth", "value")))["value"]
        known = known.unionByName(
            sought.groupBy("key", "path", "bit").agg(F.coalesce(deepest, F.lit(0.5)).alias("value")).drop("path")
        )
    chance = F.when(F.col("bit") == 1, F.col("value")).otherwise(1 - F.col("value"))
    return known.groupBy("key").agg(F.sum(F.log10(chance)).alias("log"))


def _bounded(table: DataFrame, number: str, most: int) -> DataFrame:
    """Rows whose ``number`` reaches the smallest power of two that leaves at most ``most`` rows."""
    steps = {r.step: r.rows for r in table.groupBy(F.floor(F.log2(number)).alias("step")).agg(F.count("*").alias("rows")).collect()}
    total, least = 0, 64
    for step in sorted(steps, reverse=True):
        total += steps[step]
        if total > most:
            break
        least = step
    return table.where(F.col(number) >= F.pow(F.lit(2.0), F.lit(float(least))))


def _gathered(table: DataFrame, kinds: dict[str, type]) -> list[np.ndarray]:
    """Columns of a table of bounded size as arrays, moved as a few blobs instead of rows."""
    names = list(kinds)

    def run(batches):
        for batch in batches:
            blobs = [
                pa.array([np.ascontiguousarray(batch.column(i).to_numpy().astype(kinds[n])).tobytes()], pa.binary())
                for i, n in enumerate(names)
            ]
            yield pa.RecordBatch.from_arrays(blobs, names=names)

    rows = table.select(*names).mapInArrow(tidy(run), ", ".join(f"`{n}` binary" for n in names)).collect()
    return [np.frombuffer(b"".join(r[n] for r in rows), kinds[n]) for n in names]


@dataclass
class Tree:
    """Nodes in order of their keys, and remembered answers for grams seen lately (they change no result).

    If there are nodes besides these (not ``complete``), a gram whose deepest nodes are not all here has no answer (NaN).
    """

    keys: np.ndarray
    one: np.ndarray
    weight: np.ndarray
    depth: int = DEPTH
    complete: bool = True

    def __post_init__(self):
        self.slots = self.values = None

    def bits(self, grams: np.ndarray) -> np.ndarray:
        """log10 of the probability of each gram's last byte after its other bytes."""
        byte, context = grams & 255, grams >> 8
        total = np.zeros(len(grams))
        if not self.complete:
            # the last decision's node at the full depth is seen least of all the gram's nodes: with it all others are here
            last = (self.depth << 40) + context * 256 + (128 | (byte >> 1))
            place = np.minimum(np.searchsorted(self.keys, last), max(0, len(self.keys) - 1))
            whole = self.keys[place] == last if len(self.keys) else np.zeros(len(grams), bool)
            total[~whole] = np.nan
            if whole.any() and not whole.all():
                total[whole] = self.bits(grams[whole])
            if not whole.all():
                return total
        for i in range(8):
            path = (1 << i) | (byte >> (8 - i))
            bit = (byte >> (7 - i)) & 1
            answer = np.full(len(grams), 0.5)
            known = np.zeros(len(grams), bool)
            for d in range(self.depth, -1, -1):
                key = (d << 40) + (context & ((1 << (8 * d)) - 1)) * 256 + path
                place = np.minimum(np.searchsorted(self.keys, key), max(0, len(self.keys) - 1))
                found = self.keys[place] == key if len(self.keys) else np.zeros(len(grams), bool)
                own = self.one[place].astype(np.float64) if len(self.keys) else answer
                weight = self.weight[place].astype(np.float64) if len(self.keys) else answer
                mixed = np.where(known, weight * own + (1 - weight) * answer, own)
                answer = np.where(found, mixed, answer)
                known |= found
            total += np.log10(np.where(bit == 1, answer, 1 - answer))
        return total

    def score(self, grams: np.ndarray) -> np.ndarray:
        if self.slots is None:
            self.slots, self.values = np.full(1 << _SLOTS, -1, np.int64), np.zeros(1 << _SLOTS)
        slot = ((grams.view(np.uint64) * _SPREAD) >> np.uint64(64 - _SLOTS)).astype(np.int64)
        out = self.values[slot]
        missed = np.flatnonzero(self.slots[slot] != grams)
        if len(missed):
            unique, inverse = np.unique(grams[missed], return_inverse=True)
            fresh = self.bits(unique)
            out[missed] = fresh[inverse]
            place = ((unique.view(np.uint64) * _SPREAD) >> np.uint64(64 - _SLOTS)).astype(np.int64)
            self.slots[place], self.values[place] = unique, fresh
            # of several grams in one slot the last one wrote both arrays
        return out


_SCORED = (
    "row bigint, doc_id bigint, n_tokens bigint, n_known bigint, base double, score double, rare array<bigint>, "
    "grams array<struct<key:bigint,times:bigint>>"
)


def scored(docs: DataFrame, modulo: int = 10, depth: int = DEPTH, nodes: int = NODES, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every row of ``docs``.

    Learns from rows whose id is not held out (crc32 of the id modulo ``modulo``).
    n_tokens counts words and one end; base_score is the additive-0.1 unigram
    log10 probability.  A null text is empty: only its end is scored.  Without training
    rows every decision has probability 1/2.  Repeated rows count, and are scored, each.
    """
    spark = docs.sparkSession
    training = docs.where(~held_out(modulo))
    ends = training.count()
    counts = written(counted(training, depth), "counts")
    words, grams = counts.where("word").select("key", "n"), counts.where("not word").select("key", "n")
    totals = words.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    tokens, kinds = (totals.n or 0) + ends, totals.v + (1 if ends else 0)
    scale = tokens + 0.1 * (kinds + 1)
    every_level = levels(grams, depth)
    all_nodes = node_table(every_level)
    tree_nodes = _gathered(_bounded(all_nodes, "n", nodes), {"key": np.int64, "one": np.float32, "weight": np.float32})
    complete = all_nodes.count() == len(tree_nodes[0])
    order = np.argsort(tree_nodes[0], kind="stable")
    tree = spark.sparkContext.broadcast(Tree(*[x[order] for x in tree_nodes], depth, complete))
    common = _gathered(_bounded(words, "n", frequent), {"key": np.int64, "n": np.int64})
    order = np.argsort(common[0])
    lookup = spark.sparkContext.broadcast((common[0][order], common[1][order]))
    end_log = float(np.log10((ends + 0.1) / scale))

    def run(batches):
        model, (known, numbers) = tree.value, lookup.value
        logs = np.log10((numbers + 0.1) / scale)
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            texts = text_array(batch)
            for first, stop, data, offsets in chunks(texts, STRETCH, lower=False):
                grams, bounds = gram_keys(data, offsets, model.depth)
                count = stop - first
                answer = model.score(grams)
                asked = np.flatnonzero(np.isnan(answer))
                answer[asked] = 0.0
                score = np.add.reduceat(answer, bounds[:-1])
                asked_row = np.searchsorted(bounds, asked, "right") - 1
                order = np.lexsort((grams[asked], asked_row))
                asked_row, asked_key = asked_row[order], grams[asked][order]
                new = np.flatnonzero((np.diff(asked_row, prepend=-1) != 0) | (np.diff(asked_key, prepend=-1) != 0))
                times = np.diff(np.append(new, len(asked_key)))
                asked_edges = np.concatenate([[0], np.cumsum(np.bincount(asked_row[new], minlength=count))])
                joined = pa.StructArray.from_arrays([pa.array(asked_key[new]), pa.array(times)], names=["key", "times"])
                lowered = LOWER[data]
                start, end, edges = word_spans(lowered, offsets, SPACE)
                sizes = np.diff(edges)
                values, inverse = np.unique(word_hashes(lowered, start, end).view(np.int64), return_inverse=True)
                if len(known):
                    place = np.minimum(np.searchsorted(known, values), len(known) - 1)
                    found = known[place] == values
                    value_log = np.where(found, logs[place], 0.0)
                else:
                    found, value_log = np.zeros(len(values), bool), np.zeros(len(values))
                of_row = np.repeat(np.arange(count), sizes)
                base = np.bincount(of_row, weights=value_log[inverse], minlength=count) + end_log
                hits = np.bincount(of_row, weights=found[inverse], minlength=count).astype(np.int64) + (1 if ends else 0)
                rare = np.flatnonzero(~found[inverse])
                rare_edges = np.concatenate([[0], np.cumsum(np.bincount(of_row[rare], minlength=count))])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row, row + count)),
                        batch.column(0).slice(first, count),
                        pa.array(sizes + 1),
                        pa.array(hits),
                        pa.array(base),
                        pa.array(score),
                        pa.ListArray.from_arrays(pa.array(rare_edges, pa.int32()), pa.array(values[inverse[rare]], pa.int64())),
                        pa.ListArray.from_arrays(pa.array(asked_edges, pa.int32()), joined),
                    ],
                    names=["row", "doc_id", "n_tokens", "n_known", "base", "score", "rare", "grams"],
                )
                row += count

    rows = written(document_texts(docs).mapInArrow(tidy(run), _SCORED), "scored")
    rare = rows.select("row", F.explode("rare").alias("key")).groupBy("row", "key").agg(F.count("*").alias("times"))
    looked = rare.join(words, "key", "left")
    more = looked.groupBy("row").agg(
        F.sum(F.col("times") * F.log10((F.coalesce("n", F.lit(0)) + 0.1) / F.lit(scale))).alias("more"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("known"),
    )
    rows = rows.drop("rare")
    own = F.col("score")
    if not complete:
        asked = rows.select("row", F.explode("grams").alias("g")).select("row", "g.key", "g.times")
        logs = gram_logs(asked.select("key").distinct(), every_level)
        added = asked.join(logs, "key").groupBy("row").agg(F.sum(F.col("times") * F.col("log")).alias("added"))
        rows, own = rows.join(added, "row", "left"), own + F.coalesce("added", F.lit(0.0))
    return rows.drop("grams").join(more, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        own.alias("score"),
    )
