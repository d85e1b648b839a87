"""Language of words in mixed text by a linear-chain conditional random field.

The score of a label at a word is a sum of learned weights of its features:
character trigrams, affixes and, for words of the lexicon (seen often enough in
training), the word itself.  Learned transition weights link neighbours, and
forward-backward gives each word's distribution over the labels.  Chains have
32 words.  A document's language is the label with the largest mean probability.

Training data are spans of labelled documents, half of them spliced from
documents of different languages, so that transitions learn to switch.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .tables import TEXT_HASH, document_texts, held_out, narrow, text_hash, written
from .textops import SpanHasher, chunks, mix, release, text_array, tidy, word_spans

CHAIN = 32
#: Scoring takes so many words at a time, with so many more on both sides, whose messages reach them but which are answered elsewhere.
KEPT, MARGIN = 128, 32
#: Letters of a training word; longer ones (whole sentences where none separate words) are several words.
WORD = 200
BITS = 16
#: Bounds of the sample the model is fitted to: documents of a language, spans of a document.
DOCUMENTS = 300
SPANS = 12
UNKNOWN = "und"

_NOT_LETTER = np.ones(256, dtype=bool)
_NOT_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)]] = False
_AFFIXES = ((2, True), (4, True), (2, False), (4, False))


def _buckets(hashes: np.ndarray, family: int) -> np.ndarray:
    return (mix(hashes + np.uint64(family * 0xD1B54A32D192ED03 % 2**64)) >> np.uint64(64 - BITS)).astype(np.int64)


def word_features(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Trigram buckets of all words one after the other, where each word's begin, affix buckets [words, 4], whole hashes."""
    size = end - start
    first = np.concatenate([[0], np.cumsum(size)])
    row = np.repeat(np.arange(len(size)), size)
    at = np.arange(first[-1]) - first[row]  # the trigram's middle letter
    here = start[row] + at
    padded = np.concatenate([data, [0]]).astype(np.uint64)
    left = np.where(at == 0, np.uint64(1), padded[here - 1])
    right = np.where(at == size[row] - 1, np.uint64(2), padded[here + 1])
    trigrams = _buckets((left << np.uint64(16)) | (padded[here] << np.uint64(8)) | right, 1)
    hasher = SpanHasher(data)
    affixes = np.stack(
        [
            _buckets(hasher(start, np.minimum(start + k, end)) if front else hasher(np.maximum(end - k, start), end), 2 + i)
            for i, (k, front) in enumerate(_AFFIXES)
        ],
        axis=1,
    )
    return trigrams, first[:-1], affixes, hasher(start, end)


@dataclass
class Model:
    """Weights of a trained field; picklable, of fixed size but for the lexicon of the bounded sample."""

    labels: list[str]
    weights: np.ndarray  # [2**BITS + 1 + words of the lexicon, labels]
    lexicon: np.ndarray  # ascending hashes
    transitions: np.ndarray

    def lexicon_rows(self, hashes: np.ndarray) -> np.ndarray:
        """Rows of ``weights`` of whole words; words out of the lexicon share a row."""
        if not len(self.lexicon):
            return np.full(len(hashes), 1 << BITS)
        place = np.minimum(np.searchsorted(self.lexicon, hashes), len(self.lexicon) - 1)
        return np.where(self.lexicon[place] == hashes, (1 << BITS) + 1 + place, 1 << BITS)

    def scores(self, features) -> np.ndarray:
        trigrams, first, affixes, whole = features
        out = self.weights[self.lexicon_rows(whole)] + self.weights[affixes].sum(1)
        return out + np.add.reduceat(self.weights[trigrams], first) if len(first) else out


def forward_backward(scores: np.ndarray, present: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors [chains, steps, labels] and expected transition counts, of chains whose words are the leading ``present`` ones."""
    chains, steps, labels = scores.shape
    move = np.exp(transitions - transitions.max())
    local = np.exp(scores - scores.max(2, keepdims=True))
    forward = np.empty_like(local)
    backward = np.ones_like(local)
    forward[:, 0] = local[:, 0] / local[:, 0].sum(1, keepdims=True)
    for t in range(1, steps):
        step = (forward[:, t - 1] @ move) * local[:, t]
        step /= step.sum(1, keepdims=True)
        forward[:, t] = np.where(present[:, t, None], step, forward[:, t - 1])
    for t in range(steps - 2, -1, -1):
        step = (local[:, t + 1] * backward[:, t + 1]) @ move.T
        step /= step.sum(1, keepdims=True)
        backward[:, t] = np.where(present[:, t + 1, None], step, 1.0)
    posterior = forward * backward
    posterior /= posterior.sum(2, keepdims=True)
    pairs = np.zeros((labels, labels))
    for t in range(1, steps):
        ahead = local[:, t] * backward[:, t]
        joint = forward[:, t - 1, :, None] * move[None] * ahead[:, None, :]
        joint /= joint.sum((1, 2), keepdims=True)
        pairs += joint[present[:, t]].sum(0)
    return posterior, pairs


def fit(spans: list[str], langs: list[str], rounds: int = 40, chains: int = 6000, seed: int = 5) -> Model:
    """Maximum likelihood by Adam with a small quadratic penalty; the same sample gives the same model."""
    labels = sorted(set(langs))
    code = {label: i for i, label in enumerate(labels)}
    texts = pa.array(spans, pa.large_string())
    pieces, offset, bounds = [], 0, [np.zeros(1, np.int64)]
    starts, ends = [], []
    for _, _, data, offsets in chunks(texts):
        start, end, edge = word_spans(data, offsets, _NOT_LETTER)
        bounds.append(edge[1:] + sum(map(len, starts)))
        starts.append(start + offset)
        ends.append(end + offset)
        pieces.append(data)
        offset += len(data)
    data, start, end, edge = np.concatenate(pieces), np.concatenate(starts), np.concatenate(ends), np.concatenate(bounds)
    words = SpanHasher(data)(start, end)
    kinds, index, inverse, counts = np.unique(words, return_index=True, return_inverse=True, return_counts=True)
    filled = np.flatnonzero(np.diff(edge))
    by_label = {c: filled[[code[langs[i]] == c for i in filled]] for c in range(len(labels))}
    by_label = {c: own for c, own in by_label.items() if len(own)}
    random = np.random.Generator(np.random.PCG64(seed))
    at = np.full((chains, CHAIN), -1, np.int64)
    gold = np.zeros((chains, CHAIN), np.int64)
    present_labels = sorted(by_label)
    for i in range(chains):
        place = 0
        while place < CHAIN:
            label = present_labels[random.integers(len(present_labels))]
            own = by_label[label]
            span = own[random.integers(len(own))]
            length = min(CHAIN - place, int(edge[span + 1] - edge[span]))
            if i % 2:
                length = min(length, int(random.integers(4, CHAIN)))
            begin = edge[span] + random.integers(edge[span + 1] - edge[span] - length + 1)
            at[i, place : place + length] = np.arange(begin, begin + length)
            gold[i, place : place + length] = label
            place += length
            if not i % 2:
                break
    present = at >= 0
    features = word_features(data, start[index], end[index])
    lexicon = kinds[counts >= 3]
    model = Model(labels, np.zeros(((1 << BITS) + 1 + len(lexicon), len(labels))), lexicon, np.zeros((len(labels), len(labels))))
    trigrams, first, affixes, whole = features
    lexical = model.lexicon_rows(whole)
    sizes = np.diff(np.concatenate([first, [len(trigrams)]]))
    word = np.where(present, inverse[np.maximum(at, 0)], 0)
    onehot = np.eye(len(labels))[gold] * present[..., None]
    both = present[:, 1:] & present[:, :-1]
    gold_pairs = np.zeros((len(labels), len(labels)))
    np.add.at(gold_pairs, (gold[:, :-1][both], gold[:, 1:][both]), 1)
    total = present.sum()
    state = [np.zeros_like(x) for x in (model.weights, model.weights, model.transitions, model.transitions)]
    for r in range(1, rounds + 1):
        scores = model.scores(features)[word] * present[..., None]
        posterior, pairs = forward_backward(scores, present, model.transitions)
        error = (posterior * present[..., None] - onehot).reshape(-1, len(labels)) / total
        slope = np.zeros_like(model.weights)
        for label in range(len(labels)):
            own = np.bincount(word.ravel(), weights=error[:, label], minlength=len(kinds))
            slope[:, label] += np.bincount(trigrams, weights=np.repeat(own, sizes), minlength=len(slope))
            slope[:, label] += np.bincount(affixes.ravel(), weights=np.repeat(own, affixes.shape[1]), minlength=len(slope))
            slope[:, label] += np.bincount(lexical, weights=own, minlength=len(slope))
        slope += 1e-6 * model.weights
        turn = (pairs - gold_pairs) / total + 1e-6 * model.transitions
        for value, grad, m, v in ((model.weights, slope, state[0], state[1]), (model.transitions, turn, state[2], state[3])):
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            value -= 0.1 * (m / (1 - 0.9**r)) / (np.sqrt(v / (1 - 0.99**r)) + 1e-10)
    model.weights = model.weights.astype(np.float32)
    model.transitions = model.transitions.astype(np.float32)
    return model


def word_posteriors(model: Model, data: np.ndarray, offsets: np.ndarray):
    """Start and end bytes of words, their bounds by row, and posteriors [words, labels]."""
    start, end, bounds = word_spans(data, offsets, _NOT_LETTER)
    if not len(start):
        return start, end, bounds, np.zeros((0, len(model.labels)), np.float32)
    _, index, inverse = np.unique(SpanHasher(data)(start, end), return_index=True, return_inverse=True)
    scores = model.scores(word_features(data, start[index], end[index]))
    counts = np.diff(bounds)
    parts = -(-counts // KEPT)
    first = np.concatenate([[0], np.cumsum(parts)])
    row = np.repeat(np.arange(len(counts)), parts)
    begin = bounds[row] + (np.arange(first[-1]) - first[row]) * KEPT
    head = np.maximum(begin - MARGIN, bounds[row])
    tail = np.minimum(begin + KEPT + MARGIN, bounds[row + 1])
    out = np.empty((len(start), len(model.labels)), np.float32)
    # chains of like length together, many at a time, but not more than fit in memory for any number of labels
    order = np.argsort(tail - head, kind="stable")
    step = max(1, (1 << 21) // ((KEPT + 2 * MARGIN) * len(model.labels)))
    for i in range(0, len(order), step):
        some = order[i : i + step]
        own = head[some, None] + np.arange((tail - head)[some[-1]])
        present = own < tail[some, None]
        part = scores[inverse[np.where(present, own, 0)]] * present[..., None]
        kept = present & (own >= begin[some, None]) & (own < begin[some, None] + KEPT)
        out[own[kept]] = _posteriors(part, present, model.transitions)[kept]
    return start, end, bounds, out


def _posteriors(scores: np.ndarray, present: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """As forward_backward, without the transition counts."""
    steps = scores.shape[1]
    move = np.exp(transitions - transitions.max())
    local = np.exp(scores - scores.max(2, keepdims=True))
    forward = np.empty_like(local)
    forward[:, 0] = local[:, 0] / local[:, 0].sum(1, keepdims=True)
    for t in range(1, steps):
        step = (forward[:, t - 1] @ move) * local[:, t]
        step /= step.sum(1, keepdims=True)
        forward[:, t] = np.where(present[:, t, None], step, forward[:, t - 1])
    behind = np.ones_like(local[:, 0])
    for t in range(steps - 2, -1, -1):
        step = (local[:, t + 1] * behind) @ move.T
        step /= step.sum(1, keepdims=True)
        behind = np.where(present[:, t + 1, None], step, np.float32(1))
        forward[:, t] *= behind
    return forward / forward.sum(2, keepdims=True)


def training_spans(docs: DataFrame, documents: int = DOCUMENTS, spans: int = SPANS, modulo: int = 5) -> list:
    """(text, lang) rows: spans of words of at most ``documents`` hash-chosen labelled documents of each language."""
    plain = document_texts(docs, F.col("lang").cast("string").alias("lang"))
    labelled = plain.where(F.col("lang").isNotNull() & ~held_out(modulo)).where(F.col("text").rlike(r"\p{L}"))
    counts = docs.where(F.col("lang").isNotNull() & ~held_out(modulo)).groupBy(F.col("lang").cast("string").alias("lang")).count()
    share = F.least(F.lit(1.0), F.lit(2.0 * documents + 50) / F.col("count"))
    drawn = F.xxhash64("doc_id", "text")
    some = labelled.join(F.broadcast(counts), "lang").where(F.pmod(drawn, F.lit(1_000_000)) < share * 1_000_000)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(drawn, "doc_id")))

    def run(batches):
        for batch in batches:
            texts, langs = [], []
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = [w[i : i + WORD] for w in text.split() for i in range(0, len(w), WORD)]
                count = min(spans, -(-len(words) // CHAIN))
                for i in range(count):
                    at = i * max(0, len(words) - CHAIN) // max(1, count - 1) if count > 1 else 0
                    texts.append(" ".join(words[at : at + CHAIN]))
                    langs.append(lang)
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(langs, pa.string())], names=["text", "lang"])

    return ranked.where(F.col("rank") <= documents).select("text", "lang").mapInArrow(tidy(run), "text string, lang string").collect()


def train(docs: DataFrame, documents: int = DOCUMENTS, modulo: int = 5) -> Model | None:
    """The field of the labelled rows that are not held out; None without any.

    The driver gives back what learning took, as it goes on with other work.
    """
    rows = training_spans(docs, documents, modulo=modulo)
    rows.sort(key=lambda r: (r.lang, r.text))
    try:
        return fit([r.text for r in rows], [r.lang for r in rows]) if rows else None
    finally:
        del rows
        release()


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, text hash, lang_pred, score (mean probability of that label over the words) and clear of every row.

    ``clear`` is the mean over the words of each one's own most likely label, high for texts of several languages too.
    A null text or one without a letter is ``und`` with score 0, as is every text
    if there was nothing to learn from.  Of equal means the first label in order wins.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        field = sent.value
        for batch in batches:
            texts = text_array(batch)
            names, values = np.full(len(texts), UNKNOWN, dtype=object), np.zeros(len(texts))
            clear = np.zeros(len(texts))
            for first, stop, data, offsets in chunks(texts):
                if field is None:
                    continue
                start, _, bounds, posterior = word_posteriors(field, data, offsets)
                counts = np.diff(bounds)
                rows = np.flatnonzero(counts)
                if not len(rows):
                    continue
                mean = np.add.reduceat(posterior.astype(np.float64), bounds[:-1][rows]) / counts[rows, None]
                own_best = np.add.reduceat(posterior.max(1).astype(np.float64), bounds[:-1][rows]) / counts[rows]
                clear[first + rows] = np.minimum(1.0, own_best)
                # bytes above ASCII may be anything: such rows are looked at letter by letter
                plain = np.add.reduceat((data[start] < 128).astype(np.int64), bounds[:-1][rows]) > 0
                for row, sure, own in zip(rows.tolist(), plain.tolist(), mean):
                    if sure or any(c.isalpha() for c in texts[first + row].as_py()):
                        best = int(own.argmax())
                        names[first + row], values[first + row] = field.labels[best], min(1.0, float(own[best]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(values), pa.array(clear)],
                names=["doc_id", TEXT_HASH, "lang_pred", "score", "clear"],
            )

    plain = document_texts(docs).select("doc_id", text_hash().alias(TEXT_HASH), "text")
    return plain.mapInArrow(tidy(run), f"doc_id bigint, {TEXT_HASH} bigint, lang_pred string, score double, clear double")


def language_runs(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, first_word, last_word, lang: maximal runs of words (letters) with one most likely language, for code-switched texts."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        field = sent.value
        for batch in batches:
            out: list[list] = [[], [], [], []]
            ids = batch.column(0).to_pylist()
            for first, _, data, offsets in chunks(text_array(batch)):
                _, _, bounds, posterior = word_posteriors(field, data, offsets)
                best = posterior.argmax(1)
                for row in np.flatnonzero(np.diff(bounds)).tolist():
                    own = best[bounds[row] : bounds[row + 1]]
                    cuts = np.concatenate([[0], np.flatnonzero(np.diff(own)) + 1, [len(own)]]).tolist()
                    for a, b in zip(cuts, cuts[1:]):
                        for column, value in zip(out, (ids[first + row], a, b - 1, field.labels[own[a]])):
                            column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds)], names=["doc_id", "first_word", "last_word", "lang"]
            )

    return document_texts(docs).mapInArrow(tidy(run), "doc_id bigint, first_word bigint, last_word bigint, lang string")


def identified(docs: DataFrame, least: float = 0.35, modulo: int = 5) -> DataFrame:
    """The rows of ``docs`` whose words have clear languages, one or several; all columns stay.

    A text goes if the mean probability of its words' own best labels is below
    ``least`` for four labels; for other numbers of labels the limit is as far on the way from chance to certainty.
    Rows without letters (null texts too) go.  Without labelled rows nothing can
    be told, so all rows with a letter stay.
    """
    model = train(docs, modulo=modulo)
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    chance = 1 / len(model.labels)
    limit = chance + (least - 0.25) / 0.75 * (1 - chance) if len(model.labels) > 1 else 0.0
    found = predict(docs, model)
    refused = found.where((F.col("lang_pred") == UNKNOWN) | (F.col("clear") < limit)).select("doc_id", TEXT_HASH).distinct()
    refused = written(refused, "refused")
    other = refused.select(F.col("doc_id").alias("__other"), F.col(TEXT_HASH).alias("__other_hash"))
    keyed = docs.withColumn(TEXT_HASH, text_hash()).withColumn("__id", F.col("doc_id").cast("bigint"))
    same = F.col("__id").eqNullSafe(F.col("__other")) & (F.col(TEXT_HASH) == F.col("__other_hash"))
    return keyed.join(narrow(other), same, "left_anti").select(*docs.columns)
