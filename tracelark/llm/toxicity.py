"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; all training texts, toxic or not, are
unlabelled.  With the share of toxic texts (the class prior) p, a score f and
the sigmoid loss l, the risk is

    p E_P[l(f)] + max(0, E_U[l(-f)] - p E_P[l(-f)]):

the part of the unlabelled risk that toxic texts account for is taken off, and
the rest can't be negative; when it would be, steps go the other way to stop overfitting.
A linear score over the presence of chosen words and word beginnings is learned.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .tables import TEXT_HASH, document_texts, held_out, text_hash
from .textops import NOT_ALNUM, SpanHasher, chunks, mix, text_array, tidy, word_spans

#: Bounds of the sample the classifier is fitted to.
POSITIVES = 3_000
UNLABELLED = 9_000
#: Bytes of text a sample may have in all; documents beyond it are left out, in the order of their hashes.
SAMPLE_BYTES = 48 << 20
FEATURES = 4_096
#: Letters (bytes) of the beginnings that are features besides whole words.
BEGINNINGS = (5, 6, 7)
DEFAULT_PRIOR = 0.1


def feature_sets(texts: pa.Array):
    """The distinct features of each text: hashes of its words (letters and digits) and of their beginnings."""
    for _, _, data, offsets in chunks(texts):
        start, end, bounds = word_spans(data, offsets, NOT_ALNUM)
        hasher = SpanHasher(data)
        families = [hasher(start, end)]
        for i, size in enumerate(BEGINNINGS):
            long = end - start > size
            own = mix(hasher(start, np.minimum(start + size, end)) + np.uint64(i + 1))
            own[~long] = families[0][~long]  # short words are features already
            families.append(own)
        values = np.stack(families, axis=1).view(np.int64)
        for i in range(len(offsets) - 1):
            yield values[bounds[i] : bounds[i + 1]].ravel()


@dataclass
class Classifier:
    features: np.ndarray  # ascending hashes
    weights: np.ndarray
    bias: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Probability-like scores of texts; only the features in them count, each once."""
        out = np.full(len(texts), self.bias)
        if len(self.features):
            seen = np.zeros(1 << 16, bool)
            seen[self.features.view(np.uint64) >> np.uint64(48)] = True
            for i, values in enumerate(feature_sets(texts)):
                values = values[seen[values.view(np.uint64) >> np.uint64(48)]]
                place = np.minimum(np.searchsorted(self.features, values), len(self.features) - 1)
                found = np.unique(place[self.features[place] == values])
                out[i] += self.weights[found].sum()
        return 1 / (1 + np.exp(-np.clip(out, -40, 40)))


def _select(positives: list[np.ndarray], unlabelled: list[np.ndarray], most: int) -> np.ndarray:
    """The features whose share among the positives exceeds that among all texts most clearly (a z-score of the two shares)."""
    p, pn = np.unique(np.concatenate(positives), return_counts=True)
    u, un = np.unique(np.concatenate(unlabelled), return_counts=True)
    place = np.minimum(np.searchsorted(u, p), len(u) - 1)
    others = np.where(u[place] == p, un[place], 0)
    x, y = pn / len(positives), (others + 0.5) / len(unlabelled)
    clear = (x - y) / np.sqrt(x * (1 - np.minimum(x, 0.999)) / len(positives) + y / len(unlabelled))
    good = np.flatnonzero((pn >= 3) & (clear > 3))
    order = good[np.lexsort((p[good], -clear[good]))][:most]
    return np.sort(p[order])


def fit(positives: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, rounds: int = 300, most: int = FEATURES) -> Classifier:
    """The same samples give the same classifier; each element holds the distinct features of one text."""
    features = _select(positives, unlabelled, most)
    if not len(features):
        return Classifier(features, np.zeros(0), float(np.log(prior / (1 - prior))))

    def sparse(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        row, column = [], []
        for i, values in enumerate(rows):
            place = np.minimum(np.searchsorted(features, values), len(features) - 1)
            found = place[features[place] == values]
            row.append(np.full(len(found), i))
            column.append(found)
        return np.concatenate(row), np.concatenate(column)

    sides = []
    for rows in (positives, unlabelled):
        row, column = sparse(rows)
        sides.append((row, column, len(rows)))
    weights, bias = np.zeros(len(features) + 1), -1.0
    weights[-1] = bias
    moment, square = np.zeros_like(weights), np.zeros_like(weights)

    def scores(side) -> np.ndarray:
        row, column, count = side
        return np.bincount(row, weights=weights[column], minlength=count) + weights[-1]

    def slope(side, outer: np.ndarray) -> np.ndarray:
        row, column, _ = side
        out = np.bincount(column, weights=outer[row], minlength=len(weights))
        out[-1] = outer.sum()
        return out

    for r in range(1, rounds + 1):
        f, g = scores(sides[0]), scores(sides[1])
        sp, su = 1 / (1 + np.exp(-f)), 1 / (1 + np.exp(-g))
        # loss of a score z for the positive class is sigmoid(-z), for the negative one sigmoid(z)
        negative = su.mean() - prior * sp.mean()
        positive_slope = slope(sides[0], -prior * sp * (1 - sp) / len(sp))
        negative_slope = slope(sides[1], su * (1 - su) / len(su)) + slope(sides[0], -prior * sp * (1 - sp) / len(sp))
        step = positive_slope + negative_slope if negative >= 0 else -negative_slope
        step = step + 1e-5 * np.append(weights[:-1], 0)
        moment += 0.1 * (step - moment)
        square += 0.01 * (step * step - square)
        weights = weights - 0.1 * (moment / (1 - 0.9**r)) / (np.sqrt(square / (1 - 0.99**r)) + 1e-10)
    return Classifier(features, weights[:-1].copy(), float(weights[-1]))


def _sample(rows: DataFrame, total: int, most: int) -> list[np.ndarray]:
    """Feature sets of at most ``most`` of the rows (doc_id, text), chosen by a hash of both."""
    if not total:
        return []
    drawn = F.xxhash64("doc_id", "text", F.lit(4))
    share = min(1.0, 1.5 * most / total + 50 / total)
    some = rows.where(F.pmod(drawn, F.lit(1_000_000)) < int(share * 1_000_000) + 1).select(drawn.alias("drawn"), "text")

    def run(batches):
        for batch in batches:
            blobs = [np.unique(values).tobytes() for values in feature_sets(text_array(batch))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(blobs, pa.binary())], names=["drawn", "features"])

    kept, size = [], 0
    for row in some.mapInArrow(tidy(run), "drawn bigint, features binary").orderBy("drawn", "features").limit(most).toLocalIterator():
        size += len(row.features)
        if size > SAMPLE_BYTES:
            break
        kept.append(np.frombuffer(row.features, np.int64))
    return kept


def train(docs: DataFrame, labels: DataFrame, modulo: int = 5, prior: float | None = None) -> Classifier:
    """Fit to rows that are not held out; ``prior`` defaults to the share of toxic ones among labelled rows.

    Null labels are none.  Several labels of one document: toxic if any says so.
    Without confirmed toxic texts every score is the prior.
    """
    marked = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
    marked = marked.agg(F.max("toxic").alias("toxic")).where(~held_out(modulo))
    counts = {r.toxic: r["count"] for r in marked.groupBy("toxic").count().collect()}
    toxic, known = counts.get(1, 0), sum(counts.values())
    if prior is None:
        prior = min(0.9, max(0.001, toxic / known)) if toxic else DEFAULT_PRIOR
    share = min(1.0, 1.5 * POSITIVES / toxic + 50 / toxic) if toxic else 0.0
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1_000_000))
    chosen = marked.where((F.col("toxic") == 1) & (drawn < int(share * 1_000_000) + 1)).orderBy(drawn, "doc_id").limit(POSITIVES)
    plain = document_texts(docs).where(~held_out(modulo))
    total = docs.where(~held_out(modulo)).count()
    positives = _sample(plain.join(F.broadcast(chosen.select("doc_id")), "doc_id"), min(toxic, POSITIVES), POSITIVES)
    unlabelled = _sample(plain, total, UNLABELLED)
    if not positives or not unlabelled:
        return Classifier(np.zeros(0, np.int64), np.zeros(0), float(np.log(prior / (1 - prior))))
    return fit(positives, unlabelled, prior)


def predict(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """doc_id, text hash, score of every row; a null or empty text has the score of no features at all."""
    sent = docs.sparkSession.sparkContext.broadcast(classifier)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sent.value.scores(text_array(batch)))],
                names=["doc_id", TEXT_HASH, "score"],
            )

    plain = document_texts(docs).select("doc_id", text_hash().alias(TEXT_HASH), "text")
    return plain.mapInArrow(tidy(run), f"doc_id bigint, {TEXT_HASH} bigint, score double")
