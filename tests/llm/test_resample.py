"""Importance resampling against plain Python: features, gains, weights, noise, ranks."""

import hashlib
import math
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from tests.llm import shared
from tracelark.llm import resample


def features(text, longest):
    w = shared.alnum_words(text)
    return [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def bucket(feature, buckets=10_000):
    return zlib.crc32(feature.encode()) % buckets


def expected(rows, target, longest=1, buckets=10_000, least=20, percent=10, seed=2024):
    s = Counter(bucket(f, buckets) for _, text in rows for f in features(text, longest))
    t = Counter(bucket(f, buckets) for text in target for f in features(text, longest))
    S, T = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets))))

    out = []
    for doc_id, text in rows:
        found = features(text, longest)
        weight = sum(gain(bucket(f, buckets)) for f in found)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(shared.alnum_words(text)), len(found), weight, score, None])
    order = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    for place, row in enumerate(order[: percent * len(order) // 100]):
        row[5] = place + 1
    return sorted(map(tuple, out), key=repr)


def found(spark, rows, target, **options):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    asked = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id bigint, text string")
    return sorted((tuple(r) for r in resample.resampled(docs, asked, **options).collect()), key=repr)


TARGET = [shared.prose(3, 40), "One two", None, "", "é über 中文"]


@pytest.mark.parametrize("longest", [1, 3])
def test_awkward_rows(spark, longest):
    rows = [(r[0], r[1]) for r in shared.document_rows()]
    options = {"longest": longest, "least_words": 2, "percent": 60}
    got = resample.resampled(shared.documents(spark), spark.createDataFrame([(t, 1) for t in TARGET], "text string, n int"), **options)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected(rows, TARGET, longest, least=2, percent=60)


def test_ranks_over_many_partitions(spark):
    rows = [(i, shared.prose(i % 90, 15 + i % 9)) for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(13)
    asked = spark.createDataFrame([(shared.prose(5, 300),)], "text string")
    got = sorted((tuple(r) for r in resample.resampled(docs, asked, percent=37).collect()), key=repr)
    assert got == expected(rows, [shared.prose(5, 300)], percent=37)


@pytest.mark.parametrize("longest", [1, 2, 4])
@pytest.mark.parametrize("size", [1, 7, 60, 1 << 19])
def test_runs_stay_in_their_text_and_go_on_over_cuts(monkeypatch, longest, size):
    monkeypatch.setattr(resample, "JOINED", size)
    texts = [r[1] or "" for r in shared.document_rows()[:11]] + ["", "a b", "中" * 200, shared.prose(8, 100), "x"]
    seen = Counter()
    for _, rows, buckets in resample.features(pa.array(texts, pa.large_string()), longest, 1 << 20):
        seen.update(zip(rows.tolist(), buckets.tolist()))
    assert seen == Counter((i, bucket(f, 1 << 20)) for i, t in enumerate(texts) for f in features(t, longest))


def test_equal_scores_go_to_the_smaller_id(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(resample, "noise", lambda doc_id, seed: F.lit(0))
    rows = [(i, shared.prose(1, 30)) for i in (9, 4, 7, None, 2, 4)]
    got = [(r[0], r[5]) for r in found(spark, rows, TARGET, percent=50) if r[5]]
    assert sorted(got, key=lambda r: r[1]) == [(2, 1), (4, 2), (4, 3)]


def test_empty_tables(spark):
    assert found(spark, [], TARGET) == []
    rows = [(i, shared.prose(i, 30)) for i in range(10)]
    assert found(spark, rows, []) == expected(rows, [])
