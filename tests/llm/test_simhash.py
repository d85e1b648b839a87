"""SimHash fingerprints and their components against plain Python over all pairs."""

import random

import pytest
import xxhash

from tests.llm import shared
from tracelark.llm import simhash


def fingerprint(text, width=3):
    w = shared.words(text)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(values: dict, radius: int) -> dict:
    root = {k: k for k in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(values)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if (values[a] ^ values[b]).bit_count() <= radius:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: find(k) for k in keys}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_spark_has_the_same_hash(spark):
    texts = ["", "a", "one two three", "é über 中文", "x" * 100]
    got = spark.createDataFrame([(t,) for t in texts], "t string").selectExpr("xxhash64(t) AS h").collect()
    assert [r.h for r in got] == [signed(xxhash.xxh64_intdigest(t.encode(), 42)) for t in texts]


@pytest.mark.parametrize("piece", [1, 9, 1 << 20])
def test_fingerprints_of_awkward_texts(monkeypatch, piece):
    monkeypatch.setattr(simhash, "PIECE", piece)
    for _, text, *_ in shared.document_rows():
        if piece > 1 or len(text or "") < 10_000:
            for width in (1, 3):
                assert simhash.fingerprint((text or "").encode(), width) == signed(fingerprint(text, width))


@pytest.mark.parametrize("hot", [0, 2, 10_000])
def test_awkward_rows(spark, monkeypatch, hot):
    monkeypatch.setattr(simhash, "HOT_ROWS", hot)
    rows = shared.document_rows()
    found = simhash.near_fingerprints(shared.documents(spark)).collect()
    by_id = {r[0]: fingerprint(r[1]) for r in rows if r[0] is not None}
    root = components(by_id, 3)
    expected = []
    for doc_id, text, *_ in rows:
        mine = fingerprint(text)
        near = [root[k] for k, v in by_id.items() if (v ^ mine).bit_count() <= 3]
        expected.append((doc_id, f"{mine:016x}", min(near) if near else None))
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


def clusters(seed: int) -> list[int]:
    """Chains of near values, dense groups in a few bits, values around 0, and far ones."""
    random.seed(seed)
    values = {0, 1, 1 << 63, (1 << 64) - 1, (1 << 64) - 2}
    for _ in range(12):
        value = random.getrandbits(64)
        for _ in range(12):
            values.add(value)
            for bit in random.sample(range(64), random.choice([1, 2, 3, 3, 3, 4, 5])):
                value ^= 1 << bit
    for _ in range(3):
        base, bits = random.getrandbits(64), random.sample(range(64), 7)
        values |= {base ^ sum(1 << b for b in bits if random.random() < 0.5) for _ in range(70)}
    return sorted(values | {random.getrandbits(64) for _ in range(100)})


@pytest.mark.parametrize("radius,seed", [(1, 1), (2, 1), (3, 1), (3, 2)])
def test_components_of_fingerprints(spark, radius, seed):
    values = clusters(seed)
    found = {r.node: r.root for r in simhash.linked_components(spark.createDataFrame([(signed(v),) for v in values], "fp bigint"), radius).collect()}
    expected = components({signed(v): v for v in values}, radius)
    assert {v: found.get(v, v) for v in expected} == expected


def test_any_three_bits_meet(spark):
    base = 0x0123456789ABCDEF
    apart = [(a, b, c) for a in (0, 15, 31) for b in (16, 40) for c in (47, 48, 63)]
    values = [signed(base)] + [signed(base ^ sum(1 << b for b in bits)) for bits in apart]
    keys = {v: set() for v in values}
    for key in simhash.variants(spark.createDataFrame([(v,) for v in values], "fp bigint"), 3).collect():
        keys[key.fp].add(key.key)
    assert all(len(k) == 4 * 49 and k & keys[values[0]] for k in keys.values())


def test_empty_table(spark):
    assert simhash.near_fingerprints(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_registered_query(spark, folder):
    from tracelark.llm.queries import QUERIES

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    values = {k: fingerprint(t) for k, t in docs.items()}
    root = components(values, 3)
    found = QUERIES["op13_simhash_balls"](spark, folder).collect()
    assert sorted(map(tuple, found)) == sorted((k, f"{v:016x}", root[k]) for k, v in values.items())
