"""Bottom-k near duplicates and MinHash fingerprints against all pairs of sets."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import shared
from tracelark import session
from tracelark.llm import fingerprint, neardup, tables, textops
from tracelark.llm.components import connected_components, joined_components


def exact_components(texts: dict, width: int, top: int, bottom: int) -> dict:
    sets = {k: shared.runs(shared.words(t), width) for k, t in texts.items()}
    root = {k: k for k in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(texts)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and both * bottom >= top * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: find(k) for k in keys}


def test_shingles_are_those_of_plain_words():
    texts = [r[1] for r in shared.document_rows()]
    for width in (1, 3, 5):
        seen = {}
        for text, (count, hashes) in zip(texts, textops.shingle_rows(pa.array([t or "" for t in texts], pa.large_string()), width)):
            own = shared.words(text)
            expected = [tuple(own[i : i + width]) for i in range(max(1, len(own) - width + 1))] if own else []
            assert count == len(own) and len(hashes) == len(expected)
            for run, value in zip(expected, hashes.tolist()):
                assert seen.setdefault(run, value) == value
        assert len(set(seen.values())) == len(seen)


def test_awkward_rows(spark):
    rows = shared.document_rows()
    found = neardup.near_duplicates(shared.documents(spark), 3, 0.85).collect()
    expected = exact_components({r[0]: r[1] for r in rows if r[0] is not None}, 3, 17, 20)
    assert len(found) == len(rows)
    for r in found:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            text = next(t for i, t, *_ in rows if i == r.doc_id)
            assert r.component_id == expected[r.doc_id] and r.kept == (r.doc_id == r.component_id)
            assert r.n_shingles == len(shared.runs(shared.words(text), 3))


def near_copies(seed: int, groups: int, copies: int) -> dict:
    """Groups of edited copies of one text, all with a passage in common, of many sizes."""
    random.seed(seed)
    passage = shared.prose(99, 40)
    texts = {}
    for g in range(groups):
        master = shared.prose(1000 + g, random.choice([5, 20, 60, 150, 400])).split(" ")
        for _ in range(copies):
            own = list(master)
            for _ in range(random.randrange(0, max(2, len(own) // 12))):
                own[random.randrange(len(own))] = f"w{random.randrange(30)}"
            texts[len(texts)] = " ".join(own) + (" " + passage if g % 2 else "")
    return texts


@pytest.mark.parametrize("width,similarity,ratio", [(3, 0.85, (17, 20)), (5, 0.8, (4, 5))])
def test_groups_of_near_copies(spark, width, similarity, ratio):
    texts = near_copies(7, 12, 25)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    found = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs, width, similarity).collect()}
    assert found == exact_components(texts, width, *ratio)


def test_fingerprint_classes_are_those_of_the_sets(spark):
    texts = near_copies(8, 8, 12)
    texts[500] = None
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    found = {r.doc_id: r.class_id for r in fingerprint.similar_fingerprints(docs).collect()}
    assert found == exact_components(texts, 5, 4, 5)


def test_no_rows(spark):
    none = shared.documents(spark, [])
    assert neardup.near_duplicates(none).collect() == []
    assert neardup.one_of_each(none).collect() == []
    assert fingerprint.similar_fingerprints(none).collect() == []
    assert fingerprint.fingerprints_of_edits(none).collect() == []


def test_one_of_each_keeps_all_columns_and_one_row(spark):
    docs = shared.documents(spark)
    kept = neardup.one_of_each(docs, 5, 0.8)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    expected = exact_components({r[0]: r[1] for r in shared.document_rows() if r[0] is not None}, 5, 4, 5)
    assert sorted(i for i in ids if i is not None) == sorted(set(expected.values()))
    assert ids.count(None) == 2  # texts of their own


def test_components_of_a_long_path(spark):
    links = [(i, i + 1) for i in range(200)] + [(500, 501), (501, 500), (7, 7)]
    found = dict(connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect())
    assert found == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}


def ordered(rows):
    """Rows from the largest id to the smallest, null ids last."""
    return sorted(rows, key=lambda r: -(2**63) if r[0] is None else r[0], reverse=True)


@pytest.mark.parametrize("slices", [1, 3, 64])
def test_fingerprints_of_edits(spark, slices):
    rows = [r for r in shared.document_rows() if r[0] is not None and r[0] != 15]
    found = {r.doc_id: r for r in fingerprint.fingerprints_of_edits(shared.documents(spark, rows), slices=slices).collect()}
    assert len(found) == len(rows)
    line = ordered(rows)
    for i, (doc_id, text, *_) in enumerate(line):
        text, after = text or "", line[(i + 1) % len(line)][1] or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        r = found[doc_id]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        for near, other in ((r.near_edited, changed), (r.near_next, after)):
            a, b = shared.runs(shared.words(text), 5), shared.runs(shared.words(other), 5)
            assert abs(near - (len(a & b) / len(a | b) if a | b else 1.0)) < 0.26
        assert (r.fingerprint == r.edited_fingerprint) == (r.near_edited == 1)
    by_words = {}
    for doc_id, text, *_ in rows:
        assert by_words.setdefault(tuple(shared.words(text)), found[doc_id].fingerprint) == found[doc_id].fingerprint


def test_repeated_and_null_ids_follow_each_other(spark):
    found = fingerprint.fingerprints_of_edits(shared.documents(spark), slices=5).collect()
    assert len(found) == len(shared.document_rows())
    repeated = [r for r in found if r.doc_id == 15]
    assert len(repeated) == 2 and max(r.near_next for r in repeated) == 1  # the second follows the first
    single = fingerprint.fingerprints_of_edits(shared.documents(spark, [(1, "a b c d", None, None, 7)])).collect()
    assert single[0].near_next == 1


def test_signatures_are_minima(spark):
    values = fingerprint.signatures(pa.array(["a b c d e f g", ""], pa.large_string()))
    _, hashes = next(textops.shingle_rows(pa.array(["a b c d e f g"], pa.large_string()), 5))
    for i in range(fingerprint.PERMUTATIONS):
        factor, shift = int(fingerprint._FACTORS[i]), int(fingerprint._SHIFTS[i])
        assert values[0, i] == min((factor * int(h) + shift) % 2**64 for h in hashes) >> 32
    assert (values[1] == 0xFFFFFFFF).all() and values.dtype == np.uint32


def test_stars_need_no_round_and_few_files(spark, monkeypatch):
    made = []
    monkeypatch.setattr(tables, "fresh_dir", lambda spark, tag: made.append(session.fresh_dir(spark, tag)) or made[-1])
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "97")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        stars = spark.createDataFrame([(i, i % 5) for i in range(5, 400)] + [(3, 3), (8, 3)], "a bigint, b bigint")
        found = connected_components(stars)
        assert dict(found.collect()) == {i: i % 5 for i in range(400)}
        assert len(made) == 1 and len(found.inputFiles()) <= 4 * spark.sparkContext.defaultParallelism < 97
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)


def test_further_links_join_components(spark):
    roots = connected_components(spark.createDataFrame([(2, 1), (3, 2), (6, 5), (9, 8)], "a bigint, b bigint"))
    more = spark.createDataFrame([(6, 3), (7, 7), (11, 9), (4, 11)], "a bigint, b bigint")
    assert dict(joined_components(roots, more).collect()) == {1: 1, 2: 1, 3: 1, 5: 1, 6: 1, 4: 4, 8: 4, 9: 4, 11: 4}
