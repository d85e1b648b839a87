"""Containment search against exact containment of every item in every document."""

import random

from tests.llm import shared
from tracelark.llm import decontaminate


def exact(docs, items, width=5):
    out = set()
    for item, text in items:
        own = shared.alnum_words(text)
        if not own:
            continue
        used = min(width, len(own))
        sought = shared.runs(own, used)
        for doc, body in docs:
            words = shared.alnum_words(body)
            there = {tuple(words[i : i + used]) for i in range(len(words) - used + 1)}
            if len(sought & there) * 5 >= len(sought) * 4:
                out.add((doc, item, len(sought), len(sought & there)))
    return out


def tables():
    random.seed(3)
    items = [(i, shared.prose(100 + i, random.choice([5, 8, 14, 37, 59, 200]))) for i in range(30)]
    items += [(40, "Two words"), (41, ""), (42, None), (43, items[0][1])]
    docs = []
    for d in range(60):
        words = shared.prose(500 + d, random.choice([3, 50, 400, 4000])).split(" ")
        if d % 3 == 0:
            passage = edited = random.choice(items[:30])[1].split(" ")
            if d % 2:
                edited = [w if i % 23 else "changed" for i, w in enumerate(passage)]
            at = random.randrange(len(words))
            words[at:at] = edited
        docs.append((d, " ".join(words)))
    docs += [(100, "here are TWO, words."), (101, None), (102, ""), (103, items[3][1]), (103, items[3][1])]
    return docs, items


def test_against_brute_force(spark):
    docs, items = tables()
    rows = decontaminate.contained_items(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    ).collect()
    found = {(r.doc_id, r.item_id, r.n_item, r.n_shared) for r in rows}
    expected = exact(docs, items)
    assert found <= expected
    assert len(found) >= 0.98 * len(expected)  # a search by minima may miss one in a thousand
    assert (100, 40, 1, 1) in found and sum(r.doc_id == 103 and r.item_id == 3 for r in rows) == 2


def test_blocks_of_items_change_nothing(spark, monkeypatch):
    docs, items = tables()
    docs, items = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    whole = sorted(map(tuple, decontaminate.contained_items(docs, items).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK", 300)
    assert sorted(map(tuple, decontaminate.contained_items(docs, items).collect())) == whole


def test_clean_rows_stay_with_all_columns(spark):
    items = spark.createDataFrame([(1, shared.prose(1, 120)), (2, "no such thing here at all")], "item_id bigint, text string")
    docs = shared.documents(spark)
    kept = decontaminate.without_contaminated(docs, items)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(map(str, ids)) == sorted(str(r[0]) for r in shared.document_rows() if r[0] not in (1, 2, 3, 4))
    assert decontaminate.without_contaminated(docs, items.limit(0)).count() == len(shared.document_rows())
    assert decontaminate.contained_items(shared.documents(spark, []), items).collect() == []
