"""Items of few shingles are found in every document that holds them."""

from tests.llm import shared
from tests.llm.test_decontaminate import exact
from tracelark.llm import decontaminate


def test_no_item_of_few_shingles_is_missed(spark):
    items = [(i, shared.prose(7000 + i, 1 + i % 8)) for i in range(200)]
    docs = []
    for d in range(400):
        words = shared.prose(9000 + d, 60).split(" ")
        for k in range(5):
            at = 0 if k == 0 else 8 * k
            words[at:at] = items[(d * 5 + k) % 200][1].split(" ")
        docs.append((d, " ".join(words)))
    rows = decontaminate.contained_items(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    ).collect()
    assert {(r.doc_id, r.item_id, r.n_item, r.n_shared) for r in rows} == exact(docs, items)
