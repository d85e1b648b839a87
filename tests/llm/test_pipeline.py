"""The pipeline's stages, one by one, against plain Python over what the stage before kept."""

import re

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm import shared
from tests.llm.test_models import sentence
from tests.llm.test_neardup import exact_components
from tests.llm.test_scans import plain_spans
from tracelark.llm.tables import written
from tracelark.session import fresh_dir


def rows():
    out = []
    for i in range(90):
        lang = ["aa", "bb", "cc"][i % 3]
        out.append((i, sentence(lang, i, 40 + i), lang))
    out += [(100 + i, shared.edited(out[i][1], 45, "karo"), out[i][2]) for i in range(6)]  # near copies
    out += [(110, out[7][1], "bb"), (110, out[7][1], "bb")]  # exact copies, one row twice
    out += [(120, None, "aa"), (121, "", None), (122, "12 34 !", None)]
    out += [(130, sentence("aa", 700, 30) + " " + ITEM + " " + sentence("aa", 701, 30), "aa"), (131, ITEM, None)]
    out += [(140, sentence("cc", 800, 30) + " a.b@c.de " + sentence("cc", 801, 30), "cc"), (None, sentence("bb", 900, 25), "bb")]
    return out


ITEM = sentence("aa", 600, 25)


def test_stages(spark):
    folder = fresh_dir(spark, "tables")
    spark.createDataFrame([(1, ITEM), (2, sentence("bb", 5000, 30))], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    made = [(i, t, g, f"s{k % 4}", None if t is None else len(t)) for k, (i, t, g) in enumerate(rows())]
    spark.createDataFrame(made, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{folder}/documents.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, folder), name)
        kept[name] = docs.collect()
        if name != "packing":
            assert docs.columns == columns

    ids = lambda name: sorted((r.doc_id for r in kept[name]), key=str)
    with_letters = [r for r in made if r[1] and re.search(r"[^\W\d_]", r[1])]
    assert ids("language") == sorted((r[0] for r in with_letters), key=str)

    texts = {r.doc_id: r.text for r in kept["language"] if r.doc_id is not None}
    component = exact_components(texts, 5, 4, 5)
    firsts = sorted(set(component.values()), key=str)
    assert ids("near_duplicates") == sorted([*firsts, None], key=str) and 110 not in firsts and not set(range(100, 106)) & set(firsts)

    assert ids("decontamination") == sorted([i for i in [*firsts, None] if i not in (130, 131)], key=str)

    before = {r.doc_id: r for r in kept["decontamination"]}
    for r in kept["private_data"]:
        spans = plain_spans(before[r.doc_id].text)
        assert (r == before[r.doc_id]) == (not spans) and r.n_chars == len(r.text) and not plain_spans(r.text)
    assert len(kept["private_data"]) == len(before) and "[EMAIL]" in next(r.text for r in kept["private_data"] if r.doc_id == 140)

    tokenizer = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    sizes = {r.doc_id: len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in kept["private_data"]}
    packed: dict = {}
    for r in kept["packing"]:
        packed[r.doc_id] = packed.get(r.doc_id, 0) + r.length
    assert packed == sizes
