"""Clean texts of several languages stay."""

import random

from tests.llm import shared
from tracelark.llm import language

ENDS = {"aa": "ska", "bb": "ion", "cc": "ung", "dd": "ezh", "ee": "oqo"}


def sentence(seed: int, lang: str, count: int) -> str:
    random.seed(seed)
    return " ".join(random.choice(["mel", "tor", "vin", "pas", "gul"]) + random.choice("aeiou") + ENDS[lang] for _ in range(count))


def test_texts_of_five_languages_stay(spark):
    rows = [(k * 100 + i, sentence(k * 100 + i, lang, 40), lang) for k, lang in enumerate(ENDS) for i in range(30)]
    rows += [(900 + i, " ".join(sentence(i * 9 + k, lang, 40) for k, lang in enumerate(ENDS)), None) for i in range(5)]
    rows += [(990, "12 !!", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    scores = {r.doc_id: r.score for r in language.predict(docs, language.train(docs)).collect()}
    assert all(scores[900 + i] < 0.35 for i in range(5))
    assert {r.doc_id for r in language.identified(docs).collect()} == {r[0] for r in rows} - {990}
