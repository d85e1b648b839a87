"""Licence sentences are found whichever of their words differ, up to the share that must stand in place."""

from tests.llm import shared
from tracelark.llm import licenses


def test_notices_without_their_rarest_words(spark):
    rows, expected = [], {}
    for t in (t for t in licenses.TEMPLATES if t.mandatory):
        words, fixed = t.words, set()
        for phrase in map(str.split, t.mandatory):
            for i in range(len(words)):
                if words[i : i + len(phrase)] == phrase:
                    fixed.update(range(i, i + len(phrase)))
        free = [i for i in range(len(words)) if i not in fixed]
        most = int(len(words) * 0.3)
        for shift in range(len(free)):
            for number in (2, most, most + 1):
                changed = {free[(shift + k) % len(free)] for k in range(number)}
                text = " ".join(f"other{i}" if i in changed else w for i, w in enumerate(words))
                expected[len(rows)] = t.label, (len(words) - len(changed)) / len(words)
                rows.append((len(rows), f"{shared.prose(len(rows), 5)} {text} end"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for frequency in (None, {w: i for i, w in enumerate(sorted({w for t in licenses.TEMPLATES for w in t.words}))}):
        for r in licenses.scanned(docs, frequency=frequency).collect():
            label, share = expected[r.doc_id]
            if share >= licenses.SENTENCE_SHARE:
                assert label in r.labels.split(",") and r.score >= share
