"""Messages of the language field reach over the parts that are scored at a time; text without spaces is learnt from as a whole."""

import numpy as np

from tests.llm import shared
from tracelark.llm import language


def test_parts_answer_as_one_chain():
    random = np.random.Generator(np.random.PCG64(3))
    texts = [shared.prose(i, 32) if i % 2 else " ".join("\xe4\xf6" + w for w in shared.prose(i, 32).split()) for i in range(40)]
    model = language.fit(texts, ["ab"[i % 2] for i in range(40)], rounds=10, chains=200)
    words = [w for i in random.integers(0, 40, 60) for w in texts[i].split()[: random.integers(1, 32)]]
    rows = [words[:size] for size in (0, 1, 31, 127, 128, 129, 160, 161, 288, len(words))]
    blobs = [" ".join(row).encode() for row in rows]
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in blobs])])
    data = np.frombuffer(b"".join(blobs), np.uint8)
    start, end, bounds, found = language.word_posteriors(model, data, offsets)
    scores = model.scores(language.word_features(data, start, end))
    for i in range(len(rows)):
        own = scores[bounds[i] : bounds[i + 1]]
        if len(own):
            whole, _ = language.forward_backward(own[None], np.ones((1, len(own)), bool), model.transitions)
            assert np.abs(whole[0] - found[bounds[i] : bounds[i + 1]]).max() < 1e-3


def test_whole_of_a_text_without_spaces_is_learnt_from(spark):
    text = "".join(chr(0x4E00 + i) for i in range(1000))
    docs = shared.documents(spark, [(i, text, "zh", None, 1000) for i in range(1, 6)])
    spans = language.training_spans(docs)
    assert spans and all(max(map(len, r.text.split())) <= language.WORD for r in spans)
    assert all(set(text) == set(r.text) - {" "} for r in spans)
