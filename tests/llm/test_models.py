"""Language field, toxicity classifier and context tree: exact parts by hand, learned parts on held-out rows."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import shared
from tracelark.llm import contexttree, language, toxicity
from tracelark.llm.tables import held_out

SYLLABLES = {"aa": "ka ro ti mu shi", "bb": "\xe9lle oux tre ment que", "cc": "sch ung keit \xfcber ver"}


def sentence(lang: str, seed: int, count: int) -> str:
    random.seed(seed)
    parts = SYLLABLES[lang].split(" ")
    return " ".join("".join(random.choice(parts) for _ in range(random.randrange(1, 4))) for _ in range(count))


def language_rows(count=240):
    return [(i, sentence(lang, i, 5 + i % 90), None if i % 7 == 0 else lang) for i in range(count) for lang in [sorted(SYLLABLES)[i % 3]]]


def test_held_out_is_crc32(spark):
    rows = spark.range(200).select("id", held_out(5, "id").alias("x")).collect()
    assert all(r.x == shared.crc(r.id, 5) for r in rows)


def test_language_of_held_out_rows(spark):
    rows = language_rows()
    extra = [(900, None, "aa"), (901, "", "bb"), (902, "12 !?", "aa"), (903, "\U0001f600 —", None), (904, "中文", None), (None, "karo", None)]
    docs = spark.createDataFrame(rows + extra, "doc_id bigint, text string, lang string")
    model = language.train(docs)
    found = {r.doc_id: r for r in language.predict(docs, model).collect()}
    held = [i for i, _, _ in rows if shared.crc(i, 5)]
    right = sum(found[i].lang_pred == sorted(SYLLABLES)[i % 3] for i in held)
    assert right >= 0.97 * len(held) and all(0 <= r.score <= 1 for r in found.values())
    assert [found[i].lang_pred for i in (900, 901, 902, 903)] == ["und"] * 4 and found[904].lang_pred != "und"
    assert found[None].lang_pred == "aa"


def test_labels_of_held_out_rows_are_never_seen(spark):
    rows = language_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    other = spark.createDataFrame([(i, t, "zz" if shared.crc(i, 5) else g) for i, t, g in rows], "doc_id bigint, text string, lang string")
    a, b = (sorted(map(tuple, language.predict(d, language.train(d)).collect())) for d in (docs, other))
    assert a == b


def test_mixed_text_is_cut_where_the_language_changes(spark):
    docs = spark.createDataFrame(language_rows(), "doc_id bigint, text string, lang string")
    model = language.train(docs)
    text = sentence("aa", 5001, 12) + " " + sentence("cc", 5002, 15)
    runs = language.language_runs(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), model).collect()
    assert [r.lang for r in runs] == ["aa", "cc"] and abs(runs[0].last_word - 11) <= 1


def test_forward_backward_against_all_paths():
    random_ = np.random.default_rng(1)
    scores, moves = random_.normal(size=(2, 4, 3)), random_.normal(size=(3, 3))
    present = np.array([[True] * 4, [True, True, False, False]])
    scores[1, 2:] = 0
    posterior, pairs = language.forward_backward(scores, present, moves)
    fast = language._posteriors(scores, present, moves)
    expected_pairs = np.zeros((3, 3))
    for chain, size in ((0, 4), (1, 2)):
        marginal, total = np.zeros((size, 3)), 0.0
        own = np.zeros((3, 3))
        for path in np.ndindex(*[3] * size):
            weight = math.exp(sum(scores[chain, t, y] for t, y in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:])))
            total += weight
            for t, y in enumerate(path):
                marginal[t, y] += weight
            for a, b in zip(path, path[1:]):
                own[a, b] += weight
        assert np.allclose(posterior[chain, :size], marginal / total) and np.allclose(fast[chain, :size], marginal / total)
        expected_pairs += own / total
    assert np.allclose(pairs, expected_pairs)


def test_language_without_anything_to_learn(spark):
    docs = shared.documents(spark, [(1, "some text", None, None, 9), (2, None, "en", None, 0)])
    assert language.train(docs) is None
    assert {r.lang_pred for r in language.predict(docs, None).collect()} == {"und"}
    assert [r.doc_id for r in language.identified(docs).collect()] == [1]
    assert language.predict(shared.documents(spark, []), None).collect() == []


def test_identified_keeps_columns_and_clean_rows(spark):
    docs = shared.documents(spark)
    kept = language.identified(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert not {6, 7, 8, 14} & set(ids) and ids.count(15) == 2 and ids.count(None) == 1


def toxic_rows():
    rows, labels = [], []
    for i in range(400):
        random.seed(i)
        words = [f"w{random.randrange(400)}" for _ in range(random.randrange(5, 200))]
        toxic = i % 8 == 0
        if toxic:
            for _ in range(3):
                words.insert(random.randrange(len(words)), random.choice(["Vile!", "nasty,", "rotten"]))
        rows.append((i, " ".join(words)))
        if i % 3:
            labels.append((i, 1, int(toxic)))
    return rows, labels


def test_toxicity_of_held_out_rows(spark):
    rows, labels = toxic_rows()
    rows += [(1000, None), (1001, ""), (1002, "You are vile and rotten"), (None, "nasty rotten")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    marks = spark.createDataFrame(labels + [(None, 1, 1), (5, 1, None)], "doc_id bigint, quality int, toxic int")
    classifier = toxicity.train(docs, marks)
    found = {r.doc_id: r.score for r in toxicity.predict(docs, classifier).collect()}
    held = [i for i in range(400) if shared.crc(i, 5)]
    assert all((found[i] >= 0.5) == (i % 8 == 0) for i in held)
    assert found[1000] == found[1001] < 0.5 < found[1002] and found[None] > 0.5
    changed = spark.createDataFrame([(i, q, 1 - t if shared.crc(i, 5) else t) for i, q, t in labels], "doc_id bigint, quality int, toxic int")
    again = toxicity.train(docs, changed)
    assert (again.weights == classifier.weights).all() and again.bias == classifier.bias


def test_toxicity_without_positives_or_rows(spark):
    docs = shared.documents(spark)
    marks = spark.createDataFrame([(1, 0, 0)], "doc_id bigint, quality int, toxic int")
    scores = {r.score for r in toxicity.predict(docs, toxicity.train(docs, marks)).collect()}
    assert len(scores) == 1 and max(scores) < 0.5
    none = shared.documents(spark, [])
    assert toxicity.predict(none, toxicity.train(none, marks)).collect() == []


def tree_by_hand(texts, depth):
    """Plain recursion over the nodes of all depths."""
    nodes = {}
    for text in texts:
        data = [255] * depth + list(text.encode()) + [255]
        for i in range(depth, len(data)):
            for d in range(depth + 1):
                context = tuple(data[i - d : i])
                for j in range(8):
                    key = (context, (1 << j) | (data[i] >> (8 - j)))
                    nodes.setdefault(key, [0, 0])[(data[i] >> (7 - j)) & 1] += 1
    kt = lambda a, b: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
    children = {}
    for context, path in nodes:
        if context:
            children.setdefault((context[1:], path), []).append((context, path))

    def weighted(key):
        own = kt(*nodes[key])
        if len(key[0]) == depth:
            return own, 1.0
        rest = sum(weighted(c)[0] for c in children.get(key, []))
        both = np.logaddexp(own, rest) - math.log(2)
        return both, math.exp(own - math.log(2) - both)

    weight = {key: weighted(key)[1] for key in nodes}

    def chance(context, path, bit, d=0):
        key = (context[len(context) - d :], path)
        if key not in nodes:
            return None
        a, b = nodes[key]
        own = (b + 0.5) / (a + b + 1) if bit else (a + 0.5) / (a + b + 1)
        deeper = chance(context, path, bit, d + 1) if d < len(context) else None
        return own if deeper is None else weight[key] * own + (1 - weight[key]) * deeper

    def score(text):
        data, total = [255] * depth + list(text.encode()) + [255], 0.0
        for i in range(depth, len(data)):
            for j in range(8):
                value = chance(tuple(data[i - depth : i]), (1 << j) | (data[i] >> (8 - j)), (data[i] >> (7 - j)) & 1)
                total += math.log10(0.5 if value is None else value)
        return total

    return score


@pytest.mark.parametrize("frequent", [0, 1000])
def test_context_tree_and_unigrams_by_hand(spark, frequent):
    rows = [(i, shared.prose(i, 6) + (" Caf\xe9" if i % 4 else "")) for i in range(40)] + [(100, None), (101, ""), (102, "ABC abc \x00 new"), (103, "q" * 500)]
    rows += [(3, rows[3][1]), (None, "no id")]
    training = [r for r in rows if r[0] is None or not shared.crc(r[0], 10)]
    found = contexttree.scored(spark.createDataFrame(rows, "doc_id bigint, text string"), frequent=frequent).collect()
    assert len(found) == len(rows)
    counts = Counter(w for _, t in training for w in [*shared.words(t), None])
    total, scale = sum(counts.values()), sum(counts.values()) + 0.1 * (len(counts) + 1)
    score = tree_by_hand([t or "" for _, t in training], contexttree.DEPTH)
    by_id = {r.doc_id: r for r in found}
    for doc_id, text in rows:
        r, own = by_id[doc_id], [*shared.words(text), None]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(counts[w] > 0 for w in own), total)
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 0.1) / scale) for w in own), rel_tol=1e-9)
        assert math.isclose(r.score, score(text or ""), rel_tol=1e-5)


def test_context_tree_of_nothing(spark):
    assert contexttree.scored(shared.documents(spark, [])).collect() == []
    held = next(i for i in range(100) if shared.crc(i, 10))
    r = contexttree.scored(shared.documents(spark, [(held, "ab c", None, None, 4)])).first()
    assert (r.n_tokens, r.n_known, r.train_tokens) == (3, 0, 0) and math.isclose(r.score, 5 * 8 * math.log10(0.5))


def test_pruned_nodes_still_give_probabilities():
    keys, one, weight = (np.array([(0 << 40) + 1], np.int64), np.array([0.25], np.float32), np.array([1.0], np.float32))
    tree = contexttree.Tree(keys, one, weight)
    every = np.arange(256, dtype=np.int64) | (65 << 8)
    assert math.isclose((10 ** tree.score(every)).sum(), 1.0)


def test_word_features_do_not_depend_on_neighbours():
    texts = pa.array(["abc defg", "defg"], pa.large_string())
    (_, _, data, offsets), = language.chunks(texts)
    start, end, _ = language.word_spans(data, offsets, language._NOT_LETTER)
    trigrams, first, affixes, whole = language.word_features(data, start, end)
    assert (trigrams[first[1] : first[2]] == trigrams[first[2] :]).all() and (affixes[1] == affixes[2]).all() and whole[1] == whole[2]
