import random
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marlspike.llm import language_id as L
from tests.llm.support import docs, write

WORDS = {
    "aa": "bado kelu mora zanu tiko luma pesa".split(),
    "bb": "strong wrench blight thrust grasp drift".split(),
    "cc": "élan père naïve où déjà forêt".split(),
}


def sentence(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", "ga" if lang == "aa" else "ly"]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    return [(i, sentence(rng, lang, rng.randrange(5, 60)), lang) for i in range(240) for lang in [rng.choice(list(WORDS))]]


@pytest.fixture(scope="module")
def model(spark, rows):
    return L.train(docs(spark, [r for r in rows if r[0] % 4]), per_language=40, shards=2)


def chains(scores, transitions, fresh):
    """Label and transition probabilities by listing all paths of each chain."""
    out, pairs = np.zeros(scores.shape), np.zeros(transitions.shape)
    starts = [*np.flatnonzero(fresh | (np.arange(len(fresh)) == 0)), len(scores)]
    for a, b in zip(starts[:-1], starts[1:]):
        weights = {}
        for path in product(range(scores.shape[1]), repeat=b - a):
            total = sum(scores[a + i, k] for i, k in enumerate(path))
            weights[path] = np.exp(total + sum(transitions[x, y] for x, y in zip(path, path[1:])))
        whole = sum(weights.values())
        for path, w in weights.items():
            for i, k in enumerate(path):
                out[a + i, k] += w / whole
            for x, y in zip(path, path[1:]):
                pairs[x, y] += w / whole
    return out, pairs


@pytest.mark.parametrize("block", [2, 3, 128])
def test_forward_backward_is_exact(monkeypatch, block):
    monkeypatch.setattr(L, "BLOCK", block)
    rng = np.random.default_rng(1)
    scores, transitions = rng.normal(size=(17, 3)) * 2, rng.normal(size=(3, 3))
    fresh = np.isin(np.arange(17), [0, 6, 7, 13])
    found, pairs = L.forward_backward(scores, transitions, fresh)
    want, want_pairs = chains(scores, transitions, fresh)
    assert np.allclose(found, want) and np.allclose(pairs, want_pairs)


def test_held_out_accuracy(spark, rows, model):
    held = [r for r in rows if r[0] % 4 == 0]
    found = {r.doc: r for r in L.predict(docs(spark, held), model).collect()}
    assert np.mean([found[k].lang_pred == lang for k, _, lang in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in found.values())


def test_switched_text_is_labelled_by_word(model):
    rng = random.Random(9)
    text = sentence(rng, "aa", 30) + " " + sentence(rng, "bb", 20)
    offsets, words = L.split_words(pa.array([text]))
    scores, _ = L.word_scores(model, words)
    found, _ = L.forward_backward(scores, model.transitions, np.arange(50) == 0)
    labels = [model.languages[k] for k in found.argmax(axis=1)]
    assert np.mean([x == y for x, y in zip(labels, ["aa"] * 30 + ["bb"] * 20)]) > 0.9
    assert (np.diag(model.transitions) > model.transitions.mean()).all()  # languages rather stay
    names, score, _ = L.judge(model, pa.array([text]))
    assert names == ["aa"] and 0.5 < score[0] < 0.75


ODD = [
    (1, None), (2, ""), (3, "12 34 !!"), (4, "bado " * 60_000), (5, "strong"), (5, "bado kelu"), (None, "déjà"), (6, "\x01 kelu \x01"),
    (7, "q" * 5000), (8, " 　  "),
]


def test_odd_texts(spark, model):
    frame = docs(spark, ODD, ["doc", "score", "lang_pred"])
    got = sorted(((r.doc, r.lang_pred) for r in L.predict(frame, model).collect()), key=str)
    assert [k for k, _ in got] == sorted([k for k, _ in ODD], key=str)
    named = dict(got)
    assert [named[k] for k in (1, 2, 3, 8)] == ["und"] * 4 and named[4] == "aa" and named[6] == "aa" and named[None] == "cc"
    kept = L.keep_identified(frame, model)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([k for k, _ in ODD if k not in (1, 2, 3, 8)], key=str)


def test_labels_are_no_inputs(spark, rows, model):
    plain = {r.doc: r.lang_pred for r in L.predict(docs(spark, rows), model).collect()}
    changed = docs(spark, [(k, t, "zz", "other") for k, t, _ in rows])
    assert {r.doc: r.lang_pred for r in L.predict(changed, model).collect()} == plain


def test_query_and_no_rows(spark, rows, tmp_path):
    folder = write(docs(spark, rows, ["held_out"]), tmp_path)
    found = L.op1_language_id(spark, folder)
    assert found.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    got = found.join(docs(spark, rows).select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(got) > 30 and np.mean([r.lang == r.lang_pred for r in got]) > 0.95
    empty = docs(spark, [])
    assert L.predict(empty, L.train(empty)).count() == 0
    unlearned = L.train(empty)
    assert L.predict(docs(spark, [(1, "words")]), unlearned).first().lang_pred == "und"


def test_the_sample_is_bounded(spark, rows):
    frame = docs(spark, rows).select(F.col("doc_id").alias("doc"), "text", "lang")
    sizes = {r.lang: r["count"] for r in L.training_sample(frame, 20).groupBy("lang").count().collect()}
    assert sizes == {"aa": 20, "bb": 20, "cc": 20}


def test_texts_in_no_learned_language_are_dropped(spark, model):
    rng = random.Random(4)
    soup = " ".join("".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(7)) for _ in range(60))
    mixed = " ".join(sentence(rng, lang, 8) for lang in WORDS)
    strange = [(1, soup), (2, "όλοι οι άνθρωποι γεννιούνται ελεύθεροι"), (3, "x9f3 a0c4 77fe b1d2 c9c9 e0e1")]
    clean = [(4, mixed), (5, mixed.upper().replace(" ", "!! ")), (6, sentence(rng, "cc", 40))]
    _, score, _ = L.judge(model, pa.array([soup]))
    assert score[0] >= 1 / 3  # the score cannot tell
    assert {r.doc_id for r in L.keep_identified(docs(spark, strange + clean), model).collect()} == {4, 5, 6}
